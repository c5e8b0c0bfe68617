"""Jaccard join of word n-gram sets with token-combination prefixes.

Each text is its set of 5-word shingles (64-bit hashes); equal sets are one class. Tokens
are put in one global order, rarest first. Two sets of Jaccard similarity 3/4 or more share
``o`` or more tokens, ``o`` three quarters of either size, so they share ``G + 1`` within the
first ``size - o + 1 + G``. Tokens fall into ``G`` groups by hash, so two of those shared
share a group, and then

* one of the two is rare, and indexed alone, or
* both are frequent, and indexed as a pair.

A longer prefix (larger ``G``) keeps the pairs few. Tokens of one class have no partner
and are not indexed, so a set whose prefix is made of them is left early.

Frequencies come from a block exchange: blocks send their distinct tokens to buckets and get
back those of two classes or more. Candidates are compared in rounds, and a pair that earlier
links already join is never compared: first each class with the most typical class of those
it shares signatures with, then with the most typical one of each signature, at last all classes
of a signature that still lie in different components. So a group of ``m`` near copies costs ``m``
comparisons where the most typical of them links with all, and no link that joins two
components is lost. The last round finds pairs by the single tokens of plain prefixes (``G`` = 0)
within groups of classes, and gives links, not pairs.

Null and empty texts, and texts without words, have the empty set and link with nothing;
texts of fewer than five words are one shingle. Rows with equal keys are one document, and a
null key never is the name of a component unless no row of it has another. Extra columns
stay; columns with the name of an output are replaced. An empty table gives an empty result.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import (
    blocks,
    hashes,
    mixed,
    pack,
    pack_numbers,
    parts_for,
    renamed,
    restored,
    row_digest,
    rows,
    unpack,
    unpack_numbers,
    words_of,
)
from tristrata.llm.components import connected
from tristrata.llm.storage import stored

WORDS = 5
#: Similarity asked for, as a fraction.
TOP, BOTTOM = 3, 4
#: Classes up to which a token is rare.
RARE = 64
GROUPS = (1, 4, 16, 64)
#: Candidate classes that are compared with as many others in one go.
TOGETHER = 1000
#: Bits of a token's hash beyond those that name its bucket.
KEY_SHIFT = np.uint64(24)
LOW = np.uint64((1 << 24) - 1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Bytes of text whose sets a task holds together.
JACCARD_BLOCK = 4 << 20
HEADER = -1
PACKED = "block string, part int, payload binary"
CANDIDATE = "cid binary, n int, tokens binary, freqs binary"


def token_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    counts, found = words_of(pc.ascii_lower(texts))
    word = mixed(hashes(found.dictionary))[found.indices.to_numpy()]
    out = []
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            mine = word[a:b]
            length = min(words, b - a)
            gram = np.full(max(0, b - a - length + 1) if length else 0, length, np.uint64)
            for k in range(length):
                gram = gram * FACTOR + mine[k : k + len(gram)]
            out.append(np.unique(mixed(gram)))
    return out


def least_overlap(n: np.ndarray | int):
    return -(-n * TOP // BOTTOM)


def groups_for(n: int) -> int:
    """How many groups sets of ``n`` tokens can use: fewer than they must share."""
    return max(g for g in GROUPS if g == 1 or g < least_overlap(n))


def levels(n: int) -> list[int]:
    """Group counts of this size and of all smaller sizes that can be similar to it."""
    return sorted({groups_for(n), groups_for(max(1, least_overlap(n)))} | {
        g for g in GROUPS if groups_for(max(1, least_overlap(n))) <= g <= groups_for(n)
    })


def prefix(n: int, groups: int) -> int:
    return min(n, n - least_overlap(n) + 1 + groups)


def classes(docs: DataFrame, text: str, kept: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with ``kept`` as ``k0, ...``, ``cid``, ``n``; and classes that can have partners."""
    docs = renamed(docs, kept, text=F.col(f"`{text}`"))
    inner = docs.columns[:-1]
    parts = parts_for(docs, "text")
    schema = pa.schema([("block", pa.string()), ("part", pa.int32()), ("payload", pa.binary())])

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, texts in blocks(batches, "text", JACCARD_BLOCK):
            sets = token_sets(texts)
            names = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            number = {d: k for k, d in reversed(list(enumerate(names)))}
            first = sorted(k for d, k in number.items() if len(sets[k]))
            head = {c: table.column(c) for c in inner}
            sizes = np.array([len(x) for x in sets], np.int32)
            cids = [d if n else None for d, n in zip(names, sizes, strict=True)]
            turn = np.full(len(sets), -1, np.int32)
            turn[first] = np.arange(len(first))
            payload = pack(**head, cid=pa.array(cids, pa.binary()), n=sizes, turn=turn)
            yield rows(schema, block=[name], part=[HEADER], payload=[payload])
            if not first:
                continue
            token = np.concatenate([sets[k] for k in first])
            owner = np.repeat(np.arange(len(first), dtype=np.uint16), sizes[first])
            part = ((token & LOW) % np.uint64(parts)).astype(np.int64)
            key = token >> KEY_SHIFT
            turn = np.lexsort((key, part))
            borders = np.searchsorted(part[turn], np.arange(parts + 1))
            key, owner = key[turn], owner[turn]
            for p in np.flatnonzero(np.diff(borders)).tolist():
                a, b = borders[p], borders[p + 1]
                entries = pack_entries(key[a:b], owner[a:b])
                yield rows(schema, block=[name], part=[p], payload=[entries])

    def shared(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        if part == HEADER:
            return table
        got = [unpack_entries(x.as_py()) for x in table.column("payload")]
        found = pa.array(np.concatenate([k for k, _ in got])).dictionary_encode()
        number = found.indices.to_numpy()
        freq = np.bincount(number)[number]
        out, at = [], 0
        for key, owner in got:
            f = freq[at : at + len(key)]
            at += len(key)
            two = f > 1
            out.append(pack_entries(key[two], owner[two], f[two]))
        return pa.table(
            {"block": table.column("block"), "part": table.column("part"), "payload": out}
        )

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        part = table.column("part").to_pylist()
        got = [x.as_py() for x in table.column("payload")]
        if part[0] != HEADER or HEADER in part[1:]:
            raise RuntimeError("a block came twice or lacks its rows")
        head = unpack(got[0])
        turn, n, cid = (head.column(c).to_numpy(zero_copy_only=False) for c in ("turn", "n", "cid"))
        first = np.flatnonzero(turn >= 0)
        pieces = []
        for p, payload in zip(part[1:], got[1:], strict=True):
            key, owner, freq = unpack_entries(payload)
            pieces.append(((key << KEY_SHIFT) | np.uint64(p), owner, freq))
        token, owner, freq = (
            np.concatenate([x[k] for x in pieces]) if pieces else np.empty(0, np.uint64)
            for k in range(3)
        )
        turn = np.lexsort((token, freq, owner))
        token, owner, freq = token[turn], owner[turn], freq[turn].astype(np.uint32)
        bounds = np.searchsorted(owner, np.arange(len(first) + 1))
        out = {"cid": [], "n": [], "tokens": [], "freqs": []}
        for k, row in enumerate(first.tolist()):
            a, b = bounds[k], bounds[k + 1]
            size = int(n[row])
            # more lone tokens would leave too few to share within any extended prefix
            if size - (b - a) < prefix(size, 0) and b > a:
                out["cid"].append(cid[row])
                out["n"].append(size)
                out["tokens"].append(token[a:b].tobytes())
                out["freqs"].append(freq[a:b].tobytes())
        m = len(out["cid"])
        total = head.num_rows + m
        columns = {
            **{c: pad(head.column(c), m) for c in inner},
            "is_row": pa.array([True] * head.num_rows + [False] * m),
            "cid": pa.concat_arrays([head.column("cid"), pa.array(out["cid"], pa.binary())]),
            "n": pa.concat_arrays([head.column("n"), pa.array(out["n"], pa.int32())]),
            "tokens": pa.array([None] * head.num_rows + out["tokens"], pa.binary()),
            "freqs": pa.array([None] * head.num_rows + out["freqs"], pa.binary()),
        }
        assert all(len(x) == total for x in columns.values())
        return pa.table(columns)

    fields = [T.StructField(c, docs.schema[c].dataType) for c in inner]
    wide = T.StructType(
        fields
        + [
            T.StructField("is_row", T.BooleanType()),
            T.StructField("cid", T.BinaryType()),
            T.StructField("n", T.IntegerType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("freqs", T.BinaryType()),
        ]
    )
    # headers pass through, spread by block
    bucket = F.when(F.col("part") == HEADER, F.col("block")).otherwise(F.col("part").cast("string"))
    routed = docs.mapInArrow(requests, PACKED).withColumn("bucket", bucket)
    answers = routed.groupBy("bucket").applyInArrow(
        lambda table: shared(table.select(["block", "part", "payload"])), PACKED
    )
    both = stored(answers.groupBy("block").applyInArrow(gather, wide), "jaccard-classes")
    members = both.where("is_row").select(*inner, "cid", F.col("n").cast("long").alias("n"))
    wanted = both.where("not is_row").select("cid", "n", "tokens", "freqs").dropDuplicates(["cid"])
    numbered = wanted.withColumn("num", F.monotonically_increasing_id())
    return members, stored(numbered, "jaccard-candidates")


def pad(column: pa.Array, more: int) -> pa.Array:
    return pa.concat_arrays([column, pa.nulls(more, column.type)])


def pack_entries(key: np.ndarray, owner: np.ndarray, freq: np.ndarray | None = None) -> bytes:
    """Ascending 40-bit keys with the class of each, and frequencies."""
    more = [] if freq is None else [freq.astype(np.uint32)]
    gaps = np.diff(key, prepend=np.uint64(0))
    low = (gaps & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (gaps >> np.uint64(32)).astype(np.uint8)
    return pack_numbers(low, high, owner.astype(np.uint16), *more)


def unpack_entries(payload: bytes) -> list[np.ndarray]:
    low, high, *others = unpack_numbers(payload)
    gaps = low.astype(np.uint64) | (high.astype(np.uint64) << np.uint64(32))
    return [np.cumsum(gaps, dtype=np.uint64), *others]


SIGNED = pa.schema(
    [("sig", pa.int64()), ("num", pa.int64()), ("n", pa.int32()), ("shared", pa.int32())]
    + [("odd", pa.float32())]
)


def signatures(candidates: DataFrame) -> DataFrame:
    """Rows ``sig, num, n, shared, odd``: rare tokens and pairs of frequent ones in the prefixes.

    ``n`` is the size of the class and ``shared`` how many of its tokens others have; ``odd``
    is the lower, the more classes have its tokens on average.
    """

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for num, n, tokens, freqs in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                token, freq = np.frombuffer(tokens, np.uint64), np.frombuffer(freqs, np.uint32)
                sigs = class_signatures(n, token, freq)
                yield rows(
                    SIGNED,
                    sig=sigs.view(np.int64),
                    num=np.full(len(sigs), num),
                    n=np.full(len(sigs), n),
                    shared=np.full(len(sigs), len(token)),
                    odd=np.full(len(sigs), -float(freq.sum(dtype=np.int64)) / n),
                )

    columns = candidates.select("num", "n", "tokens", "freqs")
    return columns.mapInArrow(signed, "sig long, num long, n int, shared int, odd float")


def can_link(an: str, ashared: str, bn: str, bshared: str) -> Column:
    """Whether two classes have enough tokens that others have to be similar."""
    return F.least(ashared, bshared) * (TOP + BOTTOM) >= (F.col(an) + F.col(bn)) * TOP


def class_signatures(n: int, tokens: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    alone = n - len(tokens)
    used = levels(n)
    reach = max(0, prefix(n, used[-1]) - alone)
    rare = tokens[:reach][freqs[:reach] <= RARE]
    out = [mixed(rare)]
    with np.errstate(over="ignore"):
        for groups in used:
            reach = max(0, prefix(n, groups) - alone)
            often = np.sort(tokens[:reach][freqs[:reach] > RARE])
            group = (mixed(often) >> np.uint64(7)) % np.uint64(groups)
            for g in np.unique(group):
                mine = often[group == g]
                i, j = np.triu_indices(len(mine), 1)
                out.append(mixed(mixed(mine[i]) * FACTOR + mine[j] + np.uint64(groups)))
    return np.unique(np.concatenate(out))


def verified(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """The ``pairs`` (``a, b``) of similarity 3/4 or more.

    Pairs are gathered by ``b``, in parts of about ``TOGETHER``: each ``a`` travels once for each
    pair, each ``b`` once for each part.
    """
    sizes = pairs.groupBy("b").agg(F.count("*").alias("k"))
    sizes = sizes.select("b", F.ceil(F.col("k") / TOGETHER).cast("int").alias("parts"))
    sets = candidates.select("num", "n", "tokens")
    dealt = pairs.join(sizes, "b").select(
        F.col("a").alias("num"), "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")
    )
    hubs = sizes.select(
        F.col("b").alias("num"), "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    both = dealt.withColumn("hub", F.lit(0)).unionByName(hubs.withColumn("hub", F.lit(1)))
    whole = both.join(sets, "num")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            kept = []
            for r in batch.to_pylist():
                tokens = np.frombuffer(r["tokens"], np.uint64)
                if r["hub"]:
                    hub = (r["n"], tokens)
                elif similar(r["n"], tokens, *hub):
                    kept.append((r["num"], r["b"]))
            yield pa.record_batch(
                {c: pa.array([x[k] for x in kept], pa.int64()) for k, c in enumerate("ab")}
            )

    return (
        whole.repartition("b", "part")
        .sortWithinPartitions("b", "part", F.col("hub").desc())
        .mapInArrow(compared, "a long, b long")
    )


def similar(an: int, a: np.ndarray, bn: int, b: np.ndarray) -> bool:
    """Whether sets of ``an`` and ``bn`` tokens, of which ``a`` and ``b`` have partners, link."""
    least = -(-(an + bn) * TOP // (TOP + BOTTOM))
    if min(len(a), len(b)) < least:
        return False
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1])) >= least


def prefix_tokens(candidates: DataFrame) -> DataFrame:
    """Rows ``sig, num``: single tokens of the plain prefixes, which suffice to find all pairs."""
    schema = pa.schema([("sig", pa.int64()), ("num", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for num, n, tokens in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                token = np.frombuffer(tokens, np.uint64)
                mine = token[: max(0, prefix(n, 0) - (n - len(token)))].view(np.int64)
                yield rows(schema, sig=mine, num=np.full(len(mine), num))

    return candidates.select("num", "n", "tokens").mapInArrow(cut, "sig long, num long")


def links(candidates: DataFrame) -> DataFrame:
    """Rows ``cid, root``: the components of the classes that link with another."""
    every = stored(signatures(candidates), "jaccard-every")
    # the class nearest to the others, as an original is to its copies, links with most of them
    first = F.min(F.struct("odd", "num", "n", "shared"))
    least = every.groupBy("sig").agg(first.alias("b"), F.count("*").alias("m")).where("m > 1")
    least = least.select(
        "sig",
        F.col("b.num").alias("b"),
        F.col("b.n").alias("bn"),
        F.col("b.shared").alias("bs"),
    )
    # signatures of one class have gone from here on
    signed = stored(every.drop("odd").join(least, "sig"), "jaccard-signatures")
    stars = stored(
        signed.where((F.col("num") != F.col("b")) & can_link("n", "shared", "bn", "bs"))
        .groupBy(F.col("num").alias("a"), "b")
        .agg(F.count("*").alias("common")),
        "jaccard-stars",
    )
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("common", "b")).alias("b"))
    edges = stored(verified(best, candidates), "jaccard-links")
    roots = connected(edges)

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs that the links found so far do not join."""
        a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        known = pairs.join(a, "a", "left").join(b, "b", "left")
        return known.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")

    rest = stored(
        apart(stars.select("a", "b")).join(best, ["a", "b"], "left_anti"), "jaccard-rest"
    )
    edges = edges.union(stored(verified(rest, candidates), "jaccard-links"))
    roots = connected(edges)
    # classes of signatures that still join different components meet by their plain prefixes
    named = roots.withColumnRenamed("node", "num")
    open_classes = mixed_lists(signed.select("sig", "num"), named).select("num").distinct()
    open_classes = stored(open_classes, "jaccard-open")
    plain = prefix_tokens(candidates.join(open_classes, "num", "left_semi"))
    open_lists = stored(mixed_lists(plain, named), "jaccard-lists")
    last = stored(links_between(open_lists, candidates), "jaccard-links")
    roots = connected(edges.union(last))
    names = candidates.select("num", "cid")
    of_node = names.withColumnRenamed("num", "node")
    of_root = names.select(F.col("num").alias("root"), F.col("cid").alias("name"))
    found = roots.join(of_node, "node").join(of_root, "root")
    return found.select("cid", F.col("name").alias("root"))


def neighbourhoods(lists: DataFrame) -> DataFrame:
    """``lists`` with ``own``, a group of at most about ``TOGETHER`` classes that share signatures.

    Classes take the least number within two steps over shared signatures, so near copies
    fall into one group however large the table is; a group of more classes is dealt.
    """
    marked = lists.select("sig", "num", F.col("num").alias("label"))
    for _ in range(2):
        of_sig = marked.groupBy("sig").agg(F.min("label").alias("low"))
        of_class = marked.join(of_sig, "sig").groupBy("num").agg(F.min("low").alias("label"))
        marked = stored(marked.select("sig", "num").join(of_class, "num"), "jaccard-labels")
    labels = marked.groupBy("num").agg(F.min("label").alias("label"))
    sizes = labels.groupBy("label").agg(F.ceil(F.count("*") / TOGETHER).alias("parts"))
    part = F.pmod(F.xxhash64("num"), F.col("parts"))
    groups = labels.join(sizes, "label").select("num", F.xxhash64("label", part).alias("own"))
    return lists.join(groups, "num")


def links_between(lists: DataFrame, candidates: DataFrame) -> DataFrame:
    """Links of classes with different ``root`` that share a ``sig`` of ``lists``.

    A class goes to each group that a class of one of its signatures lies in. There pairs are
    found by their plain prefixes, and compared unless links found there join them already.
    """
    placed = stored(neighbourhoods(lists), "jaccard-placed")
    there = placed.select("sig", F.col("own").alias("other")).distinct()
    meets = placed.select("sig", "num", "root", "own").join(there, "sig")
    meets = meets.select(
        F.least("own", "other").alias("ga"), F.greatest("own", "other").alias("gb"),
        "own", "num", "root",
    ).distinct()
    sets = meets.join(candidates.select("num", "n", "tokens"), "num")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["ga"], r["gb"]) != group:
                    yield found_links(held)
                    held, group = [], (r["ga"], r["gb"])
                held.append(r)
        yield found_links(held)

    columns = ["ga", "gb", "own", "num", "root", "n", "tokens"]
    return (
        sets.select(columns)
        .repartition("ga", "gb")
        .sortWithinPartitions("ga", "gb", "num")
        .mapInArrow(compared, "a long, b long")
    )


def found_links(held: list[dict]) -> pa.RecordBatch:
    """Links between the classes of two groups that join different components."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    owners: dict[int, list[dict]] = {}
    kept = []
    for r in held:
        r["tokens"] = np.frombuffer(r["tokens"], np.uint64)
        size = len(r["tokens"])
        seen = set()
        for token in r["tokens"][: max(0, prefix(r["n"], 0) - (r["n"] - size))].tolist():
            for other in owners.setdefault(token, []):
                # two groups meet here; within one, only where that one meets itself
                if other["num"] in seen or (r["ga"] != r["gb"] and other["own"] == r["own"]):
                    continue
                seen.add(other["num"])
                a, b = find(r["root"]), find(other["root"])
                if a != b and similar(r["n"], r["tokens"], other["n"], other["tokens"]):
                    parent[max(a, b)] = min(a, b)
                    kept.append((r["num"], other["num"]))
            owners[token].append(r)
    return pa.record_batch(
        {c: pa.array([x[k] for x in kept], pa.int64()) for k, c in enumerate("ab")}
    )


def mixed_lists(signed: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of ``signed``, with ``root``, whose signature has classes of different components."""
    rooted = signed.join(roots, "num", "left").withColumn("root", F.coalesce("root", "num"))
    ends = rooted.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return rooted.join(ends.where("low <> high").select("sig"), "sig")


def rooted_members(docs: DataFrame, text: str, kept: list[str]) -> DataFrame:
    """Rows with ``kept`` as ``k0, ...``, ``cid``, ``n`` and ``root``, null without words."""
    members, candidates = classes(docs, text, kept)
    return members.join(links(candidates), "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def components(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without ``text``, with ``n_shingles`` and ``component_id``, the least key linked."""
    kept = [c for c in docs.columns if c not in (text, "n_shingles", "component_id")]
    rooted = rooted_members(docs, text, kept)
    own = F.col(f"k{kept.index(key)}")
    least = rooted.where("root is not null").groupBy("root").agg(F.min(own).alias("least"))
    component = F.coalesce("least", own).alias("component_id")
    return restored(
        rooted.join(least, "root", "left"), kept, F.col("n").alias("n_shingles"), component
    )


def one_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the first document of each component; rows without key or words stay."""
    found = components(docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")), key, text)
    gone = found.where(F.col(f"`{key}`") != F.col("component_id")).select(key).distinct()
    return docs.join(gone, key, "left_anti")


def one_row_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the least key, null ones last.

    Rows are told apart by a digest of all columns, so repeated rows, null keys and keys with
    several texts are decided row by row. Rows without words stay.
    """
    marked = docs.withColumn("__row", row_digest(docs.columns))
    rooted = rooted_members(marked.select(F.col(f"`{key}`"), "__row", F.col(f"`{text}`")), text, [key, "__row"])
    # equal rows are one here, with their number
    own = ["root", "cid", "k0", "k1"]
    kinds = rooted.where("root is not null").groupBy(*own).agg(F.count("*").alias("times"))
    order = F.struct(F.col("k0").isNull().alias("z"), "k0", "cid", "k1")
    least = kinds.groupBy("root").agg(F.min(order).alias("least"))
    found = kinds.join(least, "root").select(
        F.col("k1").alias("__row"), (F.col("k1") == F.col("least.k1")).alias("first"), "times"
    )
    found = stored(found.where("not first or times > 1"), "jaccard-rows")
    again = stored(found.where("first").select("__row"), "jaccard-again")
    single = marked.join(found.select("__row"), "__row", "left_anti")
    repeated = marked.join(again, "__row", "left_semi").distinct()
    return single.unionByName(repeated).drop("__row")
