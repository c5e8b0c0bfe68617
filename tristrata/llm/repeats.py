"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere go.

Every window of ``length`` bytes belongs to its anchor, the leftmost least hash of ``GRAM`` bytes in
it, so equal windows have equal anchors and meet by the anchor's value. Consecutive windows
of one anchor are a run, and a run travels as the stretch of text that it covers.

1. Equal texts are taken once, with their number. Anchors are counted first, as eight bytes each:
   a run whose anchor occurs once in all texts has no repeat, and most runs end here. The
   others are counted by digest of their stretch; one that occurs twice repeats as a whole,
   and every digest goes on once.
2. Runs of an anchor with more than ``GROUP`` different stretches are cut into pieces of up to
   ``STEP`` windows, aligned to the anchor. The bytes that all windows of a whole piece share become
   its anchor, so most pieces end as those of step 1 do: theirs occurs once, or they repeat as a whole.
3. Where different stretches share an anchor, their texts are gathered by anchor, in
   sub-groups of ``GROUP`` stretches, so that no anchor gathers without bound. Each task builds
   the suffix array of its stretches by two-stage sorting (``suffixes``); neighbours with a common
   prefix of ``length`` or more are repeats.
4. An anchor of several sub-groups, by now one of pieces, also sends one digest for each different
   window; those found in two sub-groups repeat as well.
5. Repeats go back to the texts by digest, and each text drops the bytes they cover.

Passages below ``length`` bytes may be counted beside: the runs of both lengths share their anchors,
so texts are cut, hashed and counted once, and steps 2 to 5 follow for each length.

With ``across`` only strings that also start in another text count, and with ``words`` a removed run
must hold that many whole words.

All is judged on the input texts as UTF-8 bytes; matches within a text and overlapping ones
count, and none crosses a text. Null and empty texts, and ones shorter than ``length``, lose
nothing. A row that occurs twice repeats itself, so both lose all windows. Extra columns
stay; columns with the name of an output are replaced. An empty table gives an empty result.
Digests have 128 bits; within a task stretches are compared by 64-bit polynomial hashes.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.blocks import mixed, renamed, restored, rows
from tristrata.llm.storage import stored
from tristrata.llm.suffixes import Row, suffix_array
from tristrata.operators.join import sized_join, skewed_join
from tristrata.sizes import measure

#: Bytes of a string that may not start twice, unless a caller says otherwise.
LENGTH = 400
#: Bytes of an anchor, a power of two: so many that texts rarely share them by chance.
GRAM = 64
#: A passage of other documents: fifty whole words or more, 200 bytes or more, in two or more of them.
PASSAGE = {"length": 200, "across": True, "words": 50}
#: Stretches of one anchor that are sorted together; about 570 bytes each.
GROUP = 4000
#: Windows of a piece of a run.
STEP = 16
#: Rows of a batch that a task sends on, or little more.
MOST = 20_000
#: Bytes of stretches for one suffix array, once whole sub-groups are in.
CHUNK = 1 << 20


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def distinct_texts(docs: DataFrame, text: str, length: int) -> DataFrame:
    """Rows ``id, t, z, m``: number, digest, compressed bytes and count of each text of some length."""

    def squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [tool.compress(x.as_py().encode()) for x in batch.column("x")]
            columns = [batch.column("t"), pa.array(z, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["t", "z"])

    column = F.col(f"`{text}`")
    long = docs.where(F.octet_length(column) >= length)
    long = long.select(text_key(column).alias("t"), column.alias("x"))
    packed = long.mapInArrow(squeezed, "t binary, z binary")
    once = packed.groupBy("t").agg(F.first("z").alias("z"), F.count("*").alias("m"))
    return stored(once.withColumn("id", F.monotonically_increasing_id()), "repeat-texts")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each place on, built by doubling."""
    value, reach = data.astype(np.uint64), 1
    while reach < 8:
        value = value[:-reach] | (value[reach:] << np.uint64(8 * reach))
        reach *= 2
    with np.errstate(over="ignore"):
        value, factor = mixed(value), 0xD1B54A32D192ED03
        while reach < GRAM:
            value = value[:-reach] * np.uint64(factor) + value[reach:]
            reach, factor = 2 * reach, factor * factor % (1 << 64)
        return mixed(value)


def runs_of_each(text: bytes, lengths: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First window, number of windows and place of the anchor of each run, for ascending
    ``lengths`` of at most that of the text; then the anchor values of all places."""
    gram = gram_hashes(np.frombuffer(text, np.uint8))
    # the leftmost least of each window: half of the hash above, the place below
    v = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    span, out = 1, []
    for length in lengths:
        width = length - GRAM + 1
        while 2 * span <= width:
            v = np.minimum(v[:-span], v[span:])
            span *= 2
        least = np.minimum(v[: len(v) - (width - span)], v[width - span :])
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        out.append((first, np.diff(np.concatenate([first, [len(place)]])), place[first]))
    return out, gram


def runs_of(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and anchor value of each run."""
    [(first, size, place)], gram = runs_of_each(text, [length])
    return first, size, gram[place]


RUNS = pa.schema(
    [("id", pa.int64()), ("at", pa.int32()), ("size", pa.int32())]
    + [("anchor", pa.int64()), ("m", pa.int64())]
)
#: Where the run of longer windows with the same anchor starts, and how many it has, or 0.
LONGER = pa.schema([("long_at", pa.int32()), ("long_size", pa.int32())])


def joined_rows(schema: pa.Schema, held: list[list[np.ndarray]]) -> pa.RecordBatch:
    """The columns of many texts, put together."""
    columns = (np.concatenate(c) for c in zip(*held, strict=True))
    return rows(schema, **dict(zip(schema.names, columns, strict=True)))


def runs(texts: DataFrame, length: int, longer: int | None = None) -> DataFrame:
    """Rows ``id, at, size, anchor, m`` for the runs of each distinct text.

    Anchors of ``longer`` windows are anchors of those of ``length`` bytes too, so the runs of both
    are one row, with ``long_at`` and ``long_size``.
    """
    schema = pa.schema([*RUNS, *(LONGER if longer else [])])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            held, n = [], 0
            for t, z, m in zip(*(batch.column(c).to_pylist() for c in ("id", "z", "m")), strict=True):
                text = tool.decompress(z)
                both = longer and len(text) >= longer
                [(at, size, place), *long], gram = runs_of_each(text, [length, longer] if both else [length])
                k = len(at)
                columns = [np.full(k, t), at, size, gram[place].view(np.int64), np.full(k, m)]
                if longer:
                    columns += [np.zeros(k, np.int32), np.zeros(k, np.int32)]
                for long_at, long_size, anchored in long:
                    same = np.searchsorted(place, anchored)
                    columns[-2][same], columns[-1][same] = long_at, long_size
                held.append(columns)
                n += k
                if n >= MOST:
                    yield joined_rows(schema, held)
                    held, n = [], 0
            if held:
                yield joined_rows(schema, held)

    columns = "id long, at int, size int, anchor long, m long"
    columns += ", long_at int, long_size int" if longer else ""
    return texts.select("id", "z", "m").mapInArrow(found, columns)


def named_runs(
    every: DataFrame, texts: DataFrame, length: int, longer: int | None = None
) -> DataFrame:
    """The runs whose anchor occurs twice, with ``run``, the digest of their stretch.

    With ``longer`` also ``long_run``, that of the run of longer windows.
    """
    shared = every.groupBy("anchor").agg(F.sum("m").alias("k")).where("k > 1").select("anchor")
    fields = ["at", "size", "anchor", "m", *(LONGER.names if longer else [])]
    open_runs = skewed_join(every, shared, "anchor")
    by_text = open_runs.groupBy("id").agg(F.collect_list(F.struct(*fields)).alias("runs"))

    def digests(text: bytes, at: np.ndarray, size: np.ndarray, length: int) -> pa.Array:
        ends = np.where(size > 0, at + size - 1 + length, 0)
        run = [
            hashlib.blake2b(text[a:b], digest_size=16).digest() if b else None
            for a, b in zip(at.tolist(), ends.tolist(), strict=True)
        ]
        return pa.array(run, pa.binary())

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for t, z, mine in zip(*(batch.column(c) for c in ("id", "z", "runs")), strict=True):
                text = tool.decompress(z.as_py())
                at, size, anchor, m, *long = (
                    mine.values.field(k).to_numpy() for k in range(len(fields))
                )
                more = {c: pa.array(x) for c, x in zip(LONGER.names, long)}
                if longer:
                    more["long_run"] = digests(text, *long, longer)
                yield pa.record_batch(
                    {
                        "id": pa.array(np.full(len(at), t.as_py(), np.int64)),
                        "at": pa.array(at),
                        "size": pa.array(size),
                        "anchor": pa.array(anchor),
                        "run": digests(text, at, size, length),
                        "m": pa.array(m),
                        **more,
                    }
                )

    columns = "id long, at int, size int, anchor long, run binary, m long"
    columns += ", long_at int, long_size int, long_run binary" if longer else ""
    joined = by_text.join(texts.select("id", "z"), "id")
    return joined.select("id", "z", "runs").mapInArrow(gathered(named), columns)


def gathered(step, most: int = MOST):
    """``step`` with its small batches put together."""

    def larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in step(batches):
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return larger


#: ``owner`` is the only text that has a run, or ``MANY``.
STRETCHES = "run binary, anchor long, salt int, alone boolean, whole boolean, owner long, body binary"
FOUND = "run binary, window binary, spots array<int>, repeats boolean, owner long"
MANY = -1


#: A piece of a run: where it starts in the run, the windows it has, and ``id`` and ``at`` of its text.
PIECES = (
    "run binary, anchor long, m long, owner long, whole boolean, "
    "piece binary, start int, id long, at int, size int"
)


def pieces(heavy: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The runs of ``heavy`` in pieces of ``STEP`` windows: rows of ``PIECES``.

    Equal windows hold their anchor at the same distance ``d`` and are in pieces of the same number
    ``d // STEP``. All windows of that number, in any run, hold the same ``length - STEP + 1`` bytes
    around the anchor if they are equal; their digest is the anchor of the piece.
    """
    schema = pa.schema(
        [("run", pa.binary()), ("anchor", pa.int64()), ("m", pa.int64()), ("owner", pa.int64())]
        + [("whole", pa.bool_()), ("piece", pa.binary()), ("start", pa.int32())]
        + [("id", pa.int64()), ("at", pa.int32()), ("size", pa.int32())]
    )
    fields = ["run", "anchor", "m", "owner", "whole", "at", "size"]
    by_text = heavy.groupBy("id").agg(F.collect_list(F.struct(*fields)).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for t, z, mine in zip(*(batch.column(c) for c in ("id", "z", "runs")), strict=True):
                text, found = tool.decompress(z.as_py()), []
                for r in mine.as_py():
                    at, size = r["at"], r["size"]
                    gram = gram_hashes(np.frombuffer(text, np.uint8, length, at))
                    to = int(np.flatnonzero(gram.view(np.int64) == r["anchor"])[0])
                    for last in range(to % STEP, size + STEP - 1, STEP):
                        first, end = max(last - STEP + 1, 0), min(last, size - 1)
                        core = text[at + last : at + last + length - STEP + 1]
                        core = hashlib.blake2b(core, digest_size=8).digest()
                        body = text[at + first : at + end + length]
                        name = hashlib.blake2b(body, digest_size=16, person=b"piece")
                        found.append(
                            {
                                **r,
                                "anchor": int.from_bytes(core, "little", signed=True),
                                "piece": name.digest(),
                                "start": first,
                                "id": t.as_py(),
                                "at": at + first,
                                "size": end - first + 1,
                            }
                        )
                yield pa.RecordBatch.from_pylist(found, schema)

    ids = heavy.select("id").distinct()
    held = sized_join(texts.select("id", "z"), ids, "id", small_size=measure(ids))
    joined = by_text.join(held, "id").select("id", "z", "runs")
    return joined.mapInArrow(gathered(cut), PIECES)


def stretches(wanted: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """The text of each wanted run: rows of ``STRETCHES``."""
    fields = ["run", "anchor", "salt", "alone", "whole", "owner", "at", "size"]
    by_text = wanted.groupBy("id").agg(F.collect_list(F.struct(*fields)).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for z, mine in zip(batch.column("z"), batch.column("runs"), strict=True):
                text = tool.decompress(z.as_py())
                columns = {c: mine.values.field(k) for k, c in enumerate(fields)}
                at, size = columns.pop("at").to_numpy(), columns.pop("size").to_numpy()
                ends = (at + size - 1 + length).tolist()
                body = [text[a:b] for a, b in zip(at.tolist(), ends, strict=True)]
                yield pa.record_batch(columns | {"body": pa.array(body, pa.binary())})

    joined = by_text.join(texts.select("id", "z"), "id").select("z", "runs")
    return joined.mapInArrow(gathered(cut), STRETCHES)


def repeated_windows(
    bodies: list[bytes], length: int = LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a suffix array over the ``bodies``: windows in order, and class of each.

    Returns body number, place in the body and class number of every window.
    """
    lengths = np.array([len(b) for b in bodies], np.int64)
    line = np.frombuffer(b"\x00".join([*bodies, b""]), np.uint8).astype(np.uint16) + 1
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    line[starts + lengths] = 0
    row = Row(line, length)
    owner = np.repeat(np.arange(len(bodies)), lengths + 1)
    place = np.arange(len(line)) - starts[owner]
    window = place + length <= lengths[owner]
    order = suffix_array(row, window)
    order = order[window[order]]
    same = row.alike(order[:-1], order[1:], length)
    label = np.cumsum(np.concatenate([[0], (~same).astype(np.int64)]))
    return owner[order], place[order], label


def repeated(label: np.ndarray, owner: np.ndarray, across: bool) -> np.ndarray:
    """Whether each window's class, numbered by ``label`` in order, has another; with ``across``,
    one of another text."""
    if not across:
        return np.bincount(label)[label] > 1
    first = np.flatnonzero(np.diff(label, prepend=-1)) if len(label) else np.empty(0, np.int64)
    if not len(first):
        return np.zeros(0, bool)
    low, high = np.minimum.reduceat(owner, first), np.maximum.reduceat(owner, first)
    return ((low != high) | (low == MANY))[label]


def sorted_repeats(gathered_runs: DataFrame, length: int, across: bool) -> DataFrame:
    """Rows of ``FOUND``: windows of a run that repeat, or that other sub-groups may have.

    ``spots`` with ``repeats`` are places of a run that repeat within its sub-group. For an
    anchor of several sub-groups, ``window`` is the digest of a window and ``spots`` the place
    of one, to be compared; those that repeat already only tell others.
    """
    schema = pa.schema(
        [("run", pa.binary()), ("window", pa.binary())]
        + [("spots", pa.list_(pa.int32())), ("repeats", pa.bool_()), ("owner", pa.int64())]
    )

    def solve(held: list[dict]) -> pa.RecordBatch:
        bodies = [r["body"] for r in held]
        body, place, label = repeated_windows(bodies, length)
        text = np.array([r["owner"] for r in held], np.int64)[body]
        twice = repeated(label, text, across)
        out = {"run": [], "window": [], "spots": [], "repeats": [], "owner": []}
        turn = np.argsort(body[twice], kind="stable")
        owners, places = body[twice][turn], place[twice][turn]
        bounds = np.concatenate([[True], owners[1:] != owners[:-1], [True]])
        cuts = np.flatnonzero(bounds) if len(owners) else []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            r = held[owners[a]]
            if not r["whole"]:
                out["run"].append(r["run"])
                out["window"].append(None)
                out["spots"].append(np.sort(places[a:b]).astype(np.int32))
                out["repeats"].append(True)
                out["owner"].append(r["owner"])
        split = np.array([not r["alone"] for r in held])
        if split.any():
            once = np.concatenate([[True], label[1:] != label[:-1]]) & split[body]
            for k in np.flatnonzero(once).tolist():
                r, p = held[body[k]], int(place[k])
                digest = hashlib.blake2b(r["body"][p : p + length], digest_size=16).digest()
                out["run"].append(r["run"])
                out["window"].append(digest)
                out["spots"].append([p])
                out["repeats"].append(bool(twice[k]) or r["whole"])
                out["owner"].append(MANY if twice[k] else r["owner"])
        return rows(schema, **{c: pa.array(v, schema.field(c).type) for c, v in out.items()})

    def sort_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for r in batch.to_pylist():
                group = (r["anchor"], r["salt"])
                if size >= CHUNK and group != last:
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r["body"])
                last = group
        if held:
            yield solve(held)

    return (
        gathered_runs.repartition("anchor", "salt")
        .sortWithinPartitions("anchor", "salt")
        .mapInArrow(sort_groups, FOUND)
    )


def sharing(distinct: DataFrame) -> DataFrame:
    """The ``distinct`` stretches whose anchor others have too; ``k`` of them have it.

    Those of an anchor whose stretches all repeat as a whole have nothing left to find.
    """
    several = distinct.groupBy("anchor").agg(F.count("*").alias("k"), F.every("whole").alias("done"))
    several = several.where("k > 1 and not done").select("anchor", "k")
    owner = F.when(F.col("spread"), F.lit(MANY)).otherwise(F.col("where.id")).alias("owner")
    return distinct.join(several, "anchor").select(
        "run", "anchor", "k", "m", "whole", owner, "where.id", "where.at", "where.size"
    )


def of_runs(parts: DataFrame, each: DataFrame, part: DataFrame) -> DataFrame:
    """Rows ``run, spots`` for the runs that ``parts`` are cut from, of what their pieces repeat."""
    every = F.sequence(F.lit(0), F.col("where.size") - 1)
    marked = each.where("whole").select(F.col("run").alias("piece"), every.alias("spots"))
    marked = marked.union(part.select("run", "spots"))
    spots = F.transform("spots", lambda x: x + F.col("start")).alias("spots")
    found = parts.where("not whole").join(marked, "piece").select("run", spots)
    return found.groupBy("run").agg(F.flatten(F.collect_list("spots")).alias("spots"))


def repeats(named: DataFrame, texts: DataFrame, length: int, across: bool) -> DataFrame:
    """Rows ``id, runs``: runs of each distinct text with the places where a repeated window starts."""
    distinct = named.groupBy("run").agg(
        F.min("anchor").alias("anchor"),
        F.sum("m").alias("m"),
        F.min(F.struct("id", "at", "size")).alias("where"),
        ((F.min("id") < F.max("id")) | (F.max("m") > 1)).alias("spread"),
    )
    distinct = distinct.withColumn("whole", F.col("spread") if across else F.col("m") > 1)
    distinct = stored(distinct, "repeat-stretches")
    near = stored(sharing(distinct), "repeat-shared")
    heavy, parts = near.where(F.col("k") > GROUP), None
    if not heavy.isEmpty():
        parts = stored(pieces(heavy, texts, length), "repeat-pieces")
        low, high = F.min("owner"), F.max("owner")
        each = parts.groupBy(F.col("piece").alias("run")).agg(
            F.min("anchor").alias("anchor"),
            F.sum("m").alias("m"),
            F.min(F.struct("id", "at", "size")).alias("where"),
            ((low < high) | (low == MANY)).alias("spread"),
        )
        each = each.withColumn("whole", F.col("spread") if across else F.col("m") > 1)
        each = stored(each, "repeat-each")
        near = near.where(F.col("k") <= GROUP).unionByName(sharing(each))
    groups = F.ceil(F.col("k") / GROUP).cast("int")
    wanted = near.select(
        "id",
        "at",
        "size",
        "run",
        "anchor",
        F.pmod(F.xxhash64("run"), groups).cast("int").alias("salt"),
        (groups == 1).alias("alone"),
        "whole",
        "owner",
    )
    ways = stretches(wanted, texts, length)
    found = stored(sorted_repeats(ways, length, across), "repeat-windows")
    digests = found.where("window is not null")
    owners = [F.min("owner").alias("low"), F.max("owner").alias("high")]
    shared = digests.groupBy("window").agg(F.count("*").alias("k"), *owners)
    others = "low <> high or low = -1" if across else "k > 1"
    shared = shared.where(f"k > 1 and ({others})").select("window")
    more = digests.where("not repeats").join(shared, "window").select("run", "spots")
    part = (
        found.where("window is null").select("run", "spots").union(more)
        .groupBy("run").agg(F.flatten(F.collect_list("spots")).alias("spots"))
    )
    if parts is not None:
        part = part.unionByName(of_runs(parts, each, part))
    whole = distinct.where("whole").select("run", F.lit(None).cast("array<int>").alias("spots"))
    marked = whole.unionByName(part.join(whole.select("run"), "run", "left_anti"))
    return (
        named.select("id", "at", "size", "run")
        .join(marked, "run")
        .groupBy("id")
        .agg(F.collect_list(F.struct("at", "size", "spots")).alias("runs"))
    )


def long_runs(data: bytes, gone: np.ndarray, words: int) -> np.ndarray:
    """``gone`` without the runs that hold fewer than ``words`` whole words."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    out = gone.copy()
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        whole = len(data[a:b].split())
        whole -= a > 0 and bool(data[a - 1 : a].strip()) and bool(data[a : a + 1].strip())
        whole -= b < len(data) and bool(data[b - 1 : b].strip()) and bool(data[b : b + 1].strip())
        if whole < words:
            out[a:b] = False
    return out


def covered(n: int, found: pa.ListScalar, length: int) -> np.ndarray:
    """Whether each of ``n`` bytes is in a repeated window."""
    if not found.is_valid:
        return np.zeros(n, bool)
    at, size = (found.values.field(c).to_numpy() for c in ("at", "size"))
    spots = found.values.field("spots")
    whole = spots.is_null().to_numpy(zero_copy_only=False)
    several = pc.fill_null(pc.list_value_length(spots), 0).to_numpy(zero_copy_only=False)
    single = np.repeat(at, several) + spots.flatten().to_numpy()
    first = np.concatenate([at[whole], single])
    end = np.concatenate([(at + size - 1)[whole], single]) + length
    return np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:-1] > 0


def n_spans(gone: np.ndarray) -> int:
    return int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())


def cleaned(
    docs: DataFrame,
    text: str = "text",
    as_text: bool = False,
    length: int = LENGTH,
    across: bool = False,
    words: int = 0,
    passage: dict | None = None,
) -> DataFrame:
    """Rows ``t, n_removed, n_spans, left`` for each distinct text with a repeat.

    ``left`` holds the bytes, or with ``as_text`` the characters that no cut went through. A
    ``passage`` with its own ``length``, below the other, ``across`` and ``words`` is not removed: with
    it there are also ``n_passage_bytes`` and ``n_passages``, what it alone would remove.
    """
    least = passage["length"] if passage else length
    if least < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}, got {least}")
    if passage and least >= length:
        raise ValueError(f"passages must be shorter than {length}, got {least}")
    texts = distinct_texts(docs, text, least)
    longer = length if passage else None
    every = stored(runs(texts, least, longer), "repeat-runs")
    named = stored(named_runs(every, texts, least, longer), "repeat-named")
    columns = ["id", "at", "size", "anchor", "run", "m"]
    if passage:
        short = repeats(named.select(columns), texts, least, passage["across"])
        long = named.where("long_size > 0").select(
            "id",
            F.col("long_at").alias("at"),
            F.col("long_size").alias("size"),
            "anchor",
            F.col("long_run").alias("run"),
            "m",
        )
        long = repeats(long, texts, length, across)
        found = long.join(short.withColumnRenamed("runs", "short"), "id", "full")
    else:
        found = repeats(named, texts, length, across).withColumn("short", F.lit(None).cast("int"))
    counts = ["n_removed", "n_spans"] + (["n_passage_bytes", "n_passages"] if passage else [])

    def dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            out = {c: [] for c in [*counts, "left"]}
            columns = (batch.column(c) for c in ("z", "runs", "short"))
            for z, mine, short in zip(*columns, strict=True):
                data = np.frombuffer(tool.decompress(z.as_py()), np.uint8)
                gone = covered(len(data), mine, length)
                if words:
                    gone = long_runs(data.tobytes(), gone, words)
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(n_spans(gone))
                left = data[~gone].tobytes()
                out["left"].append(left.decode(errors="ignore") if as_text else left)
                if passage:
                    said = covered(len(data), short, least)
                    said = long_runs(data.tobytes(), said, passage["words"])
                    out["n_passage_bytes"].append(int(said.sum()))
                    out["n_passages"].append(n_spans(said))
            kind = pa.string() if as_text else pa.binary()
            yield pa.record_batch(
                {"t": batch.column("t")}
                | {c: pa.array(out[c], pa.int64()) for c in counts}
                | {"left": pa.array(out["left"], kind)}
            )

    joined = found.join(texts.select("id", "t", "z"), "id")
    joined = joined.select("t", "z", "runs", "short")
    kind = "string" if as_text else "binary"
    numbers = "".join(f"{c} long, " for c in counts)
    return joined.mapInArrow(dropped, f"t binary, {numbers}left {kind}")


def repeat_counts(
    docs: DataFrame, text: str = "text", length: int = LENGTH, passage: dict | None = None
) -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    With a ``passage``, say ``PASSAGE``, also with ``n_passages`` and ``n_passage_bytes``: the passages
    that other documents have, counted and not removed.
    """
    more = ["n_passages", "n_passage_bytes"] if passage else []
    outputs = ("n_bytes", "n_removed", "n_spans", "kept_sha256", *more, text)
    kept = [c for c in docs.columns if c not in outputs]
    column = F.col(f"`{text}`")
    whole = F.coalesce(column, F.lit(""))
    keyed = renamed(
        docs,
        kept,
        t=text_key(column),
        n_bytes=F.octet_length(whole).cast("long"),
        own=F.sha2(whole.cast("binary"), 256),
    )
    lost = cleaned(docs, text, length=length, passage=passage)
    lost = lost.select("t", "n_removed", "n_spans", *more, F.sha2("left", 256).alias("sha"))
    return restored(
        keyed.join(lost, "t", "left"),
        kept,
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("sha", "own").alias("kept_sha256"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in more),
    )


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    across: bool = False,
    words: int = 0,
) -> DataFrame:
    """``docs`` with the bytes left of each text; characters that a cut went through go too.

    A text of which nothing is left is empty.
    """
    lost = cleaned(docs, text, True, length, across, words).select("t", "left")
    keyed = renamed(docs, docs.columns, t=text_key(F.col(f"`{text}`")))
    found = keyed.join(lost, "t", "left")
    return found.select(
        *(
            (F.coalesce("left", f"k{i}") if c == text else F.col(f"k{i}")).alias(c)
            for i, c in enumerate(docs.columns)
        )
    )
