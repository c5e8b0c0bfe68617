"""Language-model scoring by prediction by partial matching over bytes.

A text is its UTF-8 bytes and an end mark. The model is a trie of the byte contexts of up to
``ORDER`` bytes, with the count of each symbol after each context over all training texts. A
symbol is predicted by the longest context seen in training; where it never followed that,
the escape probability (method C: kinds of symbols over symbols and kinds) is paid and the next
shorter context is asked, without the symbols that the longer one has already ruled out. Below
the empty context all symbols left are alike. The score adds up the log10 probabilities.

Contexts nest: whatever follows a context follows its suffixes, so all that an escape costs
depends on the context alone, and the probability of a symbol on its context and itself.
So each distinct string of ``ORDER + 1`` bytes needs one number. Blocks send their distinct
strings to buckets by hash, the trie's levels are aggregated and joined as tables, and
the numbers return to the blocks; neither the trie nor the vocabulary is broadcast.

The base score is that of single words with add-half smoothing, from the same exchange.

Null texts are empty and have the end mark alone. Rows may repeat. Without training texts all
symbols are alike. An empty table gives an empty result. Output columns replace
input columns of the same name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import (
    blocks,
    by_part,
    hashes,
    mixed,
    pack,
    pack_numbers,
    pack_strings,
    parts_of,
    renamed,
    restored,
    rows,
    strings,
    text_bytes,
    unpack,
    unpack_numbers,
    unpack_strings,
    words_of,
)
from tristrata.llm.storage import stored

ORDER = 5
#: The end mark, a byte that no UTF-8 text has; also stands before the first byte.
END = 0xFF
SYMBOLS = 256
#: Bytes of text whose strings a task counts together; smaller blocks take less memory.
LM_BLOCK = 5 << 20
#: Small partitions are read together up to about as much: each would send strings of its own.
LEAST_BLOCK = LM_BLOCK * 3 // 4
TEXTS, STRINGS, WORDS = 0, 1, 2

REQUESTS = pa.schema(
    [
        ("block", pa.string()),
        ("part", pa.int32()),
        ("grams", pa.binary()),
        ("gram_n", pa.binary()),
        ("words", pa.binary()),
        ("word_n", pa.binary()),
        ("tokens", pa.int64()),
        ("texts", pa.int64()),
    ]
)
ANSWERS = "block string, part int, kind int, payload binary"


def grams(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """String of ``order + 1`` bytes up to each symbol, and how many symbols each text has."""
    offsets, data = strings(texts)
    sizes = np.diff(offsets).astype(np.int64)
    n = len(sizes)
    line = np.full(len(data) + order * (n + 1), END, np.uint8)
    kept = np.ones(len(line), bool)
    starts = offsets[:-1] + order * np.arange(1, n + 1, dtype=np.int64)
    kept[:order] = False
    ends = starts + sizes
    for k in range(order):  # the marks after a text; the first of them is its end
        kept[ends + k] = k == 0
    body = kept.copy()
    body[ends] = False
    line[body] = data
    del body
    gram = np.zeros(len(line) - order, np.uint64)
    for k in range(order + 1):
        gram = (gram << np.uint64(8)) | line[k : len(line) - order + k]
    return gram[kept[order:]], sizes + 1


def numbered(texts: pa.Array, order: int, parts: int):
    """Distinct strings in bucket order, the place of each symbol's string, and symbols by text."""
    gram, sizes = grams(texts, order)
    found = pa.array(gram).dictionary_encode()
    del gram
    names = found.dictionary.to_numpy()
    part = (mixed(names) % np.uint64(parts)).astype(np.int64)
    turn = np.lexsort((names, part))
    place = np.empty(len(turn), np.int32)
    place[turn] = np.arange(len(turn), dtype=np.int32)
    borders = np.searchsorted(part[turn], np.arange(parts + 1))
    return names[turn], borders, place[found.indices.to_numpy()], sizes


def numbered_words(texts: pa.Array, parts: int):
    """The same for lower-case words."""
    counts, words = words_of(pc.ascii_lower(texts))
    turn, borders = by_part((hashes(words.dictionary) % np.uint64(parts)).astype(np.int64), parts)
    place = np.empty(len(turn), np.int32)
    place[turn] = np.arange(len(turn), dtype=np.int32)
    return words.dictionary.take(pa.array(turn)), borders, place[words.indices.to_numpy()], counts


def pack_sorted(names: np.ndarray) -> bytes:
    return pack_numbers(np.diff(names, prepend=np.uint64(0)))


def unpack_sorted(payload: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(payload)[0], dtype=np.uint64)


def sums_by(text_sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum over each text; ``values`` holds the texts' values one after the other."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(text_sizes)
    return total[ends] - total[ends - text_sizes]


def log_probabilities(counted: DataFrame, order: int) -> DataFrame:
    """Rows ``part, g, logp`` for rows ``part, g, n``: strings with their training counts.

    Strings with ``n`` = 0 occur only in texts that are scored and take the escapes.
    """

    def tail(j: int) -> Column:  # the last j + 1 bytes of g
        return F.col("g").bitwiseAND(F.lit((1 << (8 * (j + 1))) - 1))

    level = {order: counted.where("n > 0").select("g", "n")}
    for j in range(order - 1, -1, -1):  # each level is read several times, also by the next
        sums = level[j + 1].groupBy(tail(j).alias("g")).agg(F.sum("n").alias("n"))
        level[j] = stored(sums, "lm-level")
    contexts = {}
    for j in range(order, -1, -1):
        here = level[j].withColumn("c", F.shiftright("g", 8))
        if j:
            shorter = level[j - 1].select(F.col("g").alias("p"), F.col("n").alias("m"))
            here = here.join(shorter, tail(j - 1) == F.col("p"))
        else:
            here = here.withColumn("m", F.lit(0))
        contexts[j] = here.groupBy("c").agg(
            F.sum("n").alias("t"), F.count("*").alias("d"), F.sum("m").alias("m")
        )
    seen = (
        counted.where("n > 0")
        .withColumn("c", F.shiftright("g", 8))
        .join(contexts[order], "c")
        .select("part", "g", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("logp"))
    )
    # what the context above rules out: how many symbols (out_d), with what counts here (out_n)
    left = counted.where("n = 0").select(
        "part", "g", F.lit(0.0).alias("logp"), F.lit(False).alias("done"),
        F.lit(0).cast("long").alias("out_d"), F.lit(0).cast("long").alias("out_n"),
    )
    for j in range(order, -1, -1):
        counts = level[j].select(F.col("g").alias("h"), F.col("n").alias("hit"))
        left = (
            left.withColumn("h", tail(j))
            .withColumn("c", F.shiftright("h", 8))
            .join(contexts[j], "c", "left")
            .join(counts, "h", "left")
        )
        new = F.coalesce(F.col("d"), F.lit(0)) - F.col("out_d")  # kinds not ruled out
        whole = F.col("t") - F.col("out_n") + new
        asked = ~F.col("done") & (new > 0)
        gain = F.log10(F.coalesce(F.col("hit"), new) / whole)
        left = left.select(
            "part",
            "g",
            (F.col("logp") + F.when(asked, gain).otherwise(0.0)).alias("logp"),
            (F.col("done") | (asked & F.col("hit").isNotNull())).alias("done"),
            F.coalesce("d", F.lit(0)).cast("long").alias("out_d"),
            F.coalesce("m", F.lit(0)).cast("long").alias("out_n"),
        )
    rest = F.when(~F.col("done"), -F.log10(F.lit(SYMBOLS) - F.col("out_d"))).otherwise(0.0)
    return seen.unionByName(left.select("part", "g", (F.col("logp") + rest).alias("logp")))


def score(
    docs: DataFrame, held_out: Column, text: str = "text", order: int = ORDER
) -> DataFrame:
    """``docs`` without ``text``, with ``held_out``, token counts, ``base_score`` and ``score``.

    ``n_bytes`` counts bytes and end mark, ``n_tokens`` words and end, ``n_known`` those seen in
    training and ``train_tokens`` all tokens of training. Rows learn where ``held_out`` is false.
    """
    outputs = ("held_out", "n_bytes", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c not in (*outputs, text)]
    held_out = F.coalesce(held_out, F.lit(False))
    docs = renamed(docs, kept, held_out=held_out, text=F.col(f"`{text}`"))
    inner = docs.columns[:-1]
    total = text_bytes(docs, "text")
    parts = parts_of(total)
    docs = docs.coalesce(max(1, -(-total // LEAST_BLOCK)))

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, texts in blocks(batches, "text", LM_BLOCK):
            learns = ~table.column("held_out").to_numpy().astype(bool)
            names, at, place, sizes = numbered(texts, order, parts)
            n = np.bincount(place[np.repeat(learns, sizes)], minlength=len(names))
            del place
            words, word_at, word_place, counts = numbered_words(texts, parts)
            m = np.bincount(word_place[np.repeat(learns, counts)], minlength=len(words))
            del word_place
            tokens = int(counts[learns].sum() + learns.sum())
            for p in range(parts):
                a, b, c, d = at[p], at[p + 1], word_at[p], word_at[p + 1]
                if p and a == b and c == d:
                    continue
                yield rows(
                    REQUESTS,
                    block=[name],
                    part=[p],
                    grams=[pack_sorted(names[a:b])],
                    gram_n=[pack_numbers(n[a:b].astype(np.uint32))],
                    words=[pack_strings(words.slice(c, d - c))],
                    word_n=[pack_numbers(m[c:d].astype(np.uint32))],
                    tokens=[0 if p else tokens],
                    texts=[0 if p else int(learns.sum())],
                )

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, table, texts in blocks(batches, "text", LM_BLOCK):
            head = {c: table.column(c) for c in inner}
            yield pa.record_batch(
                {
                    "block": [name],
                    "part": pa.array([-1], pa.int32()),
                    "kind": pa.array([TEXTS], pa.int32()),
                    "payload": [pack(**head, text=texts)],
                }
            )

    def count_words(table: pa.Table) -> pa.Table:
        asked = [unpack_strings(x.as_py()) for x in table.column("words")]
        counts = [unpack_numbers(x.as_py())[0] for x in table.column("word_n")]
        words = pa.concat_arrays(asked).dictionary_encode()
        number = words.indices.to_numpy()
        total = np.bincount(number, np.concatenate(counts), minlength=len(words.dictionary))
        ends = np.cumsum([len(x) for x in asked])
        out = [
            pack_numbers(total[number[end - len(x) : end]].astype(np.uint64))
            for x, end in zip(asked, ends, strict=True)
        ]
        kinds = np.zeros(len(out), np.int64)
        kinds[0] = np.count_nonzero(total)
        return pa.table(
            {
                "block": table.column("block"),
                "part": table.column("part"),
                "payload": out,
                "kinds": kinds,
            }
        )

    def sum_grams(table: pa.Table) -> pa.Table:
        names = np.concatenate([unpack_sorted(x.as_py()) for x in table.column("grams")])
        counts = [unpack_numbers(x.as_py())[0] for x in table.column("gram_n")]
        counts = np.concatenate(counts)
        found = pa.array(names).dictionary_encode()
        total = np.bincount(found.indices.to_numpy(), counts, minlength=len(found.dictionary))
        part = np.full(len(total), table.column("part")[0].as_py(), np.int32)
        return pa.table(
            {"part": part, "g": found.dictionary.cast(pa.int64()), "n": total.astype(np.int64)}
        )

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        known = known.sort_by("g")
        g, logp = known.column("g").to_numpy(), known.column("logp").to_numpy().astype(np.float32)
        out = []
        for x in asked.column("grams"):
            names = unpack_sorted(x.as_py()).astype(np.int64)
            out.append(pack_numbers(logp[np.searchsorted(g, names)]))
        return pa.table(
            {"block": asked.column("block"), "part": asked.column("part"), "payload": out}
        )

    def assemble(table: pa.Table) -> pa.Table:
        table = table.sort_by([("kind", "ascending"), ("part", "ascending")])
        kind = table.column("kind").to_numpy()
        got = [x.as_py() for x in table.column("payload")]
        if kind[0] != TEXTS or (kind == TEXTS).sum() > 1:
            raise RuntimeError("a block lacks its texts: the input changed between two reads")
        head = unpack(got[0])
        got = [[], *(unpack_numbers(x)[0] for x in got[1:])]
        texts = head.column("text")
        _, borders, place, sizes = numbered(texts, order, parts)
        logp = [x for x, k in zip(got, kind, strict=True) if k == STRINGS]
        logp = np.concatenate(logp)
        if len(logp) != borders[-1]:
            raise RuntimeError("a block lacks strings: the input changed between two reads")
        total = sums_by(sizes, logp[place])
        del place
        _, borders, place, counts = numbered_words(texts, parts)
        seen = [x for x, k in zip(got, kind, strict=True) if k == WORDS]
        seen = np.concatenate(seen).astype(np.float64)
        if len(seen) != borders[-1]:
            raise RuntimeError("a block lacks words: the input changed between two reads")
        columns = [head.column(c) for c in inner]
        columns += [
            pa.array(sizes),
            pa.array(counts.astype(np.int64)),
            pa.array(sums_by(counts, seen[place] > 0).astype(np.int64)),
            pa.array(sums_by(counts, np.log10(seen + 0.5)[place])),
            pa.array(total),
        ]
        names = [*inner, "n_bytes", "n_words", "n_seen", "logs", "score"]
        return pa.Table.from_arrays(columns, names=names)

    asked = stored(
        docs.mapInArrow(
            requests,
            "block string, part int, grams binary, gram_n binary, words binary, word_n binary, "
            "tokens long, texts long",
        ),
        "lm-requests",
    )
    words = stored(
        asked.select("block", "part", "words", "word_n")
        .groupBy("part")
        .applyInArrow(count_words, "block string, part int, payload binary, kinds long"),
        "lm-words",
    )
    counted = stored(
        asked.select("part", "grams", "gram_n")
        .groupBy("part")
        .applyInArrow(sum_grams, "part int, g long, n long"),
        "lm-strings",
    )
    known = log_probabilities(counted, order)
    answers = (
        asked.select("block", "part", "grams")
        .groupBy("part")
        .cogroup(known.groupBy("part"))
        .applyInArrow(answer, "block string, part int, payload binary")
        .withColumn("kind", F.lit(STRINGS))
    )
    whole = (
        docs.mapInArrow(headers, ANSWERS)
        .unionByName(answers)
        .unionByName(words.drop("kinds").withColumn("kind", F.lit(WORDS)))
    )
    schema = T.StructType(
        [docs.schema[c] for c in inner]
        + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_words", "n_seen")]
        + [T.StructField(c, T.DoubleType()) for c in ("logs", "score")]
    )
    scored = whole.groupBy("block").applyInArrow(assemble, schema)
    # one row each: tokens and texts of training, distinct words
    tokens, learned = asked.agg(F.sum("tokens"), F.sum("texts")).first()
    kinds = words.agg(F.sum("kinds")).first()[0]
    tokens, learned, kinds = tokens or 0, learned or 0, (kinds or 0) + bool(learned)
    whole_log = float(np.log10(tokens + 0.5 * (kinds + 1)))
    n_tokens = F.col("n_words") + 1
    base = F.col("logs") + float(np.log10(learned + 0.5)) - n_tokens * whole_log
    return restored(
        scored,
        kept,
        "held_out",
        "n_bytes",
        n_tokens.alias("n_tokens"),
        (F.col("n_seen") + int(bool(learned))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
