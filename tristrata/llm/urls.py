"""URL filter: host rules first, then a ratio of two character language models.

Rules name a host and the beginning of a path; the longest that fits decides. URLs that a
rule accepts and those that one rejects teach two smoothed Markov models of variable order:
the probability of a character blends orders 0 to ``ORDER``, each weighted by how often its
context was seen (Witten-Bell). The difference of the two log-likelihoods for each character decides
the rest, against a threshold calibrated on URLs kept out of the counts.

Characters fold into ``SYMBOLS`` classes, so the counts of all URLs fit a table of fixed size
(``SYMBOLS ** (ORDER + 1)`` cells) whatever the input; only that table is broadcast. Counting
sums in the map tasks and over a shuffle by cell.

A null URL, or one without ``://``, has empty host and path and fits no rule; a null one is
scored as the empty text. Without URLs of both kinds the ratio is 0 and everything is allowed. Repeated
rows are judged alike, and counted as often as they occur. Output columns replace input
columns of the same name.
"""

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import renamed, restored, rows, strings

ORDER = 3
PLAIN = b"abcdefghijklmnopqrstuvwxyz-./_?=&%#:"
#: The border of a URL, the plain characters, digits as one, and all other bytes as one.
SYMBOLS = len(PLAIN) + 3
CELLS = SYMBOLS ** (ORDER + 1)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Thresholds tried: hundredths of a natural logarithm for each character.
STEPS = 1000

CLASS = np.full(256, SYMBOLS - 1, np.int64)
CLASS[np.frombuffer(PLAIN, np.uint8)] = np.arange(1, len(PLAIN) + 1)
CLASS[np.frombuffer(UPPER.encode(), np.uint8)] = np.arange(1, 27)
CLASS[np.frombuffer(b"0123456789", np.uint8)] = len(PLAIN) + 1

Rules = tuple[tuple[str, str, str], ...]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(whole, pattern, 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(whole, pattern, 2)


def ruled(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, where, begins in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(begins)
        rule = F.when(fits, F.lit(where + begins)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def cells(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cell of each character and of the end of each URL, and how many each URL has."""
    offsets, data = strings(urls)
    sizes = np.diff(offsets)
    # each URL stands between ORDER borders, of which the first one after it is counted
    starts = offsets[:-1].astype(np.int64) + ORDER * np.arange(1, len(sizes) + 1)
    line = np.zeros(len(data) + ORDER * (len(sizes) + 1), np.int64)
    number = np.repeat(np.arange(1, len(sizes) + 1), sizes)
    line[np.arange(len(data)) + ORDER * number] = CLASS[data]
    lengths = sizes.astype(np.int64) + 1
    where = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
    cell = reduce(
        lambda total, k: total * SYMBOLS + line[where - ORDER + k], range(ORDER + 1), np.int64(0)
    )
    return cell, lengths


def counts(urls: DataFrame, url: str, accepted: str) -> DataFrame:
    """Rows ``accepted, cell, n`` over all URLs."""
    schema = pa.schema([("accepted", pa.bool_()), ("cell", pa.int32()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, CELLS), np.int64)
        for batch in batches:
            mark = batch.column(accepted).to_numpy(zero_copy_only=False).astype(bool)
            texts = pc.fill_null(batch.column(url), "")
            for side in (0, 1):
                mine = texts.filter(pa.array(mark == bool(side)))
                if len(mine):
                    cell, n = np.unique(cells(mine)[0], return_counts=True)
                    total[side][cell] += n
        for side in (0, 1):
            found = np.flatnonzero(total[side])
            sides = np.full(len(found), bool(side))
            yield rows(schema, accepted=sides, cell=found, n=total[side][found])

    partial = urls.select(url, accepted).mapInArrow(counted, "accepted boolean, cell int, n long")
    return partial.groupBy("accepted", "cell").agg(F.sum("n").alias("n"))


def log_probabilities(count: np.ndarray) -> np.ndarray:
    """Natural log of the blended probability of every cell."""
    table = count.reshape((SYMBOLS,) * (ORDER + 1)).astype(np.float64)
    blended = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        seen = table.sum(axis=tuple(range(ORDER - order)))
        total = seen.sum(axis=-1, keepdims=True)
        kinds = np.maximum((seen > 0).sum(axis=-1, keepdims=True), 1)
        blended = (seen + kinds * blended) / (total + kinds)  # broadcasts over the older character
    return np.log(blended).reshape(-1)


def ratio_table(found: DataFrame) -> np.ndarray:
    """Accepted less rejected log-probability of each cell: at most ``2 * CELLS`` rows are read."""
    total = np.zeros((2, CELLS), np.int64)
    for batch in found.toArrow().to_batches():
        side = batch.column("accepted").to_numpy(zero_copy_only=False).astype(int)
        total[side, batch.column("cell").to_numpy()] = batch.column("n").to_numpy()
    if not total.any(axis=1).all():
        return np.zeros(CELLS, np.float32)
    return (log_probabilities(total[1]) - log_probabilities(total[0])).astype(np.float32)


def ratio(df: DataFrame, url: str, table: np.ndarray, output: str) -> DataFrame:
    """``df`` with the mean of ``table`` over the characters and the end of each URL."""
    kept = [c for c in df.columns if c != output]
    frame = renamed(df, kept, url=F.col(f"`{url}`"))
    shared = df.sparkSession.sparkContext.broadcast(table)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, lengths = cells(pc.fill_null(batch.column("url"), ""))
            sums = np.concatenate([[0.0], np.cumsum(shared.value[cell].astype(np.float64))])
            ends = np.cumsum(lengths)
            mean = (sums[ends] - sums[ends - lengths]) / lengths
            names = [*batch.schema.names[:-1], "mean"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(mean)], names=names)

    schema = T.StructType([*frame.schema.fields[:-1], T.StructField("mean", T.DoubleType())])
    return restored(frame.mapInArrow(scored, schema), kept, F.col("mean").alias(output))


def threshold(scored: DataFrame, score: str, accepted: str) -> float:
    """The bound that misjudges least, each side weighing the same; 0 without both sides."""
    step = F.greatest(F.lit(-STEPS), F.least(F.lit(STEPS), F.floor(F.col(score) * 100).cast("int")))
    found = scored.groupBy(step.alias("step"), accepted).agg(F.count("*").alias("n")).collect()
    tally = np.zeros((2, 2 * STEPS + 1))
    for r in found:
        tally[int(r[accepted]), r.step + STEPS] += r.n
    if not tally.any(axis=1).all():
        return 0.0
    share = tally / tally.sum(axis=1, keepdims=True)
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(share, axis=1)], axis=1)
    missed = below[1] + 1 - below[0]  # accepted below the bound, rejected at it or above
    best = np.flatnonzero(missed <= missed.min() + 1e-12)
    return (best[np.argmin(np.abs(best - STEPS))] - STEPS) / 100


def judge(pages: DataFrame, rules: Rules, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``log_ratio`` and ``verdict``."""
    outputs = ("host", "path", "rule", "log_ratio", "verdict")
    kept = [c for c in pages.columns if c not in outputs]
    frame = renamed(pages, kept, url=F.col(f"`{url}`"))
    host, path = host_and_path(F.col("url"))
    placed = frame.withColumns({"host": host, "path": path})
    rule, said = ruled(F.col("host"), F.col("path"), rules)
    found = placed.withColumns({"rule": rule, "said": said})
    taught = found.where("said is not null").select(
        "url", (F.col("said") == "allow").alias("accepted")
    )
    apart = F.pmod(F.xxhash64("url"), F.lit(5)) == 0
    table = ratio_table(counts(taught.where(~apart), "url", "accepted"))
    calibrated = ratio(taught.where(apart), "url", table, "score")
    bound = threshold(calibrated, "score", "accepted")
    scored = ratio(found, "url", table, "score")
    verdict = F.coalesce("said", F.when(F.col("score") >= bound, "allow").otherwise("block"))
    return restored(
        scored,
        kept,
        "host",
        "path",
        "rule",
        F.col("score").alias("log_ratio"),
        verdict.alias("verdict"),
    )
