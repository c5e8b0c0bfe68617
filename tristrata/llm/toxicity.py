"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the distinct words of a text and the first letters of each is
fitted in numpy from texts confirmed toxic and from unlabelled texts, whose label is never
read. With class prior ``p`` the risk is

    p * R(positive as 1) + max(0, R(unlabelled as 0) - p * R(positive as 0)),

so toxic texts among the unlabelled ones do not count as clean ones. Where the bracket falls
below zero the fit steps back along it instead of gaining from it.

The fit sees ``MOST_POSITIVE`` and ``MOST_UNLABELLED`` rows at most, as sets of feature numbers
of four bytes each; it is one task over that bounded sample. A hash of key, text and the row's
number in the input picks them, so rows with one key, or none, are picked apart. Scoring covers
whole texts, row by row, without a shuffle.

Null and empty texts have no features and get the score of the constant alone. Rows without
a key or label are unlabelled. Repeated rows get the same score. Without any positive row
nothing is known to be toxic and every score is the prior (0 if it is unknown). Input
columns with the name of an output are replaced.
"""

import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.llm.blocks import blocks, renamed, restored, words_of

MOST_POSITIVE = 3_000
MOST_UNLABELLED = 6_000
PREFIXES = (3, 4, 5, 6)
FEATURES = 1 << 22
STEPS = 150
#: Standard errors of a difference that says nothing; features shrink towards it.
CHANCE = 3.0
RATE = 0.1
SPARSITY = 2e-5
#: How many times the rows wanted are picked by hash before the least are taken.
SPARE = 1.2
PICKED = 1 << 40
#: How feature numbers travel; bytes of sorted numbers compare as these do.
NUMBER = ">u4"
#: How many sets the fit turns into indices at once, and how much text is scored at once.
TOGETHER = 256
SCORED_BYTES = 2 << 20


def features(word: str) -> list[int]:
    """Numbers of a word and of its beginnings."""
    whole = word.encode("utf-8", "surrogatepass")
    if len(whole) == len(word):
        starts = [whole[:k] for k in PREFIXES if len(word) >= k]
    else:
        starts = [word[:k].encode("utf-8", "surrogatepass") for k in PREFIXES if len(word) >= k]
    return [zlib.crc32(x) % FEATURES for x in (whole + b" ", *starts)]


def feature_sets(df: DataFrame, text: str, label: str, turn: str) -> DataFrame:
    """Rows ``positive, features, turn``: the distinct numbers of a text, ascending, as ``NUMBER``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pc.ascii_lower(pc.fill_null(batch.column(text), ""))
            found = [
                np.array(sorted({f for w in words for f in features(w)}), NUMBER).tobytes()
                for words in (set(x.as_py().split()) for x in whole)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(label), pa.array(found, pa.binary()), batch.column(turn)],
                names=["positive", "features", "turn"],
            )

    columns = "positive boolean, features binary, turn long"
    return df.select(label, text, turn).mapInArrow(sets, columns)


def rows_times(weights: np.ndarray, index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(index) + 1)
    sums[1:] = weights[index]
    np.cumsum(sums[1:], out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def joined(sets: Sequence) -> Iterator[tuple[int, np.ndarray]]:
    """The numbers of ``TOGETHER`` sets after another, and where these sets begin."""
    for start in range(0, len(sets), TOGETHER):
        few = sets[start : start + TOGETHER]
        yield start, np.concatenate([np.asarray(x, np.int64) for x in few])


def evident(positive: Sequence, unlabelled: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """Features whose shares of positive and unlabelled texts differ, and what is left of each.

    A feature counts by the standard errors ``z`` between its two shares, as ``(1 - (CHANCE / z)**2)**2``:
    one that few texts have is held back as far as they leave it uncertain, and whether it is
    used depends on that alone, not on a number of texts.
    """
    counts = np.zeros((2, FEATURES), np.int32)
    for side, sets in enumerate((positive, unlabelled)):
        for _, flat in joined(sets):
            np.add.at(counts[side], flat, 1)
    seen = np.flatnonzero(counts.any(axis=0))
    counts = counts[:, seen]
    sizes = [max(1, len(positive)), max(1, len(unlabelled))]
    both = (counts[0] + counts[1]) / sum(sizes)
    error = np.sqrt(both * (1 - both) * (1 / sizes[0] + 1 / sizes[1])) + 1e-12
    z = np.abs(counts[0] / sizes[0] - counts[1] / sizes[1]) / error
    used = z > CHANCE
    return seen[used], (1 - (CHANCE / z[used]) ** 2) ** 2


def fit(positive: Sequence, unlabelled: Sequence, prior: float) -> dict[int, float]:
    """Weights by feature number; -1 is the constant. Sets of numbers may be lists or arrays."""
    names, left = evident(positive, unlabelled)
    left = np.append(left, 1.0)
    place = np.full(FEATURES, -1, np.int32)
    place[names] = np.arange(len(names))

    def compact(sets: Sequence) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found, sizes = [np.empty(0, np.int64)], np.zeros(len(sets), np.int64)
        for start, flat in joined(sets):
            few = sets[start : start + TOGETHER]
            at = place[flat]
            known = np.flatnonzero(at >= 0)
            ends = np.cumsum([len(x) for x in few])
            within = np.searchsorted(known, np.concatenate([[0], ends]))
            sizes[start : start + len(few)] = np.diff(within)
            found.append(at[known].astype(np.int64))
        return np.concatenate(found), sizes, np.concatenate([[0], np.cumsum(sizes)])

    sides = [compact(positive), compact(unlabelled)]
    size = len(names) + 1
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    weights[-1] = np.log(prior / (1 - prior))

    def gradient(side: int, scale: np.ndarray) -> np.ndarray:
        at, sizes, _ = sides[side]
        out = np.bincount(at, weights=np.repeat(scale, sizes), minlength=size) * left
        out[-1] = scale.sum()
        return out

    for step in range(1, STEPS + 1):
        g = [rows_times(weights * left, at, bounds) + weights[-1] for at, _, bounds in sides]
        up = [1 / (1 + np.exp(-np.clip(x, -50, 50))) for x in g]
        n = [max(1, len(x)) for x in g]
        as_clean = np.logaddexp(0, g[1]).sum() / n[1] - prior * np.logaddexp(0, g[0]).sum() / n[0]
        bracket = gradient(1, up[1] / n[1]) - gradient(0, prior * up[0] / n[0])
        if as_clean >= 0:
            slope = gradient(0, prior * (up[0] - 1) / n[0]) + bracket
        else:
            slope = -bracket
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= RATE * move
        shrink = RATE * SPARSITY / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - shrink[:-1], 0)
    weights = weights * left
    found = np.flatnonzero(weights[:-1])
    return {int(names[k]): float(weights[k]) for k in found} | {-1: float(weights[-1])}


def sampled(train: DataFrame, text: str, positive: str, turn: Column, n: int, p: int) -> DataFrame:
    """``feature_sets`` of ``p`` positive and ``n`` rows of ``train``, no more than the fit may see.

    ``turn`` is a hash by which rows are taken, from the least one on.
    """
    dealt = train.withColumn("__turn", F.pmod(turn, F.lit(PICKED)))

    def least(rows: DataFrame, size: int, most: int) -> DataFrame:
        few = rows.where(F.col("__turn") < int(PICKED * min(1.0, SPARE * most / max(1, size))))
        return feature_sets(few, text, positive, "__turn").orderBy("turn").limit(most)

    confirmed = least(dealt.where(F.col(positive)), p, MOST_POSITIVE)
    rest = least(dealt.withColumn(positive, F.lit(False)), n, MOST_UNLABELLED)
    return confirmed.unionByName(rest).drop("turn")


def learn(
    train: DataFrame, text: str, positive: str, prior: float, turn: Column
) -> dict[int, float]:
    """Weights from rows of ``train``: ``positive`` marks the confirmed ones, ``turn`` picks them."""
    n, p = train.agg(F.count("*"), F.sum(F.col(positive).cast("long"))).first()
    if not p or not 0 < prior < 1:
        return {-1: float(np.log(max(prior, 1e-9) / max(1 - prior, 1e-9)))}
    sample = sampled(train, text, positive, turn, n, p)

    def fitted(table: pa.Table) -> pa.Table:
        marks = table.column("positive")
        sides = [
            [np.frombuffer(x, NUMBER) for x in sorted(table["features"].filter(side).to_pylist())]
            for side in (marks, pc.invert(marks))
        ]
        weights = fit(*sides, prior)
        return pa.table(
            {
                "feature": pa.array(list(weights), pa.int32()),
                "weight": pa.array(list(weights.values()), pa.float64()),
            }
        )

    whole = sample.withColumn("one", F.lit(1)).groupBy("one")
    model = whole.applyInArrow(fitted, "feature int, weight double")
    return {r.feature: r.weight for r in model.collect()}


def logits(texts: pa.Array, model: dict[int, float]) -> np.ndarray:
    """The constant of ``model`` and the weights of the distinct features of each text, summed."""
    counts, words = words_of(pc.ascii_lower(texts))
    hits, sizes = array("q"), array("q")
    for w in words.dictionary.to_pylist():
        known = [f for f in features(w) if f in model]
        hits.extend(known)
        sizes.append(len(known))
    numbers, sizes = np.array(hits, np.int64), np.array(sizes, np.int64)
    number = words.indices.to_numpy()
    at = np.flatnonzero(sizes[number])
    owner = np.searchsorted(np.cumsum(counts), at, side="right")
    said = np.unique(owner * len(sizes) + number[at])
    owner, number = said // max(1, len(sizes)), said % max(1, len(sizes))
    each = sizes[number]
    skipped = np.cumsum(sizes)[number] - np.cumsum(each)
    spots = np.arange(each.sum()) + np.repeat(skipped, each)
    pairs = np.unique(np.repeat(owner, each) * FEATURES + numbers[spots])
    names, place = np.unique(pairs % FEATURES, return_inverse=True)
    weights = np.array([model[f] for f in names.tolist()], np.float64)
    out = np.full(len(texts), model[-1])
    np.add.at(out, pairs // FEATURES, weights[place])
    return out


def score(
    df: DataFrame, weights: dict[int, float], text: str = "text", output: str = "score"
) -> DataFrame:
    """``df`` with the probability of toxicity in ``output``."""
    kept = [c for c in df.columns if c != output]
    other = {} if text in kept else {"text": F.col(f"`{text}`")}
    read = "text" if other else f"k{kept.index(text)}"  # a kept text goes to Python once
    frame = renamed(df, kept, **other)
    fields = frame.schema.fields[: len(kept)]
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for _, table, texts in blocks(batches, read, SCORED_BYTES):
            out = 1 / (1 + np.exp(-np.clip(logits(texts, model), -700, 700)))
            found = table.select(range(len(fields))).append_column("score", pa.array(out))
            yield from found.to_batches()

    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    return restored(frame.mapInArrow(scored, schema), kept, F.col("score").alias(output))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``.

    Labels are read only for rows where ``held_out`` (over ``key``) is false; the prior is the
    share of positive ones among those labelled. ``labels`` may have several rows for a key;
    one positive among them confirms it.
    """
    marks = (
        labels.where(~held_out & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(F.col(label) == 1).alias("__positive"))
        .where(F.col("__key").isNotNull())
    )
    p, n = marks.agg(F.sum(F.col("__positive").cast("long")), F.count("*")).first()
    prior = (p or 0) / n if n else 0.0
    train = (
        docs.where(~held_out)
        .select(
            F.col(key).alias("__key"),
            F.col(text).alias("__text"),
            F.monotonically_increasing_id().alias("__at"),
        )
        .join(marks.where("__positive"), "__key", "left")
        .withColumn("__positive", F.coalesce("__positive", F.lit(False)))
    )
    turn = F.xxhash64("__key", "__text", "__at")
    weights = learn(train, "__text", "__positive", prior, turn)
    kept = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    marked = docs.select(*(F.col(f"`{c}`") for c in kept), held_out.alias("held_out"))
    scored = score(marked, weights, text)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
