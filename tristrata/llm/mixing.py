"""Mixing sources to target weights by Poisson replication.

A source with share ``w`` of the mixture and ``n`` of the ``N`` rows has the mean repetition
rate ``w * N / n``. Each row's count is the Poisson distribution of that mean inverted at a
number that a hash of seed, key and piece gives, so a rerun repeats it. The rows are exploded by
their counts and put in one global random order by a second hash.

Rates above ``PIECE`` are cut into equal pieces, each with its own number: a sum of Poisson
counts is Poisson again, and no row meets an unbounded distribution table. Rates are
worked out for all sources, stored, and joined as the optimizer decides by their size.

Sources without a weight share what the named ones leave, in proportion to their rows; a
null source is one source. Weights of sources that have no rows lapse. Where a key is null
or has several rows, each of them draws for itself: a digest of all its columns and the row's
number in the input are hashed with the key, so a rerun over the same stored table repeats it.
Texts are carried along, null or long. An empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.llm.blocks import renamed, row_digest
from tristrata.llm.storage import stored

PIECE = 8.0
#: Terms of the distribution of a piece: what lies beyond has less than 2**-60 in all.
TERMS = 64
DIGITS = 13
UNIT = float(16**DIGITS)


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from the MD5 of the parts."""
    text = F.concat_ws(":", *parts)
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(UNIT)


def rates(df: DataFrame, source: str, weights: dict[str, float]) -> DataFrame:
    """Rows ``__source, __rate`` for every source of ``df``."""
    total = sum(weights.values())
    if any(w < 0 for w in weights.values()) or total > 1 + 1e-9:
        raise ValueError("weights are shares: none below 0, together at most 1")
    counts = df.groupBy(F.col(f"`{source}`").alias("__source")).agg(F.count("*").alias("__n"))
    named = df.sparkSession.createDataFrame(
        list(weights.items()) or [("", 0.0)], "__name string, __w double"
    )
    known = counts.join(F.broadcast(named), F.col("__source") == F.col("__name"), "left")
    everyone, unnamed = known.agg(
        F.sum("__n"), F.sum(F.when(F.col("__w").isNull(), F.col("__n")))
    ).first()
    rest = max(0.0, 1.0 - total)
    rate = F.when(
        F.col("__w").isNotNull(), F.col("__w") * F.lit(float(everyone or 0)) / F.col("__n")
    ).otherwise(F.lit(rest * float(everyone or 0) / float(unnamed or 1)))
    return known.select("__source", rate.alias("__rate"))


def poisson(rate: Column, u: Column) -> Column:
    """The least count whose distribution function exceeds ``u``."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        start,
        lambda a, j: F.when(
            a["c"] <= u,
            F.struct(
                (a["p"] * rate / j).alias("p"),
                (a["c"] + a["p"] * rate / j).alias("c"),
                j.alias("k"),
            ),
        ).otherwise(a),
    )
    return step["k"]


def drawn_alone(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``__key``, a text that no two rows share: the key itself where it is unique."""
    own = F.col(f"`{key}`").cast("string")
    counts = df.groupBy(own.alias("__again")).count().where("__again is not null and count > 1")
    repeated = stored(counts.select("__again"), "repeated-keys")
    salt = F.monotonically_increasing_id().cast("string")
    salted = df.withColumns({"__salt": salt, "__own": own})
    # null keys find nothing; a text for each keeps them from meeting in one task
    spread = F.coalesce("__own", F.concat(F.lit("\0"), "__salt"))
    known = salted.withColumn("__spread", spread).join(
        repeated, F.col("__spread") == F.col("__again"), "left"
    )
    lone = F.col("__own").isNotNull() & F.col("__again").isNull()
    apart = F.concat_ws(":", F.coalesce("__own", F.lit("")), row_digest(df.columns), "__salt")
    named = known.withColumn("__key", F.when(lone, F.col("__own")).otherwise(apart))
    return named.drop("__salt", "__own", "__spread", "__again")


def mix(
    df: DataFrame,
    weights: dict[str, float],
    source: str = "source",
    key: str = "doc_id",
    seed: int = 7,
) -> DataFrame:
    """``df`` repeated to the ``weights``, with ``copy`` (from 0) and ``position``, in its order.

    ``position`` is a number in [0, 1) by which the copies are sorted over all partitions.
    """
    kept = [c for c in df.columns if c not in ("copy", "position")]
    own = renamed(df, df.columns)
    copied = mixed(own, weights, *(f"k{df.columns.index(c)}" for c in (source, key)), seed)
    at = [f"k{df.columns.index(c)}" for c in kept]
    return copied.select(
        *(F.col(a).alias(c) for a, c in zip(at, kept, strict=True)), "copy", "position"
    )


def mixed(df: DataFrame, weights: dict[str, float], source: str, key: str, seed: int) -> DataFrame:
    """:func:`mix` of a frame whose columns have plain names that no inner one has."""
    # stored, so that their size is known before all rows are dealt out for the join
    known = stored(rates(df, source, weights), "rates")
    keyed = drawn_alone(df, key).join(known, F.col(f"`{source}`").eqNullSafe(F.col("__source")))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("__rate") / PIECE).cast("int"))
    cut = keyed.withColumn("__pieces", pieces).withColumn(
        "__piece", F.explode(F.sequence(F.lit(0), F.col("__pieces") - 1))
    )
    drawn = cut.withColumn(
        "__count",
        poisson(
            F.col("__rate") / F.col("__pieces"),
            uniform(F.lit(f"count-{seed}"), F.col("__key"), F.col("__piece")),
        ),
    )
    copies = drawn.where("__count > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.col("__count") - 1))
    )
    # pieces number their copies apart: the copy's number counts those of earlier pieces
    numbered = copies.withColumn("__number", F.col("__copy") * F.col("__pieces") + F.col("__piece"))
    at = uniform(F.lit(f"place-{seed}"), F.col("__key"), F.col("__number"))
    return (
        numbered.select(
            *df.columns, F.col("__number").alias("copy"), at.alias("position")
        )
        .repartitionByRange("position")
        .sortWithinPartitions("position")
    )


def mixed_sql(weights: dict[str, float], table: str = "documents", seed: int = 7) -> str:
    """The same mixture of whole rows in DuckDB, where keys are unique."""
    named = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in weights.items())
    rest = max(0.0, 1.0 - sum(weights.values()))
    return f"""
WITH RECURSIVE named(name, w) AS (VALUES {named}),
counts AS (
  SELECT source, w, count(*) AS n FROM {table} LEFT JOIN named ON source = name
  GROUP BY source, w),
rates AS (
  SELECT source, CASE WHEN w IS NOT NULL THEN w * (SELECT sum(n) FROM counts)::DOUBLE / n
    ELSE {rest}::DOUBLE * (SELECT sum(n) FROM counts)::DOUBLE
         / (SELECT sum(n) FROM counts WHERE w IS NULL)::DOUBLE END AS rate
  FROM counts),
cut AS (
  SELECT source, greatest(1, ceil(rate / {PIECE})::INT) AS pieces,
    rate / greatest(1, ceil(rate / {PIECE})::INT) AS r
  FROM rates),
terms(source, k, p, c) AS (
  SELECT source, 0, exp(-r), exp(-r) FROM cut
  UNION ALL
  SELECT terms.source, k + 1, p * r / (k + 1), c + p * r / (k + 1)
  FROM terms JOIN cut ON terms.source IS NOT DISTINCT FROM cut.source WHERE k < {TERMS}),
drawn AS (
  SELECT doc_id, d.source, pieces, piece,
    ('0x' || substr(md5('count-{seed}:' || coalesce(doc_id::VARCHAR, '') || ':' || piece), 1, {DIGITS}))::BIGINT
      / {UNIT} AS u
  FROM {table} d JOIN cut ON d.source IS NOT DISTINCT FROM cut.source,
    unnest(range(0, pieces)) AS x(piece)),
counted AS (
  SELECT doc_id, drawn.source, pieces, piece, list(c ORDER BY k) AS cs, any_value(u) AS u
  FROM drawn JOIN terms ON drawn.source IS NOT DISTINCT FROM terms.source
  GROUP BY doc_id, drawn.source, pieces, piece)
SELECT whole.*, (j * pieces + piece)::INT AS copy,
  ('0x' || substr(md5('place-{seed}:' || coalesce(whole.doc_id::VARCHAR, '') || ':' || (j * pieces + piece)), 1, {DIGITS}))::BIGINT
    / {UNIT} AS "position"
FROM counted JOIN {table} AS whole ON whole.doc_id IS NOT DISTINCT FROM counted.doc_id,
  unnest(range(0, least({TERMS}, len(list_filter(cs, lambda x: x <= u))))) AS y(j)"""
