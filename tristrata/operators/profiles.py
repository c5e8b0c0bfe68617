"""Profiles of a table by day that unite over any range without reading the table again.

A profile has one row for each day of a load: rows, missing values by field, the range of an
amount, and two sketches, one that estimates distinct keys (within about 2 %, ``2**12`` registers)
and one for quantiles of the amount (ranks within about 1.7 %, ``k`` 200). Sketches of several
days and loads unite into that of all their rows, and are small whatever the table holds.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.operators.audit import null_counts
from tristrata.schema import REQUIRED_FIELDS

DAY = "day"


def profile_by_day(
    df: DataFrame,
    date: str = "visit_date",
    key: str = "patient_id",
    amount: str = "billing_amount",
    fields: tuple[str, ...] = REQUIRED_FIELDS,
) -> DataFrame:
    """The profile of ``df``, a row for each day; rows without a date have one of their own.

    NULL keys are no key, NULL and NaN amounts no amount.
    """
    number = F.when(~F.isnan(amount), F.col(amount).cast("double")).alias("_amount")
    marked = df.select("*", F.col(date).alias(DAY), number)
    return marked.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("rows"),
        *null_counts(fields),
        F.min("_amount").alias("least"),
        F.max("_amount").alias("greatest"),
        F.hll_sketch_agg(key).alias("keys"),
        F.expr("kll_sketch_agg_double(_amount)").alias("amounts"),
    )


def add_profile(profile: DataFrame, path: str) -> None:
    """Store the profile of a load beside those of earlier ones."""
    profile.coalesce(1).write.mode("append").parquet(path)


def united(
    profiles: DataFrame,
    start: str | None = None,
    end: str | None = None,
    quantiles: tuple[float, ...] = (0.1, 0.5, 0.9),
    fields: tuple[str, ...] = REQUIRED_FIELDS,
) -> DataFrame:
    """One row for all days of an inclusive range: counts, range, distinct keys, quantiles.

    Without an end of the range, days without a date count too. Estimates of no rows are 0
    and NULL.
    """
    for bound, keep in ((start, ">="), (end, "<=")):
        if bound is not None:
            profiles = profiles.where(F.expr(f"{DAY} {keep} DATE'{bound}'"))
    whole = profiles.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        *(F.coalesce(F.sum(f"null_{f}"), F.lit(0)).alias(f"null_{f}") for f in fields),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_union_agg("keys").alias("keys"),
        F.expr("kll_merge_agg_double(amounts)").alias("amounts"),
    )
    known = F.col("least").isNotNull()
    values = [
        F.when(known, F.expr(f"kll_sketch_get_quantile_double(amounts, {q}D)")).alias(name)
        for q, name in ((q, f"q{round(100 * q)}") for q in quantiles)
    ]
    return whole.select(
        "rows",
        *(f"null_{f}" for f in fields),
        "least",
        "greatest",
        F.coalesce(F.hll_sketch_estimate("keys"), F.lit(0)).alias("keys"),
        *values,
    )
