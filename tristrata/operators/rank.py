"""Competition rank over all rows, without a single-task sort of unbounded size."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.sources.scratch import store

SINGLE_TASK_ROWS = 1_000_000
SINGLE_TASK_BYTES = 256 << 20


def global_rank(
    df: DataFrame,
    amount: str = "total_billing",
    name: str = "billing_rank",
    single_task_rows: int = SINGLE_TASK_ROWS,
    scratch: str | None = None,
) -> DataFrame:
    """Rank by ``amount`` descending; ties share a rank and the next one skips.

    The input is stored once, which gives its exact size. Up to ``single_task_rows``
    rows of bounded bytes an ordinary global window does; beyond that the ranking is done
    by ranges. ``scratch`` is a shared folder to store in, where the session names none.
    """
    stored, size = store(df, "rank-input", scratch)
    if size.rows <= single_task_rows and size.within(SINGLE_TASK_BYTES):
        everything = Window.orderBy(F.col(amount).desc_nulls_last())
        return stored.withColumn(name, F.rank().over(everything))
    return _rank_by_ranges(stored, amount, name, size.rows // single_task_rows + 1, scratch)


def _rank_by_ranges(
    stored: DataFrame, amount: str, name: str, slices: int, scratch: str | None
) -> DataFrame:
    """Rank each distinct amount inside its value range, then offset by the ranges above.

    Amounts are reduced to (value, row count) first, so any number of ties is one row.
    The slice number is written with the rows because range bounds come from a sample.
    """
    descending = F.col(amount).desc_nulls_last()
    ranged, _ = store(
        stored.groupBy(amount)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .repartitionByRange(slices, descending)
        .withColumn("_slice", F.spark_partition_id()),
        "rank-slices",
        scratch,
    )

    def rows_before(window, count):
        preceding = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(count).over(preceding), F.lit(0))

    # At most `slices` rows: small enough for one task and for a broadcast.
    offsets = (
        ranged.groupBy("_slice")
        .agg(F.sum("_rows").alias("_slice_rows"))
        .select("_slice", rows_before(Window.orderBy("_slice"), "_slice_rows").alias("_above"))
    )
    in_slice = Window.partitionBy("_slice").orderBy(descending)
    ranks = ranged.join(F.broadcast(offsets), "_slice").select(
        F.col(amount).alias("_amount"),
        (1 + F.col("_above") + rows_before(in_slice, "_rows")).cast("int").alias(name),
    )
    return stored.join(ranks, F.col(amount).eqNullSafe(F.col("_amount"))).drop("_amount")
