"""Partition counts, cached views and sized partitioned writes."""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from tristrata.metrics import StepMetric, observed_write

PARTITION_CAP = 100  # fixed value
PARTITION_BYTES = 256 << 20
ROWS_PER_PARTITION = 1_000_000  # fixed value
MAX_WRITE_PARTITIONS = 200  # fixed value


def cap_partitions(df: DataFrame, cap: int | None = None, cache: bool = False) -> DataFrame:
    """Reduce to ``cap`` partitions when there are more, without a shuffle.

    The default is 100, or more where the optimizer expects partitions of over 256 MiB. ``cache``
    keeps the result from its first use until the caller unpersists it.
    """
    if cap is None:
        expected = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        cap = max(PARTITION_CAP, min(int(str(expected)) // PARTITION_BYTES, 1 << 30))
    capped = df.coalesce(cap)
    return capped.persist() if cache else capped


@contextmanager
def cached_view(
    df: DataFrame, view: str | None = None, cap: int | None = None
) -> Iterator[tuple[str, DataFrame]]:
    """A capped, cached frame as a view for SQL, while the context lasts.

    Gives the name of the view, a fresh one by default, and the frame, which fills on first
    use. View and cache are gone afterwards.
    """
    name = view or f"view_{uuid.uuid4().hex}"
    cached = cap_partitions(df, cap, cache=True)
    cached.createOrReplaceTempView(name)
    try:
        yield name, cached
    finally:
        df.sparkSession.catalog.dropTempView(name)
        cached.unpersist()


def write_partitions(
    rows: int, rows_per_partition: int = ROWS_PER_PARTITION, most: int = MAX_WRITE_PARTITIONS
) -> int:
    """One partition per million rows, from 1 to ``most``."""
    return max(1, min(most, rows // rows_per_partition))


def sized_write(
    df: DataFrame,
    partition_col: str,
    path: str,
    rows: int | None = None,
    most: int = MAX_WRITE_PARTITIONS,
) -> StepMetric:
    """Overwrite ``path`` partitioned by ``partition_col`` in evenly sized files.

    Without ``rows`` the run-time plan sizes the shuffle by bytes; a known row count sets
    the starting number of partitions by :func:`write_partitions` (raise ``most`` on a
    large cluster). Either way a value too large for one task is split, and no file
    exceeds a million rows. No counting pass is made.
    """
    hint = [] if rows is None else [write_partitions(rows, most=most)]
    return observed_write(
        "sized_write",
        df.hint("rebalance", *hint, partition_col),
        lambda d: d.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("maxRecordsPerFile", ROWS_PER_PARTITION)
        .partitionBy(partition_col)
        .parquet(path),
    )
