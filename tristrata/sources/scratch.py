"""Intermediate tables in the folder every executor can reach."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tristrata.metrics import observed_write
from tristrata.sizes import Size, total_bytes

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh path below ``base``, a shared folder, by default that of ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = base or spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tristrata-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/tristrata/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str, base: str | None = None) -> tuple[DataFrame, Size]:
    """Write ``df`` once and return the stored table with its size, measured by the write.

    Later branches read the files, so they agree on every value and neither repeats
    the work above nor depends on executors that may have gone.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label, base)
    measured = total_bytes(df.schema)
    metric = observed_write(
        label,
        df,
        lambda d: d.write.parquet(path),
        None if measured is None else [measured],
    )
    stored = spark.read.schema(df.schema).parquet(path)
    return stored, Size(metric.row_count, metric.observed.get("bytes"))
