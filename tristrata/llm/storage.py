"""Intermediate tables in the folder that the cluster names in ``spark.checkpoint.dir``."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; a local session without one gets a temporary folder."""
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), f"tristrata-{os.getpid()}")
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: lineage ends here and every reader sees one result."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
