"""Ingest only files that have not been ingested yet."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tristrata.schema import VISIT_SCHEMA
from tristrata.sources.layers import write_bronze
from tristrata.sources.versions import children, write_text
from tristrata.sources.visits_csv import with_lineage

MAX_FILES_PER_BATCH = 10_000
MAX_FILE_AGE = "36500d"  # Spark would pass over files a week older than the newest


NAME = "load_name"


def load_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the loads of a stream, kept in a file beside its checkpoint's."""
    path = f"{checkpoint}/{NAME}"
    if NAME not in children(spark, checkpoint):
        write_text(spark, path, uuid.uuid4().hex[:16])
    return spark.read.text(path, wholetext=True).first()[0]


def stream_bronze(
    spark: SparkSession,
    source_dir: str,
    bronze_path: str,
    checkpoint: str,
    *,
    schema: T.StructType = VISIT_SCHEMA,
    layout: str = "day",
    max_files: int = MAX_FILES_PER_BATCH,
    name: str | None = None,
) -> StreamingQuery:
    """Start a run over the files that arrived since the last one, then stop.

    The checkpoint remembers which files were taken, whatever their modification times. Each
    micro-batch of ``max_files`` is a load of its own in bronze, named by ``name`` (by default one
    that lies with the checkpoint) and the batch, so a batch that is repeated after a failure replaces itself.
    """
    reader = spark.readStream.schema(schema).option("header", True)
    reader = reader.option("maxFilesPerTrigger", max_files).option("maxFileAge", MAX_FILE_AGE)

    stream = name or load_name(spark, checkpoint)

    def load(batch: DataFrame, number: int) -> None:
        write_bronze(batch, bronze_path, layout=layout, load_id=f"stream-{stream}-{number}")

    return (
        with_lineage(reader.csv(source_dir))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
