"""Which source files went into bronze, and with which load.

A load is written down with its files before it goes into bronze, and once more when it is
there. A run that fails between the two leaves a load that was begun: the next run takes the
same files again under the same id, which replaces what the failed one may have written. So
every file is taken once, whenever a run ends. A file is known by path, length and time of
modification; one that was changed is a new file.

Runs over one ledger follow each other; two at the same time may take a file twice.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.sources.versions import children

FILES = "path string, length long, modified timestamp, load_id string, since string"
DONE = "load_id string"
FILE = ["path", "length", "modified"]


@dataclass(frozen=True)
class Load:
    """Files that go into bronze together; ``since`` is the mark they were begun with."""

    load_id: str
    files: list[str]
    since: str | None = None


def listing(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """``path, length, modified`` of each source file; no contents are read."""
    found = spark.read.format("binaryFile").load(source)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))


def read_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    if not [n for n in children(spark, f"{path}/{name}") if n.endswith(".parquet")]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def finished(spark: SparkSession, path: str) -> list[str]:
    """Ids of the loads that bronze has."""
    return sorted(r["load_id"] for r in read_table(spark, path, "done", DONE).distinct().collect())


def waiting(
    spark: SparkSession, path: str, source: str | list[str], since: str | None = None
) -> list[Load]:
    """Loads to take now: those begun and not finished, then one of the files never taken.

    The new load is written down here. The paths come to the driver, as they do for any read.
    """
    begun = read_table(spark, path, "begun", FILES)
    done = read_table(spark, path, "done", DONE)
    present = listing(spark, source).persist()
    try:
        again = begun.join(done, "load_id", "left_anti").join(present, FILE, "left_semi")
        held: dict[str, Load] = {}
        for r in again.select("load_id", "path", "since").orderBy("load_id", "path").collect():
            held.setdefault(r["load_id"], Load(r["load_id"], [], r["since"])).files.append(r["path"])
        fresh = present.join(begun, FILE, "left_anti").distinct()
        files = sorted(r["path"] for r in fresh.select("path").collect())
        if files:
            new = Load(uuid.uuid4().hex[:16], files, since)
            rows = fresh.select(
                *FILE, F.lit(new.load_id).alias("load_id"), F.lit(since).cast("string").alias("since")
            )
            rows.coalesce(1).write.mode("append").parquet(f"{path}/begun")
            held[new.load_id] = new
    finally:
        present.unpersist()
    return list(held.values())


def finish(spark: SparkSession, path: str, load: Load) -> None:
    """Write down that bronze has the load."""
    row = spark.createDataFrame([(load.load_id,)], DONE)
    row.coalesce(1).write.mode("append").parquet(f"{path}/done")
