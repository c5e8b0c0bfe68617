"""Read and write the bronze, silver and gold Parquet layers."""

import datetime as dt
import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions.marks import Mark, given, parse_mark
from tristrata.metrics import StepMetric, observed_write
from tristrata.schema import BRONZE_SCHEMA, SILVER_SCHEMA
from tristrata.sources.evolution import FAILURES, is_conflict, read_conflicting
from tristrata.sources.versions import VERSION, Manifest, current, matching, version_path

MONTH = "visit_month"
RAW_LINE = "raw_line"
LOAD = "load_id"
#: Folders of one write: rows that go to several tables carry the table's name in this column.
KIND = "kind"
BUCKET = "bucket"
#: A session in which an aggregate over all rows of Parquet files reads their footers alone.
FROM_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.adaptive.enabled": "false",
}
#: What a write adds to a silver in buckets and no reader of silver sees.
HIDDEN = (KIND, BUCKET, VERSION, "sign", "reject_reasons")


def read_layer(
    spark: SparkSession,
    path: str,
    partition_types: dict[str, T.DataType] | None = None,
    when_empty: T.StructType | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a layer with the schemas of all its files merged.

    Merging opens the footer of every file; a caller that knows the ``schema`` passes it
    and spares that. Values of partition folders are guessed from their text (``042``
    would turn into the number 42); ``partition_types`` puts the declared types back. A
    layer that was written without any row has no data file; ``when_empty`` is its
    schema then. Files whose types differ are read as the least type that holds both exactly
    (``int`` and ``long``, ``int`` and ``double``); where there is none, and where a path does not
    exist, reading raises.
    """
    if schema is not None:
        return retyped(spark, path, spark.read.schema(schema).parquet(path), partition_types)
    try:
        merged = spark.read.option("mergeSchema", True).parquet(path)
    except FAILURES as e:
        if is_conflict(e):
            united = read_conflicting(spark, path, partition_types)
            if united is not None:
                return united
        if when_empty is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], when_empty)
    return retyped(spark, path, merged, partition_types)


def retyped(
    spark: SparkSession, path: str, df: DataFrame, types: dict[str, T.DataType] | None
) -> DataFrame:
    """``df``, read from ``path``, with the declared types of its partition columns."""
    wanted = {c: t for c, t in (types or {}).items() if c in df.columns}
    if all(df.schema[c].dataType == t for c, t in wanted.items()):
        return df
    fields = [T.StructField(f.name, wanted.get(f.name, f.dataType)) for f in df.schema]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def write_layer(
    df: DataFrame,
    path: str,
    operation: str,
    partition_by: str | list[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = True,
    overwrite: str = "static",
    observe: list[Column] | None = None,
) -> StepMetric:
    """Write Parquet and return what was written.

    Rows are gathered by the partition column first, so a load spread over many tasks
    does not leave one small file per task and folder; a value too large for one task is
    split at run time into files of the advisory size. ``rebalance=False`` spares that
    shuffle for loads whose tasks hold few partition values each. Mode ``overwrite``
    replaces everything, or with ``overwrite="dynamic"`` the partitions present in ``df``;
    the default of the session does not matter.
    """
    folders = [partition_by] if isinstance(partition_by, str) else partition_by or []
    if folders and rebalance:
        df = df.hint("rebalance", *folders)

    def save(rows: DataFrame) -> None:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite)
        (writer.partitionBy(*folders) if folders else writer).parquet(path)

    return observed_write(operation, df, save, observe)


def by_date_layout(df: DataFrame, layout: str) -> tuple[DataFrame, str]:
    """The frame and its partition column for a ``day`` or ``month`` layout."""
    if layout == "day":
        return df, "visit_date"
    if layout == "month":
        return df.withColumn(MONTH, F.date_format("visit_date", "yyyy-MM")), MONTH
    raise ValueError(f"layout is 'day' or 'month', got {layout!r}")


def write_bronze(
    df: DataFrame,
    path: str,
    mode: str = "append",
    *,
    layout: str = "day",
    load_id: str | None = None,
    rebalance: bool = True,
) -> StepMetric:
    """Write raw visits partitioned by ``visit_date``.

    ``mode`` is a Spark save mode, or ``"replace"`` to overwrite just the dates present in
    ``df`` (for sources that resend whole dates); rows without a date are added then, as
    no date of theirs can be replaced, which takes a second pass over ``df``. With
    ``load_id`` the rows form a load of their own that a rerun with the same id replaces as a
    whole, whatever the mode. ``layout="month"`` makes one folder per month where days are
    too small to be files of their own. All loads of one path use the same layout and either all or none have an id.
    """
    overwrite = "static"
    if mode == "replace" and load_id is None:
        if layout != "day":
            raise ValueError("only a layout by day can replace single dates")
        mode, overwrite = "overwrite", "dynamic"
    if load_id is not None:
        if not re.fullmatch(r"[\w.-]+", load_id):
            raise ValueError(f"load id may hold letters, digits, '_', '.', '-', got {load_id!r}")
        path, mode = f"{path.rstrip('/')}/{LOAD}={load_id}", "overwrite"
    rows, partition = by_date_layout(df, layout)
    if overwrite == "static":
        return write_layer(rows, path, "bronze", partition, mode, rebalance)
    dated, undated = (
        write_layer(part, path, "bronze", partition, how, rebalance, overwrite)
        for part, how in (
            (rows.filter(F.col(partition).isNotNull()), mode),
            (rows.filter(F.col(partition).isNull()), "append"),
        )
    )
    return StepMetric(
        "bronze",
        dated.row_count + undated.row_count,
        dated.duration_seconds + undated.duration_seconds,
    )


def read_bronze(
    spark: SparkSession,
    path: str,
    start: Mark | None = None,
    end: Mark | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read bronze, optionally an inclusive date range, which prunes folders."""
    types = {"visit_date": T.DateType(), MONTH: T.StringType(), LOAD: T.StringType()}
    df = read_layer(spark, path, types, BRONZE_SCHEMA, schema)
    if KIND in df.columns:
        df = df.where(F.col(KIND) == "visit").drop(KIND, RAW_LINE)
    for mark, keep in ((start, Column.__ge__), (end, Column.__le__)):
        if given(mark):
            bound = parse_mark(mark)
            df = df.filter(keep(F.col("visit_date"), bound))
            if MONTH in df.columns:
                df = df.filter(keep(F.col(MONTH), F.date_format(bound, "yyyy-MM")))
    return df.drop(MONTH)


def latest_date(spark: SparkSession, path: str) -> dt.date | None:
    """The newest visit date in bronze, from the names of its folders and the footers of files.

    A layout by day has it in the names. One by month names the newest month, and the footers
    of the files there have their greatest date; no column is read either way. Dated folders
    hold a row at least, as only rows make them.
    """
    inner = ("", f"{LOAD}=*/", f"{KIND}=visit/", f"{LOAD}=*/{KIND}=visit/")
    days, months = (
        [p for way in inner for p in matching(spark, f"{path}/{way}{column}=*")]
        for column in ("visit_date", MONTH)
    )
    dated = [d for d in (p.rsplit("=", 1)[1] for p in days) if re.fullmatch(r"[\d-]+", d)]
    if dated:
        return dt.date.fromisoformat(max(dated))
    named = [m for m in (p.rsplit("=", 1)[1] for p in months) if re.fullmatch(r"[\d-]+", m)]
    if not named:
        return None
    newest = max(named)
    folders = [p for p in months if p.endswith(f"={newest}")]
    found = greatest_date(spark, folders).first()[0]
    if found is not None and f"{found:%Y-%m}" == newest:
        return found
    # footers name columns by place: files of another order of columns answer for another one
    plain = spark.read.schema("visit_date date").parquet(*folders)
    return plain.agg(F.max("visit_date")).first()[0]


def greatest_date(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The greatest visit date in some folders; the scan answers it from footers."""
    session = spark.newSession()
    for key, value in FROM_FOOTERS.items():
        session.conf.set(key, value)
    return session.read.parquet(*folders).agg(F.max("visit_date"))


def write_silver(
    df: DataFrame,
    path: str,
    partition_by: str = "diagnosis",
    rebalance: bool = True,
    observe: list[Column] | None = None,
) -> StepMetric:
    """Replace silver, partitioned by diagnosis."""
    return write_layer(df, path, "silver", partition_by, rebalance=rebalance, observe=observe)


def read_silver(
    spark: SparkSession,
    path: str,
    partition_by: str = "diagnosis",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read silver, its version in use where it has versions; the partition value stays text."""
    manifest = current(spark, path)
    if manifest.size:
        return read_buckets(spark, path, manifest, schema=schema)
    path = version_path(spark, path)
    return read_layer(spark, path, {partition_by: T.StringType()}, SILVER_SCHEMA, schema)


def read_buckets(
    spark: SparkSession,
    path: str,
    manifest: Manifest,
    buckets: list[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Read a silver in buckets, each in its version in use, or some of its ``buckets``."""
    wanted = manifest.buckets if buckets is None else buckets
    paths = [
        f"{path}/{VERSION}={manifest.buckets[b]}/{KIND}=silver/{BUCKET}={b}"
        for b in wanted
        if b in manifest.buckets
    ]
    return read_folders(spark, path, paths, schema or SILVER_SCHEMA, schema is not None).drop(*HIDDEN)


def read_folders(
    spark: SparkSession,
    base: str,
    paths: list[str],
    when_empty: T.StructType,
    known: bool = False,
) -> DataFrame:
    """Read some partition folders below ``base``, with merged schemas unless one is ``known``."""
    if not paths:
        return spark.createDataFrame([], when_empty)
    reader = spark.read.option("basePath", base)
    if known:
        return reader.schema(when_empty).parquet(*paths)
    return reader.option("mergeSchema", True).parquet(*paths)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rows that broke a rule, with their reasons, of a silver in buckets."""
    folders = [f"{path}/{VERSION}={v}/{KIND}=rejected" for v in current(spark, path).rejects]
    empty = T.StructType(
        [*SILVER_SCHEMA.fields, T.StructField("reject_reasons", T.ArrayType(T.StringType()))]
    )
    return read_folders(spark, path, folders, empty).drop(*(c for c in HIDDEN if c != "reject_reasons"))


def read_malformed(spark: SparkSession, path: str) -> DataFrame:
    """Lines of bronze that did not match the schema, where loads were routed by kind."""
    whole = read_layer(spark, path, {LOAD: T.StringType(), MONTH: T.StringType()}, BRONZE_SCHEMA)
    if KIND not in whole.columns:
        return whole.where("false")
    return whole.where(F.col(KIND) == "malformed").drop(KIND, MONTH)


def write_gold(df: DataFrame, path: str) -> StepMetric:
    """Replace gold, unpartitioned: it holds one row per group."""
    return write_layer(df, path, "gold")


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Read gold."""
    return spark.read.parquet(path)


def evolve(batches: Iterable[DataFrame]) -> DataFrame:
    """Union batches by column name; columns a batch lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
