"""Headered delimited visit files to typed rows with lineage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.functions.marks import Mark, after
from tristrata.schema import LOADED_AT, SOURCE_FILE, VISIT_SCHEMA


def read_visits(
    spark: SparkSession,
    path: str | list[str],
    since: Mark | None = None,
    *,
    schema: T.StructType = VISIT_SCHEMA,
    strict_header: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read visit files (file, folder or glob) with the declared schema.

    Malformed values become NULL and short rows are padded. ``schema`` replaces the
    declared one for files with more columns or wider types. Columns bind by position;
    ``strict_header`` makes a header that disagrees fail instead. ``corrupt_column``
    keeps the raw text of malformed lines, see :func:`malformed`.
    """
    fields = list(schema.fields)
    reader = spark.read.option("header", True).option("enforceSchema", not strict_header)
    if corrupt_column:
        fields = fields + [T.StructField(corrupt_column, T.StringType())]
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return with_lineage(reader.schema(T.StructType(fields)).csv(path)).transform(after, since)


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add load time and the base name of the file each row came from."""
    return scan.select(
        "*",
        F.current_timestamp().alias(LOADED_AT),
        F.col("_metadata.file_name").alias(SOURCE_FILE),
    )


def malformed(df: DataFrame, corrupt_column: str) -> DataFrame:
    """Rows whose line did not match the schema, for a quarantine table.

    All columns stay selected: a pruned scan skips the fields it does not need and
    would miss the errors in them.
    """
    return df.filter(F.col(corrupt_column).isNotNull())
