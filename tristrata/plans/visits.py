"""Patient visits derived from the order tables, with NULLs, padding and bad values."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tristrata.schema import VISIT_SCHEMA
from tristrata.sources.scratch import scratch_path

# Order keys outgrow 32 bits at large scale, and a visit id breaks ties in dedup.
WIDE_SCHEMA = T.StructType(
    [T.StructField("patient_id", T.LongType())]
    + VISIT_SCHEMA.fields[1:]
    + [T.StructField("visit_id", T.LongType())]
)
# Column order of query results over visits.
COLUMNS = WIDE_SCHEMA.names
NEWEST_VISIT = ("visit_date", "visit_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One visit per order of a known customer.

    ``patient_id`` is computed from both (equal) join keys, so that steps by patient
    shuffle for themselves, after trimming to a row per patient and task, instead of
    building on the join's partitioning. That leaves the run-time plan free to split a
    customer with very many orders over several join tasks.
    """
    priority, price = F.col("o_orderpriority"), F.col("o_totalprice")
    nation = F.col("c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.greatest("o_custkey", "c_custkey").alias("patient_id"),
            F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
            F.when(nation != 0, nation * 8).alias("age"),
            F.when(priority != "3-MEDIUM", F.lower("c_mktsegment")).alias("diagnosis"),
            F.to_date("o_orderdate").alias("visit_date"),
            F.when(F.col("o_orderstatus") == "P", F.lit(None))
            .when(priority == "5-LOW", -price)
            .otherwise(price)
            .alias("billing_amount"),
            F.col("o_orderkey").alias("visit_id"),
        )
    )


def write_visit_files(
    df: DataFrame, path: str | None = None, columns: list[str] = COLUMNS
) -> str:
    """Write visits as headered delimited files, adding to those in ``path``."""
    path = path or scratch_path(df.sparkSession, "visit-files")
    (
        df.select(*columns)
        .write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
