"""Summary insights over a gold frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.operators.aggregate import exact_sum


def top_group(gold: DataFrame) -> DataFrame:
    """The group with the highest total billing; ties go to the first name."""
    return (
        gold.select("diagnosis", "total_billing")
        .orderBy(F.col("total_billing").desc_nulls_last(), F.col("diagnosis").asc())
        .limit(1)
    )


def total_revenue(gold: DataFrame) -> DataFrame:
    """Sum of all totals, whatever their order; 0.0 for an empty gold."""
    return gold.agg(F.coalesce(exact_sum("total_billing"), F.lit(0.0)).alias("total_revenue"))


def distribution(gold: DataFrame) -> DataFrame:
    """Patients per group."""
    return gold.select("diagnosis", "patient_count")


def summary(gold: DataFrame) -> DataFrame:
    """One row: top group, its billing (0.0 when there is none), total revenue."""
    first = F.struct((-F.col("total_billing")).alias("descending"), "diagnosis")
    billed = F.when(F.col("total_billing").isNotNull(), first)
    top = F.min_by(F.struct("diagnosis", "total_billing"), billed)
    return gold.agg(top.alias("top"), exact_sum("total_billing").alias("revenue")).select(
        F.col("top.diagnosis").alias("top_diagnosis"),
        F.coalesce("top.total_billing", F.lit(0.0)).alias("top_billing"),
        F.coalesce("revenue", F.lit(0.0)).alias("total_revenue"),
    )


def insight_record(gold: DataFrame) -> DataFrame:
    """All insights as rows ``(insight, diagnosis, value)``.

    Rows rather than an array, which would put every group into one row.
    """
    head = summary(gold).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("top_diagnosis").alias("insight"),
                    F.col("top_diagnosis").alias("diagnosis"),
                    F.col("top_billing").alias("value"),
                ),
                F.struct(
                    F.lit("total_revenue").alias("insight"),
                    F.lit(None).cast("string").alias("diagnosis"),
                    F.col("total_revenue").alias("value"),
                ),
            )
        )
    )
    per_group = gold.select(
        F.lit("patient_count").alias("insight"),
        "diagnosis",
        F.col("patient_count").cast("double").alias("value"),
    )
    return head.unionByName(per_group)


def insight_dict(gold: DataFrame) -> dict:
    """The four insights as a Python dict; the patients per group stay a frame.

    A gold of any number of groups has insights: only single values come to the driver.
    """
    return summary(gold).first().asDict() | {"patient_distribution": distribution(gold)}
