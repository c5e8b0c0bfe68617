"""Trends over a calendar: every month of every group, with what lies around it."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tristrata.operators.aggregate import monthly_trend

TRAILING = 3
YEAR = 12


def calendar_trend(
    df: DataFrame,
    group: str = "diagnosis",
    date: str = "visit_date",
    amount: str = "billing_amount",
    trailing: int = TRAILING,
) -> DataFrame:
    """Visits and billing of each month and group, months without a visit as 0.

    The calendar runs from the first to the last month of the table for every group.
    ``trailing_*`` add up the month and those before it, ``trailing`` in all; ``change_on_year``
    is the billing less that of the month a year before, NULL where the calendar has none.
    Visits without a date are in no month. Rows are one for each month and group before the
    windows, so their tasks hold a calendar each and not the visits.
    """
    months = monthly_trend(df.where(F.col(date).isNotNull()), group, date, amount)
    bounds = [months.agg(end("visit_month")).scalar() for end in (F.min, F.max)]
    every = F.explode(F.sequence(*bounds, F.expr("interval 1 month"))).alias("visit_month")
    spine = months.select(group).distinct().select(
        every, group, F.lit(0).cast("long").alias("visits"), F.lit(0.0).alias("total_billing")
    )
    # a month's own row and its empty one from the calendar add up to the former
    filled = months.unionByName(spine).groupBy("visit_month", group).agg(
        F.sum("visits").alias("visits"),
        F.coalesce(F.sum("total_billing"), F.lit(0.0)).alias("total_billing"),
    )
    number = F.year("visit_month") * YEAR + F.month("visit_month")
    ordered = Window.partitionBy(group).orderBy("_month")
    recent = ordered.rangeBetween(1 - trailing, 0)
    year_before = F.first("total_billing").over(ordered.rangeBetween(-YEAR, -YEAR))
    return filled.withColumn("_month", number).select(
        "visit_month",
        group,
        "visits",
        "total_billing",
        F.sum("visits").over(recent).alias("trailing_visits"),
        F.sum("total_billing").over(recent).alias("trailing_billing"),
        (F.col("total_billing") - year_before).alias("change_on_year"),
    )
