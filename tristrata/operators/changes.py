"""Aggregates by group that follow changes: rows are put in, and taken out again.

The state of a group is a row of sums and, for the columns whose least and greatest value is
asked for, the number of rows of each value. States add up, so the new state is the old one
and that of the changes, whatever the table holds.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.operators.aggregate import PARTS, exact_parts, exact_total

SIGN = "sign"
TOTALS = "total"
#: Sums in a state beside ``group``, ``field`` and ``value``.
COUNTS = ("rows", "patients", "ages", "age_sum")


def state_of(
    changes: DataFrame,
    group: str = "diagnosis",
    key: str = "patient_id",
    amount: str = "billing_amount",
    age: str = "age",
    date: str = "visit_date",
    sign: str = SIGN,
) -> DataFrame:
    """The state of ``changes``, rows with a ``sign`` of 1 (put in) or -1 (taken out).

    One row for each group with its sums (``field`` is ``total``) and one for each value of
    ``age`` and ``date`` in it. Values are ages and days, so their number does not grow with the
    rows.
    """
    one = F.col(sign)

    def known(column: str, measure: Column) -> Column:
        return F.sum(F.when(F.col(column).isNotNull(), measure)).cast("long")

    sums = {
        "rows": F.sum(one).cast("long"),
        "patients": known(key, one),
        "ages": known(age, one),
        "age_sum": known(age, one * F.col(age)),
        **exact_parts(amount, sign),
    }
    totals = changes.groupBy(F.col(group).alias("group")).agg(
        *(c.alias(n) for n, c in sums.items())
    )
    totals = totals.withColumns({"field": F.lit(TOTALS), "value": F.lit(0).cast("long")})
    pairs = F.array(
        F.struct(F.lit("age").alias("field"), F.col(age).cast("long").alias("value")),
        F.struct(F.lit("date").alias("field"), F.unix_date(date).cast("long").alias("value")),
    )
    values = changes.select(F.col(group).alias("group"), one.alias("rows"), F.inline(pairs))
    values = values.where(F.col("value").isNotNull()).groupBy("group", "field", "value")
    return totals.unionByName(values.agg(F.sum("rows").cast("long").alias("rows")), True)


def merged(*states: DataFrame) -> DataFrame:
    """One state for several; groups and values of which no row is left are gone."""
    whole = states[0]
    for other in states[1:]:
        whole = whole.unionByName(other)
    sums = [F.sum(c).alias(c) for c in (*COUNTS, *PARTS)]
    return whole.groupBy("group", "field", "value").agg(*sums).where("rows <> 0")


def groups_of(state: DataFrame, group: str = "diagnosis") -> DataFrame:
    """The aggregates that :func:`by_group` gives over all rows, from their state."""
    total, ages, dates = (F.col("field") == f for f in (TOTALS, "age", "date"))

    def of_total(name: str) -> Column:
        return F.max(F.when(total, F.col(name)))

    day = F.expr("date_from_unix_date(cast(value AS int))")
    parts = {p: of_total(p) for p in PARTS}
    ages_known = F.nullif(of_total("ages"), F.lit(0))
    amounts_known = F.nullif(parts["amounts"], F.lit(0))
    # Result column names.
    measures = {
        "total_billing": exact_total(parts),
        "avg_billing": F.round(exact_total(parts) / amounts_known, 2),
        "patient_count": F.coalesce(of_total("patients"), F.lit(0)).cast("long"),
        "min_age": F.min(F.when(ages, F.col("value"))).cast("int"),
        "max_age": F.max(F.when(ages, F.col("value"))).cast("int"),
        "avg_age": F.round(of_total("age_sum") / ages_known, 1),
        "first_visit": F.min(F.when(dates, day)),
        "last_visit": F.max(F.when(dates, day)),
    }
    found = state.groupBy(F.col("group").alias(group))
    return found.agg(*(c.alias(n) for n, c in measures.items()))
