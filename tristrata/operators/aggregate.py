"""Group-by aggregates; all split into a map-side partial and a final step."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Steps in which amounts are added as whole numbers, and below which amounts that is exact.
STEPS = {"micro": (1_000_000, 9e9), "pico": (1_000_000_000_000, 9e3)}

#: Names of the sums that :func:`exact_parts` gives.
PARTS = (
    "amounts", "micro_high", "micro_low", "pico_high", "pico_low", "rough", "rough_rows",
)


def exact_parts(amount: str, sign: str | None = None) -> dict[str, Column]:
    """Sums that make up a sum of doubles and can be added to those of other rows.

    An amount counts as the decimal number it is written as: one of up to six places and below
    nine billion is added as whole millionths, one of up to twelve places and below nine
    thousand as whole millionths of these, in two halves that cannot overflow. Any other (more
    places, NaN, infinite, larger) is added as it is, in ``rough``, and only that may depend on
    the order of rows. With ``sign``, a column of 1 and -1, rows are put in and taken out again.
    """
    x = F.col(f"`{amount}`")
    one = F.lit(1) if sign is None else F.col(f"`{sign}`")
    rest, parts = x.isNotNull(), {}
    parts["amounts"] = F.coalesce(F.sum(F.when(rest, one)), F.lit(0)).cast("long")
    for name, (step, most) in STEPS.items():
        whole = F.rint(x * step)
        fits = (F.abs(x) < most) & (whole / step == x)
        steps = F.when(rest & fits, whole.cast("long") * one)
        parts[f"{name}_high"] = F.sum(F.shiftright(steps, 24))
        parts[f"{name}_low"] = F.sum(steps.bitwiseAND(0xFFFFFF))
        rest = rest & ~fits
    parts["rough"] = F.sum(F.when(rest, x * one))
    parts["rough_rows"] = F.coalesce(F.sum(F.when(rest, one)), F.lit(0)).cast("long")
    return parts


def exact_total(parts: dict[str, Column]) -> Column:
    """The sum that ``exact_parts`` stand for, as a double; NULL without an amount."""

    def steps(name: str, size: str) -> Column:
        high, low = (
            F.coalesce(parts[f"{name}_{half}"], F.lit(0)).cast("decimal(20,0)")
            for half in ("high", "low")
        )
        whole = (high * F.lit(1 << 24).cast("decimal(8,0)") + low).cast("decimal(25,0)")
        return whole * F.lit(size).cast(f"decimal({len(size) - 2},{len(size) - 2})")

    micro = steps("micro", "0.000001")
    pico = steps("pico", "0.000000000001").cast("decimal(37,12)")
    both = (micro.cast("decimal(37,12)") + pico).cast("double")
    exact = F.when(parts["pico_high"].isNull(), micro.cast("double")).otherwise(both)
    total = F.when(parts["rough_rows"] > 0, exact + parts["rough"]).otherwise(exact)
    return F.when(parts["amounts"] > 0, total)


def exact_sum(amount: str) -> Column:
    """A sum of doubles, as a double, that does not depend on their order; see ``exact_parts``."""
    return exact_total(exact_parts(amount))


def by_group(
    df: DataFrame,
    group: str = "diagnosis",
    key: str = "patient_id",
    amount: str = "billing_amount",
    age: str = "age",
    date: str = "visit_date",
) -> DataFrame:
    """Billing, head count, ages and visit span per group.

    Average billing keeps two decimals and average age one.
    """
    # Result column names.
    measures = {
        "total_billing": exact_sum(amount),
        "avg_billing": F.round(exact_sum(amount) / F.nullif(F.count(amount), F.lit(0)), 2),
        "patient_count": F.count(key),
        "min_age": F.min(age),
        "max_age": F.max(age),
        "avg_age": F.round(F.avg(age), 1),
        "first_visit": F.min(date),
        "last_visit": F.max(date),
    }
    return df.groupBy(group).agg(*[m.alias(name) for name, m in measures.items()])


def agg_metrics(df: DataFrame, groups: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Total, average and count of each metric over rows where every metric is present.

    A row with a NULL in one metric leaves all of them; NaN is a value and stays. Totals do
    not depend on the order of rows.
    """
    if not metrics:
        raise ValueError("at least one metric column is needed")
    for metric in metrics:
        df = df.filter(F.col(metric).isNotNull())
    # Beginnings of the result column names.
    kinds = dict(df.dtypes)
    total = {m: exact_sum if kinds[m] in ("double", "float") else F.sum for m in metrics}
    measures = {
        "total": lambda m: total[m](m),
        "avg": lambda m: total[m](m) / F.count(m),
        "count": F.count,
    }
    return df.groupBy(*groups).agg(
        *[fn(m).alias(f"{label}_{m}") for m in metrics for label, fn in measures.items()]
    )


def monthly_trend(
    df: DataFrame,
    group: str = "diagnosis",
    date: str = "visit_date",
    amount: str = "billing_amount",
) -> DataFrame:
    """Visits and billing per calendar month and group."""
    return df.groupBy(F.trunc(date, "month").alias("visit_month"), group).agg(
        F.count(F.lit(1)).alias("visits"), exact_sum(amount).alias("total_billing")
    )
