"""Narrow row rules of the silver layer; none of them shuffles."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.schema import AGE_RANGE, FILL_DEFAULTS


def fill_defaults(
    df: DataFrame,
    defaults: dict = FILL_DEFAULTS,
    blank_as_null: tuple[str, ...] = ("diagnosis",),
) -> DataFrame:
    """Replace NULLs (and NaN in double columns) by per-column defaults.

    Blank text in ``blank_as_null`` counts as missing: a blank partition value would
    come back from storage as NULL and open a group of its own.
    """
    blanks = {c: F.when(F.trim(c) != "", F.col(c)) for c in blank_as_null if c in df.columns}
    present = {c: v for c, v in defaults.items() if c in df.columns}
    return df.withColumns(blanks).fillna(present)


def standardize(
    df: DataFrame,
    trimmed: tuple[str, ...] = ("name",),
    trimmed_upper: tuple[str, ...] = ("diagnosis",),
) -> DataFrame:
    """Trim blanks around text columns and upper-case the coded ones."""
    return df.withColumns(
        {c: F.trim(c) for c in trimmed} | {c: F.upper(F.trim(c)) for c in trimmed_upper}
    )


def range_rules(age: str = "age", amount: str = "billing_amount") -> dict[str, Column]:
    """Reject reason -> predicate a valid row satisfies."""
    return {
        "age_out_of_range": F.col(age).between(*AGE_RANGE),
        "negative_billing": F.col(amount) >= 0,
    }


def apply_rules(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """Keep the rows that satisfy every rule."""
    for valid in (rules or range_rules()).values():
        df = df.filter(valid)
    return df


def rejects(df: DataFrame, rules: dict[str, Column] | None = None) -> DataFrame:
    """The complement of :func:`apply_rules`, with an array of ``reject_reasons``.

    A rule that evaluates to NULL rejects the row, as a filter does.
    """
    failed = [
        F.when(~F.coalesce(valid, F.lit(False)), F.lit(reason))
        for reason, valid in (rules or range_rules()).items()
    ]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*failed))).filter(
        F.size("reject_reasons") > 0
    )
