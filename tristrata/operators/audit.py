"""NULL counts over required fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.schema import REQUIRED_FIELDS


def null_counts(
    fields: tuple[str, ...] = REQUIRED_FIELDS, only: Column | None = None
) -> list[Column]:
    """One aggregate per field, for ``agg`` or for observing a write, over rows with ``only``."""
    counted = F.lit(True) if only is None else only
    return [F.count_if(counted & F.col(c).isNull()).alias(f"null_{c}") for c in fields]


def null_audit(df: DataFrame, fields: tuple[str, ...] = REQUIRED_FIELDS) -> DataFrame:
    """``(field, null_count)``, every field counted in the same pass."""
    counted = df.agg(*null_counts(fields))
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("field"), F.col(f"null_{c}").alias("null_count"))
                    for c in fields
                ]
            )
        )
    )
