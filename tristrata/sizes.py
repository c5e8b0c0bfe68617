"""Exact row counts and row-format sizes, to decide what may be broadcast or sorted at once."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ROW_OVERHEAD_BYTES = 32
_FIELD_BYTES = 16
_TEXT = (T.StringType, T.BinaryType)
_FIXED_WIDTH = (
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


@dataclass(frozen=True)
class Size:
    """Rows and in-memory bytes; ``bytes`` is None where no bound is known."""

    rows: int
    bytes: int | None

    def within(self, max_bytes: int) -> bool:
        return self.bytes is not None and self.bytes <= max_bytes


def least_row_bytes(schema: T.StructType) -> int:
    """Bytes of a row without its texts."""
    return _ROW_OVERHEAD_BYTES + _FIELD_BYTES * len(schema)


def total_bytes(schema: T.StructType) -> Column | None:
    """An aggregate over the bytes of all rows; None if a column has no simple width."""
    texts = [f.name for f in schema if isinstance(f.dataType, _TEXT)]
    if not all(isinstance(f.dataType, _TEXT + _FIXED_WIDTH) for f in schema):
        return None
    fixed = F.lit(least_row_bytes(schema)).cast("long")
    width = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), fixed)
    return F.coalesce(F.sum(width), F.lit(0)).alias("bytes")


def measure(df: DataFrame) -> Size:
    """The size of ``df``, in one aggregate over it."""
    measured = total_bytes(df.schema)
    aggregates = [F.count(F.lit(1)).alias("rows")] + ([] if measured is None else [measured])
    row = df.agg(*aggregates).first().asDict()
    return Size(row["rows"], row.get("bytes"))
