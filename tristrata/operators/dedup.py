"""One row per key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tristrata.schema import LOADED_AT


def latest_per_key(
    df: DataFrame,
    keys: tuple[str, ...] = ("patient_id",),
    latest: tuple[str, ...] = ("visit_date", LOADED_AT),
    unique: bool = False,
) -> DataFrame:
    """Keep the newest row of each key; NULL keys form one group.

    Rows equal in ``latest`` are told apart by their remaining columns in order of name,
    so the survivor depends neither on the order of the input nor on that of the columns.
    ``unique`` says that ``latest`` already decides, which spares reading columns only
    for that. The row-number filter is applied per map task before the shuffle, so even a
    key that holds a third of the rows sends one row per task.
    """
    newest = Window.partitionBy(*keys).orderBy(*newest_first(df, keys, latest, unique))
    return df.withColumn("_row", F.row_number().over(newest)).filter("_row = 1").drop("_row")


def newest_first(
    df: DataFrame, keys: tuple[str, ...], latest: tuple[str, ...], unique: bool = False
) -> list[Column]:
    """The order of the rows of a key: by ``latest``, then by all other columns of ``df``."""
    order = [c for c in latest if c in df.columns]
    if not unique:
        order += sorted(c for c in df.columns if c not in order and c not in keys)
    return [_comparable(df, c).desc_nulls_last() for c in order]


def _comparable(df: DataFrame, column: str) -> Column:
    """The column, as text where its type has no order."""
    unordered = any(t in df.schema[column].dataType.simpleString() for t in ("map<", "variant"))
    return F.to_json(column) if unordered else F.col(column)


def distinct_keys(df: DataFrame, keys: tuple[str, ...] = ("patient_id",)) -> DataFrame:
    """The distinct keys alone; only the key columns are read and shuffled."""
    return df.select(*keys).distinct()
