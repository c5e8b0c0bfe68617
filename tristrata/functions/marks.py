"""Incremental marks: a date after which visits count as new."""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Mark = str | dt.date | Column


def parse_mark(mark: Mark) -> Column:
    """A date column from an ISO text, a date, or a column passed through.

    Text is checked here, so a malformed mark fails before any job starts.
    """
    if isinstance(mark, Column):
        return mark
    if isinstance(mark, dt.datetime):
        mark = mark.date()
    if isinstance(mark, dt.date):
        return F.lit(mark)
    try:
        return F.lit(dt.date.fromisoformat(mark))
    except (TypeError, ValueError) as e:
        raise ValueError(f"date mark must look like 2024-01-31, got {mark!r}") from e


def settled(spark: SparkSession, mark: Mark | None) -> dt.date | None:
    """The mark as one date, so that every later step means the same day.

    A column (say, days before today) is worked out here, once, in a tiny job.
    """
    if not given(mark):
        return None
    return spark.range(1).select(parse_mark(mark).cast("date")).first()[0]


def given(mark: Mark | None) -> bool:
    """Whether there is a mark; None and empty text mean there is not."""
    return mark is not None and not (isinstance(mark, str) and mark == "")


def after(df: DataFrame, mark: Mark | None, date: str = "visit_date") -> DataFrame:
    """Rows strictly after the mark; without a mark every row, NULL dates included."""
    return df.filter(F.col(date) > parse_mark(mark)) if given(mark) else df


def between_dates(
    df: DataFrame,
    start: Mark | None = None,
    end: Mark | None = None,
    date: str = "visit_date",
) -> DataFrame:
    """Inclusive range; each end is optional."""
    if given(start):
        df = df.filter(F.col(date) >= parse_mark(start))
    if given(end):
        df = df.filter(F.col(date) <= parse_mark(end))
    return df


def days_back(days: int = 1) -> Column:
    """The mark ``days`` before today, in the session time zone."""
    return F.date_sub(F.current_date(), days)


def mark_before_latest(df: DataFrame, days: int, date: str = "visit_date") -> Column:
    """The mark ``days`` before the newest date already in ``df``, as a scalar subquery."""
    return df.agg(F.date_sub(F.max(date), days)).scalar()
