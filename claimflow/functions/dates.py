"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WEEKEND = (1, 7)  # Sunday and Saturday as numbered by dayofweek


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day")))


def date_spine(spark: SparkSession, start: str, end: str, out: str = "full_date") -> DataFrame:
    """One row per day of the closed range."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return spark.range(1).select(_days(F.lit(first), F.lit(last)).alias(out))


def date_spine_covering(df: DataFrame, cols: list[str], out: str = "full_date") -> DataFrame:
    """One row per day from the earliest to the latest value found in the date columns."""
    bounds = df.agg(
        F.least(*[F.min(c) for c in cols]).alias("first"),
        F.greatest(*[F.max(c) for c in cols]).alias("last"),
    )
    return bounds.where("first is not null").select(_days(F.col("first"), F.col("last")).alias(out))


def date_key(col: Column) -> Column:
    """20240131 for 2024-01-31. Arithmetic rather than text formatting, so it stays cheap per row."""
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def calendar_key(col: Column, start: str, end: str) -> Column:
    """The date key, or NULL when the calendar has no such day."""
    return F.when(col.between(F.lit(start).cast("date"), F.lit(end).cast("date")), date_key(col))


def is_weekend(col: Column) -> Column:
    return F.dayofweek(col).isin(*WEEKEND)


def date_parts(df: DataFrame, col: str) -> DataFrame:
    """Add year, month, day, day_of_week (1 = Sunday) and quarter of a date column."""
    d = F.col(col)
    return df.select(
        "*",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("day_of_week"),
        F.quarter(d).alias("quarter"),
    )
