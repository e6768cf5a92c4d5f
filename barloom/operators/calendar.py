"""Business days and the days that are missing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def yesterday() -> str:
    """Last day that a load asks for by default."""
    return str(dt.date.today() - dt.timedelta(days=1))


def business_days(spark: SparkSession, start: str, end: str | None = None) -> DataFrame:
    """Monday to Friday from ``start`` to ``end`` inclusive (yesterday by default)."""
    first, last = F.lit(start).cast("date"), F.lit(end or yesterday()).cast("date")
    days = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return (
        spark.range(1)
        .select(F.explode(days).alias("DATE1"))
        .where(F.weekday("DATE1") < 5)
    )


def business_days_of(days: DataFrame) -> DataFrame:
    """Business days from the first to the last DATE1 of a frame."""
    span = days.agg(F.min("DATE1").alias("lo"), F.max("DATE1").alias("hi")).where(F.col("lo").isNotNull())
    return span.select(F.explode(F.sequence("lo", "hi")).alias("DATE1")).where(F.weekday("DATE1") < 5)


def missing_dates(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Business days of the range that no row of ``df`` has.

    Without ``start`` and ``end`` the range is the one the frame itself spans.
    """
    present = df.select("DATE1").distinct()
    if start is None:
        expected = business_days_of(present)
    else:
        expected = business_days(df.sparkSession, start, end)
    return expected.join(present, "DATE1", "left_anti")


def next_load_days(df: DataFrame, default_start: str, end: str | None = None) -> DataFrame:
    """Business days after the latest loaded day, or from ``default_start`` for an empty table."""
    mark = df.agg(F.max("DATE1").alias("mark"))
    start = F.coalesce(F.date_add("mark", 1), F.lit(default_start).cast("date"))
    last = F.lit(end or yesterday()).cast("date")
    return (
        mark.select(start.alias("start"), last.alias("last"))
        .where(F.col("start") <= F.col("last"))
        .select(F.explode(F.sequence("start", "last")).alias("DATE1"))
        .where(F.weekday("DATE1") < 5)
    )
