"""Stored tables: the price table, adjusted prices, actions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.adjust import only_symbols

YEAR = "YEAR"


def read_prices(
    spark: SparkSession,
    path: str,
    symbols: Iterable[str] | DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """A stored price table, limited by symbol and inclusive date range.

    Dates also limit the year partitions, so other years are not listed or read.
    """
    df = spark.read.parquet(path)
    for bound, after in ((start, True), (end, False)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            year = F.lit(int(str(bound)[:4]))
            df = df.where((F.col("DATE1") >= day) if after else (F.col("DATE1") <= day))
            if YEAR in df.columns:
                df = df.where((F.col(YEAR) >= year) if after else (F.col(YEAR) <= year))
    return only_symbols(df.drop(YEAR), symbols, "SYMBOL")


def read_action_table(spark: SparkSession, path: str) -> DataFrame:
    """Stored actions of the types that change a price."""
    return spark.read.parquet(path).where(F.col("action_type").isin("dividend", "split", "bonus"))
