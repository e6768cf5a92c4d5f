"""Adjusted prices against a second price source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import round_cents
from barloom.operators.adjust import only_symbols


def compare_prices(
    adjusted: DataFrame,
    reference: DataFrame,
    symbols: Iterable[str] | DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Both adjusted closes at two decimals and their absolute difference.

    ``reference`` has SYMBOL, DATE1 and ``Adj Close``. The symbol and date limits
    go on both sides, below the join, so they reach the scans.
    """
    ours = adjusted.select("SYMBOL", "DATE1", "CLOSE_PRICE", "ADJ_CLOSE_PRICE")
    theirs = reference.select("SYMBOL", "DATE1", "Adj Close")

    def limited(df: DataFrame) -> DataFrame:
        df = only_symbols(df, symbols, "SYMBOL")
        if start is not None:
            df = df.where(F.col("DATE1") >= F.lit(start).cast("date"))
        if end is not None:
            df = df.where(F.col("DATE1") <= F.lit(end).cast("date"))
        return df

    a, b = round_cents("ADJ_CLOSE_PRICE"), round_cents(F.col("Adj Close"))
    return (
        limited(ours)
        .join(limited(theirs), ["SYMBOL", "DATE1"])
        .select(
            "SYMBOL",
            "DATE1",
            "CLOSE_PRICE",
            a.alias("ADJ_CLOSE"),
            b.alias("ADJ_CLOSE_yfin"),
            F.abs(b - a).alias("adj_close_diff"),
        )
    )


def accuracy(comparison: DataFrame) -> DataFrame:
    """Rows compared, exact matches and the match percentage; NULL differences count as rows."""
    total, matches = F.count(F.lit(1)), F.count_if(F.col("adj_close_diff") == 0)
    return comparison.agg(
        total.alias("total_records"),
        matches.alias("matches"),
        (F.try_divide(matches, total) * 100).alias("accuracy_pct"),
    )


_SHOWN = ["SYMBOL", "DATE1", "ADJ_CLOSE", "ADJ_CLOSE_yfin", "adj_close_diff"]


def top_mismatches(comparison: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest differences; ties by symbol and date."""
    return (
        comparison.where(F.col("adj_close_diff") > 0)
        .select(*_SHOWN)
        .orderBy(F.desc("adj_close_diff"), "SYMBOL", "DATE1", "ADJ_CLOSE", "ADJ_CLOSE_yfin")
        .limit(n)
    )


def sample_matches(comparison: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` exact matches by symbol and date."""
    return (
        comparison.where(F.col("adj_close_diff") == 0)
        .select(*_SHOWN)
        .orderBy("SYMBOL", "DATE1", "ADJ_CLOSE")
        .limit(n)
    )
