"""Counts that the jobs report: ranges, duplicates, rejects, coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions import strip, to_double, trade_date

SKETCH = 14  # logarithm of the registers of a sketch


def dataset_summary(prices: DataFrame) -> DataFrame:
    """Rows, date range, distinct symbols and series.

    Rows are first reduced to one per (symbol, series), so the distinct counts
    run on that small table and not on every price row.
    """
    small = prices.groupBy("SYMBOL", "SERIES").agg(
        F.count(F.lit(1)).alias("n"), F.min("DATE1").alias("lo"), F.max("DATE1").alias("hi")
    )
    return small.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
        F.min("lo").alias("earliest_date"),
        F.max("hi").alias("latest_date"),
        F.count_distinct("SYMBOL").alias("unique_symbols"),
        F.count_distinct("SERIES").alias("unique_series"),
    )


def date_range(df: DataFrame, column: str = "DATE1") -> DataFrame:
    return df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))


def high_water_mark(df: DataFrame, column: str = "DATE1") -> DataFrame:
    """The latest loaded day, and the day after it, where the next load starts."""
    return df.agg(F.max(column).alias("last_date")).withColumn("next_date", F.date_add("last_date", 1))


def distinct_symbols(df: DataFrame, column: str = "SYMBOL") -> DataFrame:
    return df.agg(F.count_distinct(column).alias("symbols"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, and how many of them repeat another row in every column."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
        )
    )


def duplicate_sources(df: DataFrame, keys: list[str], source: str = "SOURCE_FILE") -> DataFrame:
    """Keys that occur more than once: one row per key and source file, with counts.

    Sources stay rows instead of being collected into a list, so a key spread
    over very many files needs no large cell.
    """
    per_source = df.groupBy(*keys, source).agg(F.count(F.lit(1)).alias("rows_in_source"))
    repeated = (
        per_source.groupBy(*keys)
        .agg(F.sum("rows_in_source").alias("rows_total"), F.count(F.lit(1)).alias("sources"))
        .where(F.col("rows_total") > 1)
        .withColumnsRenamed({k: f"__{i}" for i, k in enumerate(keys)})
    )
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    return per_source.join(repeated, same).select(*per_source.columns, "rows_total", "sources")


def ingest_audit(raw: DataFrame) -> DataFrame:
    """Reject counts of full-format text rows, in one pass and without an exchange of rows."""

    def blank(name: str):
        return F.coalesce(strip(name), F.lit("")) == ""

    def bad(name: str):
        return ~blank(name) & to_double(name).isNull()

    numbers = [c for c in [*S.PRICE_NUMBERS, *S.PRICE_INTEGERS] if c in raw.columns]
    rejected = blank("SYMBOL") | blank("SERIES")
    return raw.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(blank("SYMBOL")).alias("empty_symbol"),
        F.count_if(blank("SERIES")).alias("empty_series"),
        F.count_if(~rejected).alias("rows_kept"),
        F.count_if(~rejected & trade_date("DATE1").isNull()).alias("bad_dates"),
        *[F.count_if(~rejected & bad(c)).alias(f"bad_{c.lower()}") for c in numbers],
    )


def yearly_summary(prices: DataFrame, year: str = "YEAR") -> DataFrame:
    """Per year: rows, first and last day, and sketches of the distinct symbols and days.

    Rows of a batch make rows of the same kind, and ``merge_summaries`` adds them to what is
    stored, so a summary is kept up without reading old price rows. A sketch has a fixed size.
    """
    return prices.groupBy(F.year("DATE1").alias(year)).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("DATE1").alias("first_day"),
        F.max("DATE1").alias("last_day"),
        F.hll_sketch_agg("SYMBOL", SKETCH).alias("symbols"),
        F.hll_sketch_agg(F.unix_date("DATE1"), SKETCH).alias("days"),
    )


def merge_summaries(*summaries: DataFrame, by: tuple[str, ...] = ("YEAR",)) -> DataFrame:
    """Yearly summaries of disjoint rows as one; with ``by=()`` one row over all years."""
    parts = reduce(DataFrame.unionByName, summaries)
    return parts.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.hll_union_agg("symbols").alias("symbols"),
        F.hll_union_agg("days").alias("days"),
    )


def summary_counts(summary: DataFrame) -> DataFrame:
    """The summary with numbers in place of sketches, off by some per cent (``SKETCH`` = 14: 0.8 % is one deviation)."""
    return summary.withColumns({name: F.hll_sketch_estimate(name) for name in ("symbols", "days")})


def coverage_report(prices: DataFrame, actions: DataFrame, deals: DataFrame) -> DataFrame:
    """One row over three tables: price rows, dates and symbols, actions, deals."""

    def count_of(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    market = dataset_summary(prices).drop("unique_series")
    parts = market.unionByName(count_of(actions, "corporate_actions"), allowMissingColumns=True)
    parts = parts.unionByName(count_of(deals, "bulk_deals"), allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def rejects(raw: DataFrame, source: str = "SOURCE_FILE") -> DataFrame:
    """Rows of full-format text that no table takes: source, reason, rows; aggregated where they are read."""
    blank = F.lit(False)
    for name in ("SYMBOL", "SERIES"):
        blank = blank | (F.coalesce(strip(name), F.lit("")) == "")
    reason = F.when(blank, "blank key").when(trade_date("DATE1").isNull(), "unreadable date")
    return raw.groupBy(source, reason.alias("reason")).agg(F.count(F.lit(1)).alias("rows")).where("reason is not null")
