"""Whole jobs: read raw files, run the operators, write the tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import operators as ops
from barloom import schemas as S
from barloom import sinks, sources
from barloom.sources.files import Paths


def _or_empty(df: DataFrame | None, spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema) if df is None else df


def _report(rejects: DataFrame, path: str | None) -> None:
    """Add rejects (SOURCE_FILE, reason, rows if there is such a column) to the report."""
    if path is not None:
        rows = F.col("rows") if "rows" in rejects.columns else F.lit(None).cast("bigint").alias("rows")
        sinks.append_report(rejects.select("SOURCE_FILE", "reason", rows), path)


def build_price_table(
    spark: SparkSession,
    target: str,
    full: Paths | None = None,
    legacy: Paths | None = None,
    delivery: Paths | None = None,
    export: str | None = None,
    report: str | None = None,
) -> DataFrame:
    """Consolidate all raw files into the price table and return its summary.

    Any of the three inputs may be missing. ``export`` also writes ordered CSV;
    ``report`` takes what was left out: files, rows by file and reason.
    """
    full_rows = legacy_rows = delivery_rows = None
    if full is not None:
        raw = sources.read_full_prices(spark, full)
        _report(ops.rejects(raw), report)
        full_rows = ops.normalize_full(raw, distinct=False).dropna(subset=["DATE1"])
    if legacy is not None:
        raw = sources.read_legacy_prices(spark, legacy)
        _report(ops.rejects(raw.withColumn("DATE1", F.col("TIMESTAMP"))), report)
        _report(sources.skipped_files(spark, legacy, S.LEGACY_COLUMNS[:2] + ["TIMESTAMP"], pathGlobFilter=sources.prices.LEGACY_GLOB), report)
        legacy_rows = ops.normalize_legacy(raw, distinct=False).dropna(subset=["DATE1"])
    if delivery is not None:
        other = sources.delivery_rejects(spark, delivery).select("SOURCE_FILE", F.lit("no delivery record").alias("reason"), F.col("other_lines").alias("rows"))
        _report(other.where("rows > 0"), report)
        delivery_rows = ops.normalize_delivery(sources.read_delivery(spark, delivery), distinct=False)
    delivery_schema = "SYMBOL string, SERIES string, DELIV_QTY bigint, DELIV_PER double, DATE1 date"
    prices = ops.price_table(
        _or_empty(full_rows, spark, S.PRICES),
        _or_empty(legacy_rows, spark, S.PRICES),
        _or_empty(delivery_rows, spark, delivery_schema),
    )
    sinks.write_prices(prices, target)
    stored = sources.read_prices(spark, target)
    if export is not None:
        sinks.export_csv(ops.ordered_prices(stored), export)
    return ops.dataset_summary(stored)


def update_price_table(spark: SparkSession, target: str, files: Paths, report: str | None = None) -> DataFrame:
    """Append the rows of new full-format files by key and return the table's summary.

    ``report`` takes the rows that were left out, by file and reason.
    """
    raw = sources.read_full_prices(spark, files)
    _report(ops.rejects(raw), report)
    batch = ops.normalize_full(raw, distinct=False).dropna(subset=["DATE1"])
    sinks.append_prices(spark, target, batch)
    return ops.dataset_summary(sources.read_prices(spark, target))


def adjust_prices(
    spark: SparkSession,
    prices: str,
    actions_csv: str,
    target: str,
    actions_table: str | None = None,
    symbols: Iterable[str] | None = None,
    lenient: bool = False,
    export_root: str | None = None,
) -> DataFrame:
    """Parse the actions, adjust the stored prices, write them, and return what was written.

    With ``actions_table`` the actions are also kept there by key, and only the
    kept ones count. ``export_root`` also takes both results as CSV.
    """
    actions = ops.parse_actions(sources.read_actions(spark, actions_csv), lenient=lenient)
    if export_root is not None:
        sinks.export_csv(actions, f"{export_root}/actions")
    if actions_table is not None:
        sinks.append_ignore(spark, actions_table, actions, S.ACTION_KEY)
        actions = sources.read_action_table(spark, actions_table)
    adjusted = ops.adjusted_prices(sources.read_prices(spark, prices), actions, symbols)
    sinks.write_prices(adjusted, target)
    stored = sources.read_prices(spark, target)
    if export_root is not None:
        sinks.export_csv(stored, f"{export_root}/adjusted_prices")
    return stored


def compare_with_quotes(
    spark: SparkSession,
    adjusted: str,
    quotes: DataFrame,
    tickers: Mapping[str, str],
    start: str,
    end: str,
    export_root: str | None = None,
) -> DataFrame:
    """Compare stored adjusted prices with wide quotes of a second source."""
    reference = ops.wide_to_long(quotes, tickers)
    ours = sources.read_prices(spark, adjusted, list(tickers), start, end)
    comparison = ops.compare_prices(ours, reference, list(tickers), start, end)
    if export_root is not None:
        sinks.export_csv(comparison, sinks.comparison_path(export_root, tickers, start, end))
    return comparison


def report_bulk_deals(
    spark: SparkSession,
    deals_csv: str,
    prices: str,
    target: str,
    table: str | None = None,
    series: str | None = None,
) -> DataFrame:
    """Clean the deals, optionally keep them as a table, and export the report."""
    deals = ops.clean_bulk_deals(sources.read_bulk_deals(spark, deals_csv))
    if table is not None:
        sinks.replace_table(deals, table)
        deals = spark.table(table)
    report = ops.bulk_with_prices(deals, sources.read_prices(spark, prices), series)
    sinks.export_csv(ops.ordered_result(report), target)
    return report


def process_exchange(spark: SparkSession, paths: Paths, source: str, export: str | None = None) -> DataFrame:
    """Read, de-duplicate and clean the daily files of one exchange."""
    if source == "bse_equity":
        raw = sources.read_bse_prices(spark, paths)
    else:
        raw = sources.read_full_prices(spark, paths)
    cleaned = ops.clean_exchange(raw.drop("SOURCE_FILE").distinct(), source)
    if export is not None:
        sinks.export_csv(cleaned, export)
    return cleaned


def build_master(
    spark: SparkSession, nse_csv: str, bse_csv: str, export: str | None = None, fallback: str | None = None
) -> DataFrame:
    """Match the two security lists and export the ordered master."""
    nse = sources.read_security_list(spark, nse_csv, fallback)
    bse = sources.read_security_list(spark, bse_csv)
    master = ops.security_master(nse, bse)
    if export is not None:
        sinks.export_csv(ops.ordered_master(master), export)
    return master


def check_histories(
    spark: SparkSession,
    root: str,
    exchange: str,
    candidates: DataFrame,
    min_rows: int = 30,
    skip_log: str | None = None,
) -> DataFrame:
    """Complete and rejected histories of an exchange, with candidates that have none."""
    history = sources.read_histories(spark, root, exchange)
    checked = ops.completeness_check(history, min_rows)
    absent = ops.missing_histories(candidates, history)
    result = checked.unionByName(absent, allowMissingColumns=True)
    if skip_log is not None:
        sinks.append_report(ops.quality_report(result), skip_log)
    return result


def days_to_load(spark: SparkSession, prices: str, default_start: str, end: str | None = None) -> DataFrame:
    """Business days after the latest stored day, taken from its newest year only."""
    stored = spark.read.parquet(prices)
    # One value; as a literal it prunes the partitions.
    newest = stored.agg(F.max("YEAR")).first()[0]
    recent = stored.where(F.col("YEAR") == F.lit(newest))
    return ops.next_load_days(recent, default_start, end)
