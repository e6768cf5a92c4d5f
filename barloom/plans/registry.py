"""Queries over the test tables: one for each operator, on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import operators as ops
from barloom import schemas as S
from barloom import sinks, sources
from barloom.functions import legacy_date, round_cents
from barloom.plans.derived import load
from barloom.session import scratch_dir, set_speed
from barloom.streaming import read_stream_rejects, stream_full_prices

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


class Tables:
    """Derived inputs of one run, loaded by attribute name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)

    # Typed inputs that several queries share.
    @property
    def actions(self) -> DataFrame:
        return ops.parse_actions(self.ca_raw, ex_date="EX_DATE")

    # Keep-first by key also drops equal rows, so no row dedup comes before it.
    @property
    def legacy(self) -> DataFrame:
        return ops.normalize_legacy(self.legacy_raw, distinct=False)

    @property
    def delivery(self) -> DataFrame:
        return ops.normalize_delivery(self.delivery_raw, distinct=False)

    @property
    def full(self) -> DataFrame:
        """Full-format rows with a readable date."""
        return ops.normalize_full(self.full_raw, distinct=False).where(F.col("DATE1").isNotNull())

    @property
    def deals(self) -> DataFrame:
        return ops.clean_bulk_deals(self.bulk_raw)

    @property
    def comparison(self) -> DataFrame:
        adjusted = self.bars.withColumn("ADJ_CLOSE_PRICE", F.col("CLOSE_PRICE"))
        return ops.compare_prices(adjusted, self.ref_prices.withColumnRenamed("AdjClose", "Adj Close"))

    @property
    def master(self) -> DataFrame:
        return ops.security_master(
            self.nse_list,
            self.bse_list,
            ("SYMBOL", "NAME_OF_COMPANY", "ISIN_NUMBER"),
            ("Security_Id", "Security_Name", "ISIN_No"),
        )


def query(fn: Callable[[Tables], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        set_speed(spark)
        return fn(Tables(spark, sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Round computed doubles to 8 places so that two engines' last bits agree."""
    return df.withColumns({n: F.round(n, 8) for n in names})


# Adjusted prices -------------------------------------------------------------


def _adjusted(t: Tables, **options) -> DataFrame:
    """Six decimals, rounded on the binary value, so that both engines agree."""
    adjusted = ops.adjusted_prices(t.bars, t.actions, **options)
    return adjusted.withColumn("ADJ_CLOSE_PRICE", F.rint(F.col("ADJ_CLOSE_PRICE") * 1e6) / 1e6)


def _adjusted_market(t: Tables, **options) -> DataFrame:
    actions = ops.parse_actions(t.ca_market, ex_date="EX_DATE")
    return ops.adjusted_prices(t.market, actions, **options).withColumn(
        "ADJ_CLOSE_PRICE", round_cents("ADJ_CLOSE_PRICE")
    )


@query
def adjusted_prices(t: Tables) -> DataFrame:
    return _adjusted(t)


@query
def adjusted_prices_by_days(t: Tables) -> DataFrame:
    """The same with the default given: nothing is measured or broadcast."""
    return _adjusted(t, broadcast_bytes=0)


@query
def adjusted_prices_by_steps(t: Tables) -> DataFrame:
    """The plan for few actions: their steps are measured and broadcast."""
    return _adjusted(t, broadcast_bytes=ops.adjust.BROADCAST_BYTES)


@query
def adjusted_prices_deduped(t: Tables) -> DataFrame:
    return _adjusted(t, dedupe_actions=True)


@query
def adjusted_prices_of_symbols(t: Tables) -> DataFrame:
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return _adjusted(t, symbols=building.select(F.concat(F.lit("S"), F.col("c_custkey").cast("string"))))


@query
def adjusted_prices_multi_series(t: Tables) -> DataFrame:
    return _adjusted_market(t)


@query
def adjusted_prices_multi_series_by_days(t: Tables) -> DataFrame:
    return _adjusted_market(t, broadcast_bytes=0)


@query
def previous_closes(t: Tables) -> DataFrame:
    events = t.actions.select("symbol", "ex_date").distinct()
    return ops.previous_closes(t.bars, events)


@query
def previous_closes_by_steps(t: Tables) -> DataFrame:
    events = t.actions.select("symbol", "ex_date").distinct()
    return ops.previous_closes(t.bars, events, bucket_bits=5)


@query
def previous_trade_dates(t: Tables) -> DataFrame:
    events = t.actions.select("symbol", "ex_date").distinct()
    return ops.previous_trade_dates(t.bars, events)


@query
def adjustment_impact(t: Tables) -> DataFrame:
    return ops.adjustment_impact(ops.adjusted_prices(t.bars, t.actions))


@query
def parse_actions(t: Tables) -> DataFrame:
    return t.actions


@query
def parse_actions_lenient(t: Tables) -> DataFrame:
    return ops.parse_actions(t.ca_raw, ex_date="EX_DATE", lenient=True)


@query
def unique_actions(t: Tables) -> DataFrame:
    return ops.unique_actions(t.actions)


@query
def price_actions(t: Tables) -> DataFrame:
    return ops.price_actions(t.actions)


# Raw formats and the price table ---------------------------------------------


@query
def normalize_legacy(t: Tables) -> DataFrame:
    return ops.normalize_legacy(t.legacy_raw)


@query
def normalize_delivery(t: Tables) -> DataFrame:
    return ops.normalize_delivery(t.delivery_raw)


@query
def normalize_full(t: Tables) -> DataFrame:
    return ops.normalize_full(t.full_raw)


@query
def clean_exchange_nse(t: Tables) -> DataFrame:
    return ops.clean_exchange(t.full_raw, "nse_bhav_sec")


@query
def clean_exchange_bse(t: Tables) -> DataFrame:
    return ops.clean_exchange(t.bse_raw, "bse_equity")


@query
def merge_delivery(t: Tables) -> DataFrame:
    return ops.merge_delivery(ops.normalize_legacy(t.legacy_raw), ops.normalize_delivery(t.delivery_raw))


@query
def consolidate(t: Tables) -> DataFrame:
    return ops.consolidate(t.full, t.legacy)


@query
def price_table(t: Tables) -> DataFrame:
    return ops.price_table(t.full, t.legacy, t.delivery)


@query
def incremental_append(t: Tables) -> DataFrame:
    return ops.incremental_append(t.legacy, t.full)


@query
def insert_ignore_actions(t: Tables) -> DataFrame:
    """Announcements of the whole month into a table that holds the dividends."""
    held = ops.unique_actions(t.actions.where(F.col("action_type") == "dividend"))
    return ops.insert_ignore(held, t.actions, S.ACTION_KEY)


# Quality and calendar --------------------------------------------------------


@query
def dataset_summary(t: Tables) -> DataFrame:
    return ops.dataset_summary(t.market)


@query
def date_range(t: Tables) -> DataFrame:
    return ops.date_range(t.market)


@query
def high_water_mark(t: Tables) -> DataFrame:
    return ops.high_water_mark(t.market)


@query
def distinct_symbols(t: Tables) -> DataFrame:
    return ops.distinct_symbols(t.market)


@query
def duplicate_count(t: Tables) -> DataFrame:
    return ops.duplicate_count(t.file_rows)


@query
def duplicate_sources(t: Tables) -> DataFrame:
    return ops.duplicate_sources(t.file_rows, S.PRICE_KEY)


@query
def ingest_audit(t: Tables) -> DataFrame:
    return ops.ingest_audit(t.full_raw)


@query
def coverage_report(t: Tables) -> DataFrame:
    return ops.coverage_report(t.market, t.actions, t.deals)


@query
def business_days_of(t: Tables) -> DataFrame:
    return ops.business_days_of(t.loaded_days)


@query
def missing_dates(t: Tables) -> DataFrame:
    return ops.missing_dates(t.loaded_days)


@query
def missing_dates_in_range(t: Tables) -> DataFrame:
    return ops.missing_dates(t.loaded_days, "1994-12-01", "2001-08-31")


@query
def next_load_days(t: Tables) -> DataFrame:
    return ops.next_load_days(t.loaded_days, "1995-01-01", "2001-09-30")


# Second price source ---------------------------------------------------------


@query
def wide_to_long(t: Tables) -> DataFrame:
    names = {"view": "VIEW.NS", "click": "CLICK.NS", "error": "ERROR.NS"}
    wide = t.quotes_by_day
    for prefix, ticker in names.items():
        wide = wide.withColumnRenamed(f"{prefix}_close", f"{ticker}|Close")
        wide = wide.withColumnRenamed(f"{prefix}_adj", f"{ticker}|Adj Close")
    tickers = {prefix.upper(): ticker for prefix, ticker in names.items()} | {"LATER": "VIEW.NS", "NONE": "NONE.NS"}
    return ops.wide_to_long(wide, tickers).withColumnRenamed("Adj Close", "AdjClose")


@query
def compare_prices(t: Tables) -> DataFrame:
    return t.comparison


@query
def compare_prices_in_range(t: Tables) -> DataFrame:
    adjusted = t.bars.withColumn("ADJ_CLOSE_PRICE", F.col("CLOSE_PRICE"))
    reference = t.ref_prices.withColumnRenamed("AdjClose", "Adj Close")
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    symbols = building.select(F.concat(F.lit("S"), F.col("c_custkey").cast("string")))
    return ops.compare_prices(adjusted, reference, symbols, "2024-01-10", "2024-01-20")


@query
def accuracy(t: Tables) -> DataFrame:
    return ops.accuracy(t.comparison)


@query
def top_mismatches(t: Tables) -> DataFrame:
    return ops.top_mismatches(t.comparison)


@query
def sample_matches(t: Tables) -> DataFrame:
    return ops.sample_matches(t.comparison)


# Bulk deals ------------------------------------------------------------------

_AVERAGES = [
    "Trade_Price_Avg_Price",
    *ops.bulk.AVERAGED,
    "is_greater",
    "is_open_equal_low",
]


@query
def clean_bulk_deals(t: Tables) -> DataFrame:
    return t.deals


@query
def bulk_with_prices(t: Tables) -> DataFrame:
    return rounded(ops.bulk_with_prices(t.deals, t.market), *_AVERAGES)


@query
def bulk_with_prices_shuffled(t: Tables) -> DataFrame:
    """Both sides aggregated by their keys beforehand, so the join sees them partitioned alike."""
    return rounded(ops.bulk_with_prices(t.deals.hint("shuffle_hash"), t.market), *_AVERAGES)


@query
def bulk_with_prices_one_series(t: Tables) -> DataFrame:
    return rounded(ops.bulk_with_prices(t.deals, t.market, series="EQ"), *_AVERAGES)


@query
def bulk_sentiment(t: Tables) -> DataFrame:
    report = ops.bulk_sentiment(ops.bulk_with_prices(t.deals, t.market))
    return rounded(report, *report.columns)


@query
def price_premium(t: Tables) -> DataFrame:
    report = ops.price_premium(ops.bulk_with_prices(t.deals, t.market))
    return rounded(report.select("Symbol", "Date", "price_premium"), "price_premium")


# Security master -------------------------------------------------------------


@query
def security_master(t: Tables) -> DataFrame:
    return t.master


@query
def master_coverage(t: Tables) -> DataFrame:
    return ops.master_coverage(t.master)


@query
def master_first_rows(t: Tables) -> DataFrame:
    return ops.first_rows(t.master, 10)


@query
def master_last_rows(t: Tables) -> DataFrame:
    return ops.last_rows(t.master, 10)


@query
def candidates_nse(t: Tables) -> DataFrame:
    return ops.select_candidates(t.master, "NSE")


@query
def candidates_bse(t: Tables) -> DataFrame:
    return ops.select_candidates(t.master, "BSE")


@query
def candidates_bse_limited(t: Tables) -> DataFrame:
    """The limit is the feature: it is taken before short symbols are dropped."""
    return ops.select_candidates(t.master, "BSE", limit=50)


# Histories -------------------------------------------------------------------


@query
def history_ohlcv(t: Tables) -> DataFrame:
    return ops.ohlcv(t.history)


@query
def extract_actions(t: Tables) -> DataFrame:
    return ops.extract_actions(t.history)


@query
def completeness_check(t: Tables) -> DataFrame:
    return ops.completeness_check(t.history, min_rows=27)


@query
def missing_histories(t: Tables) -> DataFrame:
    listed = t.customer.select(
        F.when(F.col("c_custkey") % 2 == 0, "NSE").otherwise("BSE").alias("exchange"),
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("symbol"),
    )
    return ops.missing_histories(listed, t.history)


@query
def quality_report(t: Tables) -> DataFrame:
    checked = ops.completeness_check(t.history, min_rows=27)
    return ops.quality_report(checked).drop("timestamp")


@query
def history_counts(t: Tables) -> DataFrame:
    return ops.history_counts(t.history)


@query
def history_summary(t: Tables) -> DataFrame:
    checked = ops.completeness_check(t.history, min_rows=27)
    skipped = checked.where(F.col("reason").isNotNull())
    failed = checked.where(F.col("reason") == "file_read_error")
    return ops.history_summary(t.history, skipped, failed)


# Files and stored tables ------------------------------------------------------
# These write the derived rows to a new folder below the checkpoint folder first.


def _csv(t: Tables, df: DataFrame, **options) -> str:
    path = scratch_dir(t.spark)
    sinks.export_csv(df, path, **options)
    return path


# Text takes less disk so; a file is read by one task.
_PACKED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}
_PACKED_GLOB = "*.csv.gz"


@query
def files_full_prices(t: Tables) -> DataFrame:
    """Full-format files of two layouts, one of them with its columns reversed."""
    raw = t.full_raw
    turned = raw.select(*reversed(raw.columns))
    paths = [
        _csv(t, raw.where(F.col("SERIES").isNotNull()), **_PACKED),
        _csv(t, turned.where(F.col("SERIES").isNull()), **_PACKED),
    ]
    read = sources.read_full_prices(t.spark, paths, glob=_PACKED_GLOB).select(*S.PRICES.fieldNames())
    return ops.normalize_full(ops.distinct_rows(read), distinct=False)


@query
def files_delivery(t: Tables) -> DataFrame:
    """All delivery rows as one MTO_DDMMYYYY.DAT per day, with preamble and a trailer, read back."""
    path = scratch_dir(t.spark)
    raw = t.delivery_raw.withColumn("FILE", F.date_format("DATE1", "'MTO_'ddMMyyyy'.DAT'"))
    record = F.concat_ws(",", *[F.coalesce(n, F.lit("")) for n in S.DELIVERY_RAW.names])
    other = ["Security Wise Delivery Position", "10,MTO,01042016,123,2", "Trade Date <01-APR-2016>", "Record Type,Sr No", " "]
    around = raw.select("FILE").distinct().select(F.explode(F.array(*map(F.lit, other))).alias("value"), "FILE")
    lines = raw.select(record.alias("value"), "FILE").union(around)
    lines.repartition("FILE").write.partitionBy("FILE").text(path)
    return ops.normalize_delivery(sources.read_delivery(t.spark, path, glob="*.txt"))


@query
def files_reject_report(t: Tables) -> DataFrame:
    """Rows of full-format files that no table takes, by reason."""
    raw = sources.read_full_prices(t.spark, _csv(t, t.full_raw))
    return ops.rejects(raw).groupBy("reason").agg(F.sum("rows").alias("rows"))


@query
def files_legacy_prices(t: Tables) -> DataFrame:
    path = _csv(t, t.legacy_raw)
    return ops.normalize_legacy(sources.read_legacy_prices(t.spark, path, glob="*.csv"))


@query
def files_actions(t: Tables) -> DataFrame:
    day = F.date_format("EX_DATE", "dd-MMM-yyyy").alias("EX-DATE")
    path = _csv(t, t.ca_raw.select("SYMBOL", day, "PURPOSE", F.lit("EQ").alias("SERIES")))
    return ops.parse_actions(sources.read_actions(t.spark, path))


@query
def files_bulk_deals(t: Tables) -> DataFrame:
    path = _csv(
        t,
        t.bulk_raw.select(
            F.date_format("Date", "dd-MMM-yyyy").alias("Date"),
            "Symbol",
            F.col("Quantity_Traded").alias("Quantity Traded"),
            F.col("Trade_Price__Wght_Avg_Price").alias("Trade Price / Wght. Avg. Price"),
        ),
    )
    return ops.clean_bulk_deals(sources.read_bulk_deals(t.spark, path))


@query
def files_security_master(t: Tables) -> DataFrame:
    """The exported master read back; absent symbols are still one blank."""
    return sources.read_securities(t.spark, _csv(t, ops.ordered_master(t.master)))


@query
def store_prices_in_range(t: Tables) -> DataFrame:
    """The partitioned price table, read back for some years."""
    path = scratch_dir(t.spark)
    sinks.write_prices(t.market, path)
    return sources.read_prices(t.spark, path, start="1996-06-01", end="1999-02-28")


@query
def store_prices_appended(t: Tables) -> DataFrame:
    """Full-format rows appended by key to a stored table of legacy rows, twice."""
    path = scratch_dir(t.spark)
    legacy = t.legacy.select(
        *[
            (F.col(f.name) if f.name in t.legacy.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in S.PRICES.fields
        ]
    )
    sinks.write_prices(ops.keep_first(legacy, S.PRICE_KEY), path)
    for _ in range(2):
        sinks.append_prices(t.spark, path, t.full)
    return sources.read_prices(t.spark, path)


@query
def store_actions_by_key(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark)
    for _ in range(2):
        sinks.append_ignore(t.spark, path, t.actions, S.ACTION_KEY)
    return sources.read_action_table(t.spark, path)


@query
def stream_full_prices_loaded(t: Tables) -> DataFrame:
    """Full-format files loaded by the streaming job; one micro-batch takes them all."""
    source, target = _csv(t, t.full_raw, **_PACKED), scratch_dir(t.spark)
    stream_full_prices(t.spark, source, target, checkpoint=scratch_dir(t.spark), glob=_PACKED_GLOB).awaitTermination()
    return sources.read_prices(t.spark, target)


@query
def stream_reject_report(t: Tables) -> DataFrame:
    """What the streaming job left out, by reason; the second run finds no new file."""
    source, target, progress = _csv(t, t.full_raw, **_PACKED), scratch_dir(t.spark), scratch_dir(t.spark)
    for _ in range(2):
        stream_full_prices(t.spark, source, target, checkpoint=progress, glob=_PACKED_GLOB).awaitTermination()
    return read_stream_rejects(t.spark, target).groupBy("reason").agg(F.sum("rows").alias("rows"))


@query
def files_histories_check(t: Tables) -> DataFrame:
    """Listed symbols against their history files: without a column, with a header only, with an unreadable
    first date, too short, absent, or complete."""
    root = scratch_dir(t.spark)
    kind = F.substring("symbol", 2, 20).cast("bigint") % 5
    prices = t.history.select("exchange", "symbol", *S.OHLCV_COLUMNS)
    first = F.min("date").over(Window.partitionBy("exchange", "symbol"))
    undated = prices.where(kind == 3).withColumn("date", F.when(F.col("date") != first, F.col("date")))
    headers = prices.where(kind == 2).select("exchange", "symbol", F.lit(",".join(S.OHLCV_COLUMNS)).alias("date")).distinct()
    sinks.export_histories(prices.where(kind.isin(0, 4)), None, root)
    sinks.export_histories(undated, None, root, mode="append")
    sinks.export_histories(prices.where(kind == 1).drop("volume"), None, root, mode="append")
    headers.write.mode("append").options(sep="|").partitionBy("exchange", "symbol").csv(f"{root}/ohlcv")
    listed = t.customer.select(
        F.when(F.col("c_custkey") % 2 == 0, "NSE").otherwise("BSE").alias("exchange"),
        F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("symbol"),
    )
    rows = [sources.read_histories(t.spark, root, e, exported=True) for e in ("NSE", "BSE")]
    files = sources.history_files(t.spark, root, exported=True)
    return ops.check_history_files(listed, files, rows[0].unionByName(rows[1]), min_rows=27).drop("length")


@query
def files_histories_roundtrip(t: Tables) -> DataFrame:
    """Both kinds of histories written by symbol and read back from there."""
    root = scratch_dir(t.spark)
    sinks.export_histories(t.history.select("exchange", "symbol", *S.OHLCV_COLUMNS), ops.extract_actions(t.history), root)
    parts = []
    for kind in ("ohlcv", "div_stock_split"):
        for exchange in ("NSE", "BSE"):
            rows = sources.read_histories(t.spark, root, exchange, kind, exported=True).drop("columns_ok", "row_order")
            parts.append(rows.withColumn("kind", F.lit(kind)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    numbers = [c for c in out.columns if c not in ("exchange", "symbol", "kind", "date")]
    return out.select("exchange", "symbol", "kind", "date", *[F.col(c).cast("double").alias(c) for c in numbers])


@query
def store_skip_log(t: Tables) -> DataFrame:
    """Skipped histories of two runs in one log; the first of them is repeated."""
    path = scratch_dir(t.spark)
    for run, least in (("first", 27), ("first", 27), ("second/again", 30)):
        report = ops.quality_report(ops.completeness_check(t.history, min_rows=least))
        sinks.append_log(report, path, run)
    return sinks.read_log(t.spark, path, S.SKIPPED).drop("timestamp")


def _catalog_name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


@query
def table_prices_bucketed(t: Tables) -> DataFrame:
    """The last row of each symbol, from a table in buckets by symbol: nothing is exchanged above the scan."""
    name = _catalog_name("prices")
    sinks.write_keyed_table(t.market, name, ["SYMBOL"], ["DATE1"], 8, scratch_dir(t.spark))
    last = Window.partitionBy("SYMBOL").orderBy(F.desc("DATE1"), "SERIES")
    ranked = t.spark.table(name).withColumn("rank", F.row_number().over(last))
    return ranked.where("rank = 1").select("SYMBOL", "SERIES", "DATE1", "CLOSE_PRICE")


@query
def table_deals_replaced(t: Tables) -> DataFrame:
    """Cleaned deals in a keyed table that is replaced twice."""
    name, path = _catalog_name("deals"), scratch_dir(t.spark)
    for deals in (t.deals.where(F.col("Trade_Price__Wght_Avg_Price") > 1000), t.deals, t.deals):
        sinks.replace_keyed_table(deals, name, ["Symbol"], ["Date"], 8, path)
    return t.spark.table(name)


@query
def summary_by_sketch(t: Tables) -> DataFrame:
    """Yearly summaries of stored rows and of a batch, merged; distinct counts are within 5 % of the exact ones."""
    new = F.col("DATE1") >= F.lit("1996-06-15").cast("date")
    merged = ops.merge_summaries(*[ops.yearly_summary(t.market.where(part)) for part in (~new, new)])
    exact = t.market.groupBy(F.year("DATE1").alias("YEAR")).agg(
        F.countDistinct("SYMBOL").alias("exact_symbols"), F.countDistinct("DATE1").alias("exact_days")
    )
    joined = ops.summary_counts(merged).join(exact, "YEAR")

    def close(name: str):
        return (F.abs(F.col(name) - F.col(f"exact_{name}")) <= 0.05 * F.col(f"exact_{name}")).alias(f"{name}_close")

    return joined.select("YEAR", "rows", "first_day", "last_day", "exact_symbols", "exact_days", close("symbols"), close("days"))


def _in_order(t: Tables, df: DataFrame, order: list[str]) -> DataFrame:
    path = scratch_dir(t.spark)
    sinks.export_in_order(df, path, order)
    kinds = dict(df.dtypes)
    return t.spark.read.schema(", ".join(["position bigint", *[f"`{c}` {kinds[c]}" for c in df.columns]])).option("header", True).csv(path)


@query
def files_prices_in_order(t: Tables) -> DataFrame:
    """All price rows exported by day and symbol, each with its place."""
    return _in_order(t, t.market.select("DATE1", "SYMBOL", "SERIES", "CLOSE_PRICE"), ["DATE1", "SYMBOL", "SERIES"])


@query
def files_bulk_in_order(t: Tables) -> DataFrame:
    deals = t.deals.select("Date", "Symbol", "Quantity_Traded", "Trade_Price__Wght_Avg_Price")
    return _in_order(t, deals, deals.columns)


@query
def files_security_lists(t: Tables) -> DataFrame:
    """Both security lists from files to the master; one folder holds two column orders, names hold line ends."""
    nse = t.nse_list.withColumn("NAME_OF_COMPANY", F.translate("NAME_OF_COMPANY", " ", "\n"))
    half = F.length("NAME_OF_COMPANY") % 2 == 0
    path = _csv(t, nse.where(half))
    sinks.export_csv(nse.where(~half).select(*reversed(nse.columns)), path, mode="append")
    read = sources.read_security_list(t.spark, path).withColumn("NAME_OF_COMPANY", F.translate("NAME_OF_COMPANY", "\n", " "))
    bse = sources.read_security_list(t.spark, "/nowhere/list.csv", fallback=_csv(t, t.bse_list))
    return ops.security_master(
        read, bse, ("SYMBOL", "NAME_OF_COMPANY", "ISIN_NUMBER"), ("Security_Id", "Security_Name", "ISIN_No")
    )


@query
def files_bse_prices(t: Tables) -> DataFrame:
    """Second-exchange rows as one file per month, the date in its name, 20 years on: two-digit years are this century's."""
    path = scratch_dir(t.spark)
    name = F.date_format(F.date_add(F.trunc("DATE1", "MM"), 7305), "'EQ_ISINCODE_'ddMMyy'_T0.CSV'").alias("FILE")
    t.bse_raw.select(*[c for c in t.bse_raw.columns if c != "DATE1"], name).repartition("FILE").write.option("header", True).partitionBy("FILE").csv(path)
    rows = ops.clean_exchange(sources.read_bse_prices(t.spark, path, glob="*.csv"), "bse_equity")
    return rows.select("SC_CODE", "SC_NAME", "OPEN", "HIGH", "LOW", "CLOSE", "NO_OF_SHRS", "NO_TRADES", "DATE1", "SYMBOL", "COMPANY_NAME")


@query
def legacy_date_forms(t: Tables) -> DataFrame:
    """Dates of the first format in all its forms, one of them unreadable."""
    day = F.to_date("l_shipdate")
    forms = F.lit(None).cast("string")
    for n, form in enumerate(("dd-MMM-yyyy", "d-MMM-yy", "yyyy-MM-dd", "MM/dd/yyyy")):
        forms = F.when(F.col("l_linenumber") % 4 == n, F.date_format(day, form)).otherwise(forms)
    return t.lineitem.select("l_orderkey", "l_linenumber", legacy_date(forms).alias("day"))
