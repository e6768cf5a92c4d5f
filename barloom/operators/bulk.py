"""Bulk deals against market prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import clean_header, strip, to_double, trade_date

QUANTITY = "Quantity_Traded"
PRICE = "Trade_Price__Wght_Avg_Price"

# Other spellings of the price header, after cleaning.
PRICE_ALIASES = ["Trade_Price_(Wght_Avg_Price)", "Trade_Price"]

# The market columns that are averaged.
AVERAGED = [
    "PREV_CLOSE",
    "OPEN_PRICE",
    "HIGH_PRICE",
    "LOW_PRICE",
    "LAST_PRICE",
    "CLOSE_PRICE",
    "AVG_PRICE",
    "TTL_TRD_QNTY",
    "TURNOVER_LACS",
    "NO_OF_TRADES",
    "DELIV_QTY",
    "DELIV_PER",
]


def clean_bulk_deals(df: DataFrame, lenient: bool = False) -> DataFrame:
    """Clean headers, parse the date and the two numbers.

    Commas are taken out of quantities only; a price with commas becomes NULL
    unless ``lenient``.
    """
    df = df.toDF(*[clean_header(c) for c in df.columns])
    for alias in PRICE_ALIASES:
        if alias in df.columns and PRICE not in df.columns:
            df = df.withColumnRenamed(alias, PRICE)

    def no_commas(name: str):
        return F.replace(F.col(name).cast("string"), F.lit(","), F.lit(""))

    changes = {}
    if "Date" in df.columns and dict(df.dtypes)["Date"] == "string":
        changes["Date"] = trade_date("Date")
    if QUANTITY in df.columns:
        changes[QUANTITY] = to_double(no_commas(QUANTITY))
    if PRICE in df.columns:
        changes[PRICE] = to_double(no_commas(PRICE) if lenient else strip(F.col(PRICE).cast("string")))
    return df.withColumns(changes)


def bulk_with_prices(
    deals: DataFrame,
    prices: DataFrame,
    series: str | None = None,
) -> DataFrame:
    """Deals left-joined to prices by symbol and day, aggregated to one row per symbol and day.

    Without ``series`` every series of the day joins each deal, so the quantity
    counts once per price row. Join key and group key are the same, so within a
    group every deal meets every price row. Each side is therefore aggregated
    first, on the map side, and the joined sums follow from the two row counts;
    the product of the two groups is never built.
    """
    if series is not None:
        prices = prices.where(F.col("SERIES") == series)
    averaged = [c for c in AVERAGED if c in prices.columns]

    per_deal = deals.groupBy("Symbol", "Date").agg(
        F.sum(QUANTITY).alias("__quantity"), F.avg(PRICE).alias("Trade_Price_Avg_Price")
    )

    market = prices.select(
        F.col("SYMBOL").alias("Symbol"),
        F.col("DATE1").alias("Date"),
        *[c for c in dict.fromkeys([*averaged, "CLOSE_PRICE", "OPEN_PRICE", "LOW_PRICE"])],
    )

    def share(condition):
        return F.avg(F.when(condition, 1.0).otherwise(0.0))

    per_market = market.groupBy("Symbol", "Date").agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.avg(c).alias(c) for c in averaged],
        share(F.col("CLOSE_PRICE") > F.col("OPEN_PRICE")).alias("is_greater"),
        share(F.col("OPEN_PRICE") == F.col("LOW_PRICE")).alias("is_open_equal_low"),
    )

    times = F.coalesce(F.col("__rows"), F.lit(1))
    return per_deal.join(per_market, ["Symbol", "Date"], "left").select(
        "Symbol",
        "Date",
        (F.col("__quantity") * times).alias(QUANTITY),
        "Trade_Price_Avg_Price",
        *averaged,
        F.coalesce("is_greater", F.lit(0.0)).alias("is_greater"),
        F.coalesce("is_open_equal_low", F.lit(0.0)).alias("is_open_equal_low"),
    )


def ordered_result(result: DataFrame) -> DataFrame:
    """The report in date and symbol order."""
    return result.orderBy("Date", "Symbol")


def bulk_sentiment(result: DataFrame) -> DataFrame:
    """Mean of the two flags, and of deal quantity over market quantity."""
    return result.agg(
        F.avg("is_greater").alias("positive_sentiment"),
        F.avg("is_open_equal_low").alias("strong_openings"),
        F.avg(F.try_divide(QUANTITY, "TTL_TRD_QNTY")).alias("avg_volume_impact"),
    )


def price_premium(result: DataFrame) -> DataFrame:
    """Average deal price over the close, less one, per symbol and day."""
    premium = F.try_divide("Trade_Price_Avg_Price", "CLOSE_PRICE") - 1
    return result.withColumn("price_premium", premium)
