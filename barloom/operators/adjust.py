"""Back-adjusted closing prices.

An action changes every close before its ex-date by one multiplier, and the
factor of a price row is the product over all later ex-dates. Along a symbol's
calendar the factor is therefore a step function that changes only at ex-dates.
Two exact plans compute it:

*steps*  The steps are a few rows per symbol. When they are measured to be small
         they are broadcast, and the price table is only scanned: its rows are
         never exchanged. Steps are keyed by symbol and calendar bucket, so a row
         meets at most one step per day of a bucket, whatever its symbol has.
*days*   Otherwise prices are cut to one row per symbol and day before windows
         run by symbol. A window then holds at most one row per calendar day,
         however many rows the symbol has, and the factors go back to the prices
         through a join on symbol and day, which AQE can split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.actions import price_actions, unique_actions
from barloom.operators.sizing import BROADCAST_BYTES, ROW_OVERHEAD

# The series whose close is the reference on a day with several.
SERIES_PRIORITY = ["EQ", "BE"]

EVENT = ["symbol", "ex_date"]

# Buckets of 32, 128 or 512 days. Narrow ones leave fewer steps to a probe, wide
# ones repeat a long step less often.
BUCKET_BITS = [5, 7, 9]


def only_symbols(df: DataFrame, symbols: Iterable[str] | DataFrame | None, column: str) -> DataFrame:
    """Keep the rows of the given symbols: a plain collection, or a frame's first column."""
    if symbols is None:
        return df
    if isinstance(symbols, DataFrame):
        names = symbols.select(F.col(f"`{symbols.columns[0]}`").alias(column))
        return df.join(names, column, "left_semi")
    return df.where(F.col(column).isin(*symbols))


def _effective(actions: DataFrame) -> DataFrame:
    """Actions that can move a price, with the multiplier of splits and bonuses."""
    split = F.try_divide(
        F.col("split_ratio_to"), F.when(F.col("split_ratio_from") > 0, F.col("split_ratio_from"))
    )
    total = F.col("bonus_ratio_from") + F.col("bonus_ratio_to")
    bonus = F.try_divide(F.col("bonus_ratio_to"), F.when(total > 0, total))
    kind = F.col("action_type")
    cash = F.when(kind == "dividend", F.col("dividend_amount"))
    ratio = F.when(kind == "split", split).when(kind == "bonus", bonus)
    return (
        price_actions(actions)
        .where(F.col("symbol").isNotNull() & F.col("ex_date").isNotNull())
        .select(*EVENT, cash.alias("cash"), ratio.alias("ratio"))
        .where((F.col("cash") > 0) | ((F.col("ratio") > 0) & (F.col("ratio") != 1.0)))
    )


def _one_close(prices: DataFrame, group: list[str]) -> DataFrame:
    """One close per symbol and day: preferred series first, then by series name."""
    rank = F.lit(len(SERIES_PRIORITY))
    for place, series in reversed(list(enumerate(SERIES_PRIORITY))):
        rank = F.when(F.col("SERIES") == series, F.lit(place)).otherwise(rank)
    order = F.struct(rank, F.col("SERIES"), -F.coalesce(F.col("CLOSE_PRICE"), F.lit(0.0)))
    first = F.min_by(F.struct("CLOSE_PRICE"), order)
    return prices.groupBy(*group).agg(first["CLOSE_PRICE"].alias("close"))


def _event_multipliers(acts: DataFrame, closes: DataFrame) -> DataFrame:
    """Product of the multipliers of all actions of a symbol on one ex-date."""
    close = F.col("prev_close")
    cash = F.try_divide(close - F.col("cash"), F.when(close > 0, close))
    return (
        acts.join(closes, EVENT, "left")
        .select(*EVENT, F.coalesce("ratio", cash).alias("m"))
        .where((F.col("m") > 0) & (F.col("m") != 1.0))
        .groupBy(*EVENT)
        .agg(F.product("m").alias("m"))
    )


def choose_bucket_bits(events: DataFrame, limit_bytes: int) -> int | None:
    """The narrowest calendar bucket whose steps fit the limit, or None.

    ``events`` has distinct (symbol, ex_date) rows. Each step is counted in every
    bucket it can touch, so the sizes are upper bounds, all taken in one
    aggregation.
    """
    span = F.date_diff(F.max("ex_date"), F.min("ex_date"))
    per = events.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), span.alias("span"))
    width = F.octet_length("symbol") + ROW_OVERHEAD + 8 * 5
    sizes = per.agg(
        *[
            F.sum((2 * F.col("n") + F.shiftright("span", bits)) * width).alias(f"b{bits}")
            for bits in BUCKET_BITS
        ]
    ).first()
    fitting = [bits for bits in BUCKET_BITS if (sizes[f"b{bits}"] or 0) <= limit_bytes]
    return fitting[0] if fitting else None


def _steps(events: DataFrame) -> DataFrame:
    """Half-open day ranges [since, ex_date) between the ex-dates of a symbol.

    ``events`` has one row per symbol and ex-date; the first range is open below.
    """
    since = F.lag("ex_date").over(Window.partitionBy("symbol").orderBy("ex_date"))
    return events.withColumn("since", since)


def _bucket(day: Column, bits: int) -> Column:
    return F.shiftright(F.unix_date(day), bits)


def _join_steps(rows: DataFrame, steps: DataFrame, bits: int, *values: str) -> DataFrame:
    """Add to each row the ``values`` of the step that its SYMBOL and DATE1 fall in.

    Only broadcasts: one row per symbol for the days before its first ex-date, and
    the later steps by bucket. NULL from the last ex-date on.
    """
    first = steps.where(F.col("since").isNull()).select(
        F.col("symbol").alias("f_symbol"),
        F.col("ex_date").alias("f_until"),
        *[F.col(v).alias(f"f_{v}") for v in values],
    )
    last_day = F.date_sub("ex_date", 1)
    later = steps.where(F.col("since").isNotNull()).select(
        F.col("symbol").alias("s_symbol"),
        F.col("since").alias("s_since"),
        F.col("ex_date").alias("s_until"),
        *[F.col(v).alias(f"s_{v}") for v in values],
        F.explode(F.sequence(_bucket(F.col("since"), bits), _bucket(last_day, bits))).alias("s_bucket"),
    )
    day = F.col("DATE1")
    joined = rows.join(F.broadcast(first), F.col("SYMBOL") == F.col("f_symbol"), "left").join(
        F.broadcast(later),
        (F.col("SYMBOL") == F.col("s_symbol"))
        & (_bucket(day, bits) == F.col("s_bucket"))
        & (day >= F.col("s_since"))
        & (day < F.col("s_until")),
        "left",
    )
    found = [F.when(day < F.col("f_until"), F.col(f"f_{v}")).otherwise(F.col(f"s_{v}")).alias(v) for v in values]
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], *found)


def previous_trade_dates(prices: DataFrame, events: DataFrame, bucket_bits: int | None = None) -> DataFrame:
    """As-of, strictly before: the last trade date of a symbol before each of its ex-dates.

    ``events`` has distinct (symbol, ex_date) rows. Events before any trade are
    left out. With ``bucket_bits`` the steps between events are broadcast.
    """
    if bucket_bits is not None:
        located = _join_steps(prices.select("SYMBOL", "DATE1"), _steps(events), bucket_bits, "ex_date")
        last_in_step = (
            located.where(F.col("ex_date").isNotNull())
            .groupBy(F.col("SYMBOL").alias("symbol"), "ex_date")
            .agg(F.max("DATE1").alias("d"))
        )
        known = events.join(last_in_step, EVENT, "left")
        upto = Window.partitionBy("symbol").orderBy("ex_date").rowsBetween(Window.unboundedPreceding, 0)
        found = known.select(*EVENT, F.last("d", ignorenulls=True).over(upto).alias("trade_date"))
    else:
        days = prices.select(F.col("SYMBOL").alias("symbol"), F.col("DATE1").alias("day")).distinct()
        line = days.withColumn("ex_date", F.lit(None).cast("date")).unionByName(
            events.select("symbol", F.col("ex_date").alias("day"), "ex_date")
        )
        before = (
            Window.partitionBy("symbol")
            .orderBy(F.unix_date("day"))
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        traded = F.when(F.col("ex_date").isNull(), F.col("day"))
        found = line.select(*EVENT, F.last(traded, ignorenulls=True).over(before).alias("trade_date"))
        found = found.where(F.col("ex_date").isNotNull())
    return found.where(F.col("trade_date").isNotNull())


def previous_closes(prices: DataFrame, events: DataFrame, bucket_bits: int | None = None) -> DataFrame:
    """The close on the last trade date before each ex-date: symbol, ex_date, prev_close."""
    dates = previous_trade_dates(prices, events, bucket_bits).withColumnRenamed("symbol", "symbol_")
    narrow = prices.select("SYMBOL", "SERIES", "DATE1", "CLOSE_PRICE")
    on_date = (F.col("SYMBOL") == F.col("symbol_")) & (F.col("DATE1") == F.col("trade_date"))
    if bucket_bits is not None:
        # Few rows match: those of one day per event.
        closes = _one_close(narrow.join(F.broadcast(dates), on_date), ["symbol_", "ex_date"])
    else:
        closes = _one_close(narrow, ["SYMBOL", "DATE1"]).join(dates, on_date)
    return closes.select(F.col("symbol_").alias("symbol"), "ex_date", F.col("close").alias("prev_close"))


def _with_adjusted(prices: DataFrame, factor: Column) -> list[Column]:
    names = prices.columns
    place = names.index("CLOSE_PRICE") + 1
    adjusted = (F.col("CLOSE_PRICE") * F.coalesce(factor, F.lit(1.0))).alias("ADJ_CLOSE_PRICE")
    return [*[F.col(n) for n in names[:place]], adjusted, *[F.col(n) for n in names[place:]]]


def adjusted_prices(
    prices: DataFrame,
    actions: DataFrame,
    symbols: Iterable[str] | DataFrame | None = None,
    dedupe_actions: bool = False,
    broadcast_bytes: int = 0,
) -> DataFrame:
    """Price rows with ADJ_CLOSE_PRICE after CLOSE_PRICE.

    A dividend uses the raw close of the day before its ex-date, a split is
    to / from, a bonus is to / (from + to); multipliers that are not positive
    are ignored. ``dedupe_actions`` keeps one action per symbol, date and type.

    Prices are cut to one row per symbol and day; windows over these rows and the
    actions, all in one partitioning, give the factors, which a join takes back. With
    ``broadcast_bytes`` the steps between actions are measured by a small job and, if
    they fit, broadcast instead; that pays where actions are few beside the prices.
    """
    prices = only_symbols(prices, symbols, "SYMBOL")
    actions = only_symbols(actions, symbols, "symbol")
    if dedupe_actions:
        actions = unique_actions(actions)
    acts = _effective(actions)
    bits = choose_bucket_bits(acts.select(*EVENT).distinct(), broadcast_bytes) if broadcast_bytes else None
    if bits is None:
        joined = prices.join(day_factors(prices, acts), ["SYMBOL", "DATE1"], "left")
        return joined.select(*_with_adjusted(prices, F.col("factor")))

    paying = acts.where(F.col("cash").isNotNull()).select(*EVENT).distinct()
    multipliers = _event_multipliers(acts, previous_closes(prices, paying, bits))

    later_or_same = (
        Window.partitionBy("symbol")
        .orderBy(F.desc("ex_date"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    steps = _steps(multipliers.select(*EVENT, F.product("m").over(later_or_same).alias("factor")))
    joined = _join_steps(prices, steps, bits, "factor")
    return joined.select(*_with_adjusted(prices, F.col("factor")))


def day_factors(prices: DataFrame, acts: DataFrame) -> DataFrame:
    """Factor per symbol and trading day, where it is not 1: SYMBOL, DATE1, factor.

    One line of trading days and actions per symbol, partitioned once. The first window
    gives each action the close of the last trading day before it, and so its
    multiplier; the second the product of all later ones, newest day first, so that
    both frames only grow. A symbol has one row per day and action, however hot it is.
    """
    days = _one_close(prices.where("DATE1 is not null"), ["SYMBOL", "DATE1"]).select(
        "SYMBOL", "DATE1", F.struct("close").alias("traded")
    )
    line = days.unionByName(
        acts.select(F.col("symbol").alias("SYMBOL"), F.col("ex_date").alias("DATE1"), "cash", "ratio"),
        allowMissingColumns=True,
    )
    day = F.unix_date("DATE1")
    before = Window.partitionBy("SYMBOL").orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("SYMBOL").orderBy(day.desc()).rangeBetween(Window.unboundedPreceding, -1)
    close = F.last("traded", ignorenulls=True).over(before)["close"]
    line = line.withColumn("prev", close)
    m = F.coalesce("ratio", F.try_divide(F.col("prev") - F.col("cash"), F.when(F.col("prev") > 0, F.col("prev"))))
    line = line.withColumn("m", F.when((m > 0) & (m != 1.0), m))
    line = line.withColumn("factor", F.product("m").over(later))
    return line.where(F.col("traded").isNotNull() & F.col("factor").isNotNull()).select("SYMBOL", "DATE1", "factor")


def adjustment_impact(adjusted: DataFrame) -> DataFrame:
    """Largest downward change in percent, and how many rows changed at all."""
    change = (F.try_divide(F.col("ADJ_CLOSE_PRICE"), F.col("CLOSE_PRICE")) - 1) * 100
    return adjusted.select(F.round(change, 8).alias("pct")).agg(
        F.min("pct").alias("max_price_adjustment"),
        F.count_if(F.col("pct") != 0).alias("rows_adjusted"),
    )
