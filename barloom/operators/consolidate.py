"""One price table out of two daily formats and a delivery file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.operators.dedupe import keep_first, new_keys

_PRIORITY = "__priority"


def merge_delivery(prices: DataFrame, delivery: DataFrame) -> DataFrame:
    """Left join of delivery on the price key; several delivery rows multiply a price row."""
    return prices.join(delivery.select(*S.PRICE_KEY, "DELIV_QTY", "DELIV_PER"), S.PRICE_KEY, "left")


def consolidate(full: DataFrame, legacy: DataFrame) -> DataFrame:
    """Union by name, one row per key; a full-format row wins over a legacy row.

    Columns that one side lacks are NULL there.
    """
    both = full.withColumn(_PRIORITY, F.lit(0)).unionByName(
        legacy.withColumn(_PRIORITY, F.lit(1)), allowMissingColumns=True
    )
    return keep_first(both, S.PRICE_KEY, [_PRIORITY]).drop(_PRIORITY)


def price_table(full: DataFrame, legacy: DataFrame, delivery: DataFrame) -> DataFrame:
    """The consolidated price table, in canonical column order.

    Same rows as ``consolidate(full, merge_delivery(legacy, delivery))``, but each
    side is cut to one row per key before the join. Prices move once, the join
    reuses that partitioning, and no key is hot on either side.
    """
    marked = full.withColumn(_PRIORITY, F.lit(0)).unionByName(
        legacy.withColumn(_PRIORITY, F.lit(1)), allowMissingColumns=True
    )
    winners = keep_first(marked, S.PRICE_KEY, [_PRIORITY])
    found = keep_first(delivery.select(*S.PRICE_KEY, "DELIV_QTY", "DELIV_PER"), S.PRICE_KEY).select(
        *S.PRICE_KEY, F.col("DELIV_QTY").alias("__qty"), F.col("DELIV_PER").alias("__per")
    )
    joined = winners.join(found, S.PRICE_KEY, "left")
    is_legacy = F.col(_PRIORITY) == 1
    joined = joined.withColumns(
        {
            "DELIV_QTY": F.when(is_legacy, F.col("__qty")).otherwise(F.col("DELIV_QTY")),
            "DELIV_PER": F.when(is_legacy, F.col("__per")).otherwise(F.col("DELIV_PER")),
        }
    )
    return joined.select(*[F.col(f.name).cast(f.dataType) for f in S.PRICES.fields])


def ordered_prices(prices: DataFrame) -> DataFrame:
    """Price rows by date and symbol, for exports; stored tables sort within files instead."""
    return prices.orderBy("DATE1", "SYMBOL", "SERIES")


def incremental_append(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of a new daily batch that the price table does not hold yet."""
    return new_keys(target, batch, S.PRICE_KEY)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``batch`` to append so that existing keys keep their row."""
    return new_keys(target, batch, keys)
