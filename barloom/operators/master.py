"""Security master of two exchanges by ISIN, and the candidates taken from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import clean_symbol, strip, ticker_name
from barloom.operators.dedupe import keep_first

# A missing symbol in the master, and where it sorts.
ABSENT = " "
ABSENT_SORT = "zzz"


def _listed(df: DataFrame, symbol: str, name: str, isin: str, prefix: str) -> DataFrame:
    df = df.select(
        clean_symbol(F.col(f"`{symbol}`").cast("string")).alias(f"{prefix}_SYMBOL"),
        F.col(f"`{name}`").alias(f"{prefix}_NAME"),
        strip(F.col(f"`{isin}`")).alias("ISIN"),
    ).where(F.col("ISIN").isNotNull() & (F.col("ISIN") != ""))
    return keep_first(df, ["ISIN"]).withColumn(f"{prefix}_LISTED", F.lit(True))


def security_master(
    nse: DataFrame,
    bse: DataFrame,
    nse_columns: tuple[str, str, str] = ("SYMBOL", "NAME OF COMPANY", "ISIN NUMBER"),
    bse_columns: tuple[str, str, str] = ("Security Id", "Security Name", "ISIN No"),
) -> DataFrame:
    """Full outer match of two security lists on ISIN.

    Each list is first cut to one row per ISIN, and the join reuses that
    partitioning. A security that an exchange does not list has one blank as its
    symbol there. The company name is the first that is not empty, NSE first.
    """
    n = _listed(nse, *nse_columns, "NSE")
    b = _listed(bse, *bse_columns, "BSE")

    def symbol(prefix: str):
        listed = F.col(f"{prefix}_LISTED").isNotNull()
        return F.when(listed, F.col(f"{prefix}_SYMBOL")).otherwise(F.lit(ABSENT)).alias(f"{prefix}_SYMBOL")

    name = F.coalesce(F.nullif(F.col("NSE_NAME"), F.lit("")), F.col("BSE_NAME"), F.col("NSE_NAME"))
    return n.join(b, "ISIN", "full_outer").select(
        symbol("BSE"), symbol("NSE"), name.alias("COMPANY_NAME"), "ISIN"
    )


def ordered_master(master: DataFrame) -> DataFrame:
    """By NSE symbol, securities without one among the ``zzz``; ISIN breaks ties."""
    key = F.when(F.col("NSE_SYMBOL") == ABSENT, ABSENT_SORT).otherwise(F.col("NSE_SYMBOL"))
    return master.orderBy(key, "ISIN")


def first_rows(master: DataFrame, n: int = 10) -> DataFrame:
    return ordered_master(master).limit(n)


def last_rows(master: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` in master order, found with the reversed order and a limit."""
    key = F.when(F.col("NSE_SYMBOL") == ABSENT, ABSENT_SORT).otherwise(F.col("NSE_SYMBOL"))
    return master.orderBy(key.desc(), F.desc("ISIN")).limit(n)


def master_coverage(master: DataFrame) -> DataFrame:
    """How many securities trade on both exchanges, and on one only.

    Only the blank means absent; a listed security whose symbol is NULL is listed.
    """
    on_bse, on_nse = (~F.col(c).eqNullSafe(ABSENT) for c in ("BSE_SYMBOL", "NSE_SYMBOL"))
    return master.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(on_bse & on_nse).alias("both_exchanges"),
        F.count_if(~on_bse & on_nse).alias("nse_only"),
        F.count_if(on_bse & ~on_nse).alias("bse_only"),
    )


def select_candidates(master: DataFrame, exchange: str, limit: int | None = None) -> DataFrame:
    """Symbols of one exchange whose history is to be fetched, with their quote ticker.

    ``limit`` takes the first rows in master order *before* short symbols are
    dropped, so fewer may be left.
    """
    column = f"{exchange.upper()}_SYMBOL"
    rows = master.where(F.col(column).isNotNull() & (F.col(column) != ""))
    if limit:
        rows = ordered_master(rows).limit(limit)
    symbol = strip(F.col(column))
    return rows.select(
        symbol.alias("symbol"), "COMPANY_NAME", F.lit(exchange.upper()).alias("exchange")
    ).where(F.length("symbol") >= 2).withColumn("ticker", ticker_name("symbol", "exchange"))
