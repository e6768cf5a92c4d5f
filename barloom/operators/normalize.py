"""Raw text rows to typed rows: one projection each, no exchange but the row dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions import legacy_date, strip, to_double, to_long, trade_date, with_once


def _text(name: str) -> Column:
    return F.coalesce(strip(name), F.lit(""))


def _keyed(df: DataFrame) -> DataFrame:
    """Reject rows without a symbol or a series."""
    return df.where((F.col("SYMBOL") != "") & (F.col("SERIES") != ""))


def normalize_legacy(df: DataFrame, distinct: bool = True) -> DataFrame:
    """First daily format to the price columns, with average price and turnover derived.

    A zero quantity gives a NULL average. Delivery columns come from
    :func:`barloom.operators.consolidate.merge_delivery`.
    """
    value, quantity = to_double("TOTTRDVAL"), to_double("TOTTRDQTY")
    out = with_once(df, DATE1=legacy_date("TIMESTAMP")).select(
        _text("SYMBOL").alias("SYMBOL"),
        _text("SERIES").alias("SERIES"),
        "DATE1",
        to_double("PREVCLOSE").alias("PREV_CLOSE"),
        to_double("OPEN").alias("OPEN_PRICE"),
        to_double("HIGH").alias("HIGH_PRICE"),
        to_double("LOW").alias("LOW_PRICE"),
        to_double("LAST").alias("LAST_PRICE"),
        to_double("CLOSE").alias("CLOSE_PRICE"),
        F.try_divide(value, quantity).alias("AVG_PRICE"),
        to_long("TOTTRDQTY").alias("TTL_TRD_QNTY"),
        (value / F.lit(100000.0)).alias("TURNOVER_LACS"),
        to_long("TOTALTRADES").alias("NO_OF_TRADES"),
    )
    out = _keyed(out)
    return out.distinct() if distinct else out


def normalize_delivery(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Delivery rows: blank series to UNKNOWN, missing quantity and percent to zero."""
    out = df.select(
        strip("SYMBOL").alias("SYMBOL"),
        F.coalesce(F.nullif(strip("SERIES"), F.lit("")), F.lit("UNKNOWN")).alias("SERIES"),
        F.coalesce(to_long("DELIV_QTY"), F.lit(0)).cast("bigint").alias("DELIV_QTY"),
        F.coalesce(to_double("DELIV_PER"), F.lit(0.0)).alias("DELIV_PER"),
        F.col("DATE1"),
    )
    return out.distinct() if distinct else out


def normalize_full(df: DataFrame, distinct: bool = True) -> DataFrame:
    """Full daily format: stripped keys, strict dates, numbers that do not parse to NULL.

    Rows are made distinct on their raw values, before trimming.
    """
    out = df.select(*S.PRICES.fieldNames())
    out = out.distinct() if distinct else out
    out = with_once(out, __day=trade_date("DATE1")).select(
        _text("SYMBOL").alias("SYMBOL"),
        _text("SERIES").alias("SERIES"),
        F.col("__day").alias("DATE1"),
        *[
            (to_long(n) if n in S.PRICE_INTEGERS else to_double(n)).alias(n)
            for n in S.PRICES.fieldNames()[3:]
        ],
    )
    return _keyed(out)


def clean_exchange(df: DataFrame, source: str) -> DataFrame:
    """Type whichever price columns the frame has, by exchange format.

    ``nse_bhav_sec`` is the full daily format; ``bse_equity`` keeps its columns
    and gains SYMBOL and COMPANY_NAME. Other columns pass through.
    """
    df = df.toDF(*[c.strip() for c in df.columns])
    if source == "nse_bhav_sec":
        numbers, integers = S.PRICE_NUMBERS, S.PRICE_INTEGERS
        texts = {"SYMBOL": _text("SYMBOL"), "SERIES": _text("SERIES"), "DATE1": trade_date("DATE1")}
        added = {}
    elif source == "bse_equity":
        numbers, integers = S.BSE_NUMBERS, S.BSE_INTEGERS
        texts = {}
        added = {
            name: strip(F.col(raw).cast("string"))
            for raw, name in (("SC_CODE", "SYMBOL"), ("SC_NAME", "COMPANY_NAME"))
            if raw in df.columns
        }
    else:
        raise ValueError(f"unknown source: {source}")
    typed = [
        texts[c].alias(c)
        if c in texts
        else to_double(c).alias(c)
        if c in numbers
        else to_long(c).alias(c)
        if c in integers
        else F.col(f"`{c}`")
        for c in df.columns
    ]
    out = df.select(*typed, *[expr.alias(name) for name, expr in added.items()])
    return _keyed(out) if source == "nse_bhav_sec" else out
