"""Canonical schemas. Every number is DOUBLE or BIGINT, every missing value is NULL."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _D, _F, _L = T.StringType(), T.DateType(), T.DoubleType(), T.LongType()

PRICE_KEY = ["SYMBOL", "SERIES", "DATE1"]

PRICES = _struct(
    SYMBOL=_S,
    SERIES=_S,
    DATE1=_D,
    PREV_CLOSE=_F,
    OPEN_PRICE=_F,
    HIGH_PRICE=_F,
    LOW_PRICE=_F,
    LAST_PRICE=_F,
    CLOSE_PRICE=_F,
    AVG_PRICE=_F,
    TTL_TRD_QNTY=_L,
    TURNOVER_LACS=_F,
    NO_OF_TRADES=_L,
    DELIV_QTY=_L,
    DELIV_PER=_F,
)

PRICE_NUMBERS = [f.name for f in PRICES.fields if f.dataType == _F]
PRICE_INTEGERS = [f.name for f in PRICES.fields if f.dataType == _L]

_close = PRICES.fieldNames().index("CLOSE_PRICE") + 1
ADJ_PRICES = T.StructType(
    PRICES.fields[:_close] + [T.StructField("ADJ_CLOSE_PRICE", _F)] + PRICES.fields[_close:]
)

ACTION_KEY = ["symbol", "ex_date", "action_type"]

ACTIONS = _struct(
    symbol=_S,
    ex_date=_D,
    action_type=_S,
    dividend_amount=_F,
    bonus_ratio_from=_F,
    bonus_ratio_to=_F,
    split_ratio_from=_F,
    split_ratio_to=_F,
)

DELIVERY_RAW = _struct(
    RECORD_TYPE=_S,
    SR_NO=_S,
    SYMBOL=_S,
    SERIES=_S,
    QUANTITY_TRADED=_S,
    DELIV_QTY=_S,
    DELIV_PER=_S,
)

# Columns of the first daily price format, in file order.
LEGACY_COLUMNS = [
    "SYMBOL",
    "SERIES",
    "OPEN",
    "HIGH",
    "LOW",
    "CLOSE",
    "LAST",
    "PREVCLOSE",
    "TOTTRDQTY",
    "TOTTRDVAL",
    "TIMESTAMP",
    "TOTALTRADES",
]

BSE_NUMBERS = ["OPEN", "HIGH", "LOW", "CLOSE", "LAST", "PREVCLOSE", "NET_TURNOV"]
BSE_INTEGERS = ["NO_TRADES", "NO_OF_SHRS"]
BSE_COLUMNS = ["SC_CODE", "SC_NAME", *BSE_NUMBERS, *BSE_INTEGERS]

SECURITY_MASTER = _struct(BSE_SYMBOL=_S, NSE_SYMBOL=_S, COMPANY_NAME=_S, ISIN=_S)

OHLCV_COLUMNS = ["date", "open", "high", "low", "close", "adj_close", "volume"]
DIV_SPLIT_COLUMNS = ["date", "dividends", "stock_splits"]

SKIPPED = _struct(timestamp=_S, symbol=_S, exchange=_S, reason=_S, details=_S)
FAILED = _struct(symbol=_S, exchange=_S, error=_S)
