from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\v"

# The quote suffix of each exchange.
TICKER_SUFFIX = {"NSE": ".NS", "BSE": ".BO"}


def strip(col: Column | str) -> Column:
    """Remove leading and trailing white space, tabs and line ends included."""
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(_BLANKS))


def clean_header(name: str) -> str:
    """Bulk-deal header: stripped, blanks to underscores, slashes and dots removed."""
    return name.strip().replace(" ", "_").replace("/", "").replace(".", "")


def snake_header(name: str) -> str:
    """History header: blanks and dashes to underscores, lower case."""
    return name.replace(" ", "_").replace("-", "_").lower()


def clean_symbol(col: Column | str) -> Column:
    """Drop ``#`` and ``.`` from a security symbol and strip it."""
    return strip(F.translate(F.col(col) if isinstance(col, str) else col, "#.", ""))


def ticker_name(symbol: Column | str, exchange: Column | str) -> Column:
    """Quote ticker of a symbol; any exchange other than NSE takes the BSE suffix."""
    nse = F.upper(F.col(exchange) if isinstance(exchange, str) else exchange) == "NSE"
    suffix = F.when(nse, TICKER_SUFFIX["NSE"]).otherwise(TICKER_SUFFIX["BSE"])
    return F.concat(F.col(symbol) if isinstance(symbol, str) else symbol, suffix)
