"""Wide per-ticker quotes to long rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def wide_to_long(
    wide: DataFrame, tickers: Mapping[str, str], date: str = "Date", separator: str = "|"
) -> DataFrame:
    """Columns named ``TICKER|Field`` to rows of SYMBOL, DATE1 and one column per field.

    ``tickers`` maps symbol to ticker; of several symbols with one ticker the
    first is used. Tickers without columns are left out, as are rows without a
    close. A date or a value that does not parse is NULL. Each input row is exploded where it is, so nothing is exchanged.
    """
    fields = list(
        dict.fromkeys(c.split(separator, 1)[1] for c in wide.columns if separator in c)
    )
    first_symbol: dict[str, str] = {}
    for symbol, ticker in tickers.items():
        first_symbol.setdefault(ticker, symbol)

    def quotes(ticker: str, symbol: str):
        values = [
            (F.col(f"`{ticker}{separator}{f}`") if f"{ticker}{separator}{f}" in wide.columns else F.lit(None))
            .try_cast("double")
            .alias(f)
            for f in fields
        ]
        return F.struct(F.lit(symbol).alias("SYMBOL"), *values)

    present = [t for t in first_symbol if any(c.startswith(t + separator) for c in wide.columns)]
    if not present:
        raise ValueError("no column belongs to any of the tickers")
    rows = wide.select(
        F.col(f"`{date}`").try_cast("date").alias("DATE1"),
        F.inline(F.array(*[quotes(t, first_symbol[t]) for t in present])),
    )
    return rows.where(F.col("Close").isNotNull()).select("SYMBOL", "DATE1", *fields)
