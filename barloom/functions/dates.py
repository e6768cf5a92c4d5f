from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.text import strip

# Date formats of the raw files.
DAY_MONTH_YEAR = "d-MMM-yyyy"
DAY_MONTH_SHORT_YEAR = "d-MMM-yy"
DELIVERY_FILE_DATE = "ddMMyyyy"
BSE_FILE_DATE = "ddMMyy"


def trade_date(col: Column | str) -> Column:
    """``01-Apr-2016`` in any letter case; NULL when it does not parse."""
    return F.try_to_date(strip(col), DAY_MONTH_YEAR)


def legacy_date(col: Column | str) -> Column:
    """As :func:`trade_date`, then with a two-digit year (69 to 99 are 1969 to 1999), then as an ISO date."""
    text = strip(col)
    short = F.try_to_date(text, DAY_MONTH_SHORT_YEAR)
    return F.coalesce(
        F.try_to_date(text, DAY_MONTH_YEAR),
        F.when(F.year(short) >= 2069, F.add_months(short, -1200)).otherwise(short),
        text.try_cast("date"),
    )
