"""Column helpers built only from Spark's own expressions."""

from barloom.functions.dates import legacy_date, trade_date
from barloom.functions.numbers import round_cents, to_double, to_long
from barloom.functions.once import with_once
from barloom.functions.text import clean_header, clean_symbol, snake_header, strip, ticker_name

__all__ = [
    "clean_header",
    "clean_symbol",
    "legacy_date",
    "round_cents",
    "snake_header",
    "strip",
    "ticker_name",
    "to_double",
    "to_long",
    "trade_date",
    "with_once",
]
