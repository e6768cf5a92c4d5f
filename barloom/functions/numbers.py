from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_double(col: Column | str) -> Column:
    """Text to double; anything that is not a number becomes NULL, NaN included.

    The cast itself ignores surrounding blanks. It also takes a type letter behind the
    digits (``12d``), which is no number here.
    """
    text = _col(col)
    plain = text.cast("string")
    value = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    # The pattern only looks at the few texts that end with such a letter.
    lettered = F.right(F.rtrim(plain), F.lit(1)).isin("d", "D", "f", "F")
    return F.when(~(lettered & plain.rlike(r"[0-9.][dDfF]\s*$")), value)


def to_long(col: Column | str) -> Column:
    """Text to bigint. Integers keep all digits; decimals such as ``7.0`` are rounded.

    Decimals are told apart first: a cast that fails costs far more than one that does not.
    """
    text = _col(col)
    decimal = text.contains(".") | text.contains("e") | text.contains("E")
    return F.when(decimal, F.rint(to_double(text)).try_cast("bigint")).otherwise(text.try_cast("bigint"))


def round_cents(col: Column | str) -> Column:
    """Two decimals, half to even on the binary value (not on its decimal text)."""
    return F.rint(_col(col) * F.lit(100.0)) / F.lit(100.0)
