"""Corporate-action text to typed actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import schemas as S
from barloom.functions import strip, trade_date, with_once
from barloom.operators.dedupe import keep_first

# Action keywords in the order they are tried, and the text patterns.
KEYWORDS = ["dividend", "bonus", "split", "rights"]
AMOUNT = r"rs?\s*(\d+(?:\.\d+)?)"
RATIO = r"(\d+):(\d+)"

# Lenient forms: "Rs. 5.50", "Re 1", "Rs 1,000", "from Rs 10/- to Rs 5/-".
LENIENT_AMOUNT = r"\b(?:rs|re)\.?\s*(\d[\d,]*(?:\.\d+)?)"
FACE_VALUE = r"\b(?:rs|re)\.?\s*(\d+(?:\.\d+)?)\D*?\bto\b\D*?(?:rs|re)\.?\s*(\d+(?:\.\d+)?)"


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return F.replace(F.regexp_extract(text, pattern, group), F.lit(","), F.lit("")).try_cast("double")


def parse_actions(
    df: DataFrame,
    symbol: str = "SYMBOL",
    ex_date: str = "EX-DATE",
    purpose: str = "PURPOSE",
    lenient: bool = False,
) -> DataFrame:
    """Type, amount and ratios of each action from its free text.

    By default only the plain forms match: ``Rs 5`` for an amount, ``a:b`` for a
    ratio; everything else keeps the neutral values. ``lenient`` also reads
    dotted and comma amounts and a face value changed from one to another,
    stated so that the price factor is new over old. ``ex_date`` may be text or
    a date.
    """
    text = F.lower("purpose")
    kind = F.when(text.contains(KEYWORDS[0]), KEYWORDS[0])
    for word in KEYWORDS[1:]:
        kind = kind.when(text.contains(word), word)
    kind = kind.otherwise(strip(F.regexp_replace(text, r"\s+", " ")))

    is_date = dict(df.dtypes)[ex_date] == "date"
    day = F.col(f"`{ex_date}`") if is_date else trade_date(F.col(f"`{ex_date}`"))

    found = F.col("text")
    values = {
        "amount": _number(found, LENIENT_AMOUNT if lenient else AMOUNT),
        "first": _number(found, RATIO, 1),
        "second": _number(found, RATIO, 2),
    }
    if lenient:
        values["split_first"] = F.coalesce(values["first"], _number(found, FACE_VALUE, 1))
        values["split_second"] = F.coalesce(values["second"], _number(found, FACE_VALUE, 2))

    def of_kind(word: str, value: str, default: float) -> Column:
        return F.coalesce(F.when(F.col("action_type") == word, F.col(value)), F.lit(default))

    typed = with_once(
        df.select(
            F.upper(strip(F.col(f"`{symbol}`"))).alias("symbol"),
            day.alias("ex_date"),
            F.col(f"`{purpose}`").alias("purpose"),
        ),
        action_type=kind,
        text=text,
    )
    typed = with_once(typed, **values)
    second = "split_second" if lenient else "second"
    first = "split_first" if lenient else "first"
    return typed.select(
        "symbol",
        "ex_date",
        "action_type",
        of_kind("dividend", "amount", 0.0).alias("dividend_amount"),
        of_kind("bonus", "first", 0.0).alias("bonus_ratio_from"),
        of_kind("bonus", "second", 0.0).alias("bonus_ratio_to"),
        of_kind("split", first, 1.0).alias("split_ratio_from"),
        of_kind("split", second, 1.0).alias("split_ratio_to"),
    )


def unique_actions(actions: DataFrame) -> DataFrame:
    """One action per symbol, date and type, as a keyed action table keeps them."""
    return keep_first(actions, S.ACTION_KEY)


def price_actions(actions: DataFrame) -> DataFrame:
    """Only the action types that can change a price."""
    return actions.where(F.col("action_type").isin("dividend", "split", "bonus"))
