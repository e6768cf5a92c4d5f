import datetime as dt

import pytest

from barloom import operators as ops

D = dt.date


def parse(spark, text, **options):
    df = spark.createDataFrame([(" abc ", "01-Apr-2024", text, "EQ")], "SYMBOL string, `EX-DATE` string, "
                               "PURPOSE string, SERIES string")
    return tuple(ops.parse_actions(df, **options).first())


NEUTRAL = (0.0, 0.0, 0.0, 1.0, 1.0)


@pytest.mark.parametrize(
    ("text", "kind", "numbers"),
    [
        ("DIVIDEND - RS 10 PER SHARE", "dividend", (10.0, 0.0, 0.0, 1.0, 1.0)),
        ("Dividend Rs5.50", "dividend", (5.5, 0.0, 0.0, 1.0, 1.0)),
        # The dot is not matched, nor is "Re"; a comma ends the number.
        ("DIVIDEND - RS. 10 PER SHARE", "dividend", NEUTRAL),
        ("Dividend - Re 1 Per Share", "dividend", NEUTRAL),
        ("Dividend Rs 1,000", "dividend", (1.0, 0.0, 0.0, 1.0, 1.0)),
        ("BONUS 1:1", "bonus", (0.0, 1.0, 1.0, 1.0, 1.0)),
        ("Stock Split 1:2", "split", (0.0, 0.0, 0.0, 1.0, 2.0)),
        ("STOCK SPLIT FROM RS 10/- TO RS 5/-", "split", NEUTRAL),
        ("RIGHTS 1:3 @ RS 100", "rights", NEUTRAL),
        ("Interim Dividend Rs 2 And Bonus 1:1", "dividend", (2.0, 0.0, 0.0, 1.0, 1.0)),
        ("Bonus 1:1 And Split 1:5", "bonus", (0.0, 1.0, 1.0, 1.0, 1.0)),
        ("  Annual   General \t Meeting ", "annual general meeting", NEUTRAL),
        (None, None, NEUTRAL),
    ],
)
def test_parse(spark, text, kind, numbers):
    assert parse(spark, text) == ("ABC", D(2024, 4, 1), kind, *numbers)


@pytest.mark.parametrize(
    ("text", "numbers"),
    [
        ("DIVIDEND - RS. 10 PER SHARE", (10.0, 0.0, 0.0, 1.0, 1.0)),
        ("Dividend - Re 1 Per Share", (1.0, 0.0, 0.0, 1.0, 1.0)),
        ("Dividend Rs 1,000.50", (1000.5, 0.0, 0.0, 1.0, 1.0)),
        ("STOCK SPLIT FROM RS 10/- TO RS 5/-", (0.0, 0.0, 0.0, 10.0, 5.0)),
        ("Face Value Split From Rs. 10 To Re. 1", (0.0, 0.0, 0.0, 10.0, 1.0)),
        ("Dividend Rs10 Per Share", (10.0, 0.0, 0.0, 1.0, 1.0)),
        ("Split From Rs10/- To Re1/-", (0.0, 0.0, 0.0, 10.0, 1.0)),
        ("Dividend Per Share 3", (0.0, 0.0, 0.0, 1.0, 1.0)),
    ],
)
def test_parse_lenient(spark, text, numbers):
    assert parse(spark, text, lenient=True)[3:] == numbers


def test_unreadable_date_is_null(spark):
    df = spark.createDataFrame([("A", "2024-04-01", "BONUS 1:1", "EQ"), ("A", "31-Feb-2024", "x", "EQ")],
                               "SYMBOL string, `EX-DATE` string, PURPOSE string, SERIES string")
    assert [r.ex_date for r in ops.parse_actions(df).collect()] == [None, None]


def test_unique_actions_keep_one(spark):
    day = D(2024, 1, 2)
    df = spark.createDataFrame(
        [("A", day, "dividend", 2.0, 0.0, 0.0, 1.0, 1.0), ("A", day, "dividend", 1.0, 0.0, 0.0, 1.0, 1.0),
         ("A", day, "bonus", 0.0, 1.0, 1.0, 1.0, 1.0)],
        ops.actions.S.ACTIONS,
    )
    kept = {(r.action_type, r.dividend_amount) for r in ops.unique_actions(df).collect()}
    assert kept == {("dividend", 1.0), ("bonus", 0.0)}
