"""Literal rows for the remaining operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import functions as fn
from barloom import operators as ops
from barloom import schemas as S

D = dt.date


def text_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_numbers(spark):
    df = text_frame(spark, ["7", " 7.0 ", "9007199254740993", "7.5", "1e2", "-", "", None, "nan", "x"])
    found = df.select(fn.to_double("t").alias("d"), fn.to_long("t").alias("n")).collect()
    assert [r.d for r in found] == [7.0, 7.0, 9007199254740992.0, 7.5, 100.0, None, None, None, None, None]
    assert [r.n for r in found] == [7, 7, 9007199254740993, 8, 100, None, None, None, None, None]


def test_dates(spark):
    df = text_frame(spark, ["01-APR-2016", "1-Apr-2016", " 01-apr-2016 ", "01-APR-16", "2016-04-01", "31-Feb-2016", None])
    found = df.select(fn.trade_date("t").alias("strict"), fn.legacy_date("t").alias("legacy")).collect()
    day = D(2016, 4, 1)
    assert [r.strict for r in found] == [day, day, day, None, None, None, None]
    assert [r.legacy for r in found] == [day, day, day, day, day, None, None]


def test_round_cents(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (None,)], "x double")
    assert [r[0] for r in df.select(fn.round_cents("x")).collect()] == [0.12, 0.14, 2.68, None]


def test_text(spark):
    assert fn.clean_header(" Trade Price / Wght. Avg. Price ") == "Trade_Price__Wght_Avg_Price"
    assert fn.snake_header("Adj Close") == "adj_close"
    df = spark.createDataFrame([(" A#B.C ", "nse"), (None, "BSE")], "s string, e string")
    found = df.select(fn.clean_symbol("s").alias("s"), fn.ticker_name(F.lit("X"), "e").alias("t")).collect()
    assert [tuple(r) for r in found] == [("ABC", "X.NS"), (None, "X.BO")]


PRICE = "SYMBOL string, SERIES string, DATE1 date, CLOSE_PRICE double"


def test_consolidate_prefers_full(spark, rows):
    day = D(2024, 1, 1)
    full = spark.createDataFrame([("A", "EQ", day, 1.0)], PRICE)
    legacy = spark.createDataFrame([("A", "EQ", day, 2.0, 5), ("B", "EQ", day, 3.0, 6), ("B", "EQ", day, 3.0, 6)],
                                   PRICE + ", NO_OF_TRADES bigint")
    assert rows(ops.consolidate(full, legacy)) == [
        ("A", "EQ", day, 1.0, None),
        ("B", "EQ", day, 3.0, 6),
    ]
    empty = spark.createDataFrame([], PRICE)
    assert rows(ops.consolidate(empty, legacy), "SYMBOL") == [("A",), ("B",)]
    assert rows(ops.consolidate(full, empty), "SYMBOL") == [("A",)]


def test_price_table_equals_merge_then_consolidate(spark, rows):
    day = D(2024, 1, 1)
    base = {f.name: None for f in S.PRICES.fields}

    def price(symbol, close, **more):
        return {**base, "SYMBOL": symbol, "SERIES": "EQ", "DATE1": day, "CLOSE_PRICE": close, **more}

    full = spark.createDataFrame([price("A", 1.0, DELIV_QTY=9), price("C", 1.0)], S.PRICES)
    legacy = spark.createDataFrame(
        [price("A", 2.0), price("B", 2.0), price("B", 2.0), price("B", 3.0), price("D", 4.0)], S.PRICES
    ).drop("DELIV_QTY", "DELIV_PER")
    delivery = spark.createDataFrame(
        [("A", "EQ", 5, 0.5, day), ("B", "EQ", 7, 0.7, day), ("B", "EQ", 6, 0.6, day), ("C", "EQ", 8, 0.8, day)],
        "SYMBOL string, SERIES string, DELIV_QTY bigint, DELIV_PER double, DATE1 date",
    )
    found = rows(ops.price_table(full, legacy, delivery), "SYMBOL", "CLOSE_PRICE", "DELIV_QTY", "DELIV_PER")
    merged = ops.consolidate(full, ops.merge_delivery(legacy.distinct(), delivery.distinct()))
    assert found == rows(merged, "SYMBOL", "CLOSE_PRICE", "DELIV_QTY", "DELIV_PER")
    assert found == [("A", 1.0, 9, None), ("B", 2.0, 6, 0.6), ("C", 1.0, None, None), ("D", 4.0, None, None)]


def test_merge_delivery_multiplies(spark):
    day = D(2024, 1, 1)
    prices = spark.createDataFrame([("A", "EQ", day, 1.0)], PRICE)
    delivery = spark.createDataFrame([("A", "EQ", day, 1, 0.1), ("A", "EQ", day, 2, 0.2)],
                                     "SYMBOL string, SERIES string, DATE1 date, DELIV_QTY bigint, DELIV_PER double")
    assert ops.merge_delivery(prices, delivery).count() == 2


def test_incremental_append(spark, rows):
    day = D(2024, 1, 1)
    target = spark.createDataFrame([("A", "EQ", day, 1.0)], PRICE)
    batch = spark.createDataFrame(
        [("A", "EQ", day, 9.0), ("B", "EQ", day, 3.0), ("B", "EQ", day, 2.0), (None, "EQ", day, 2.0)], PRICE
    )
    assert rows(ops.incremental_append(target, batch)) == [("B", "EQ", day, 2.0)]


def test_normalize_delivery(spark, rows):
    df = spark.createDataFrame([(" A ", "", None, None, D(2024, 1, 1)), (" A ", None, "x", "", D(2024, 1, 1))],
                               "SYMBOL string, SERIES string, DELIV_QTY string, DELIV_PER string, DATE1 date")
    assert rows(ops.normalize_delivery(df)) == [("A", "UNKNOWN", 0, 0.0, D(2024, 1, 1))]


def test_clean_exchange_keeps_other_columns(spark):
    df = spark.createDataFrame([("A", "EQ", "01-Apr-2020", "1.5", "z")],
                               "` SYMBOL` string, SERIES string, DATE1 string, `CLOSE_PRICE ` string, EXTRA string")
    assert tuple(ops.clean_exchange(df, "nse_bhav_sec").first()) == ("A", "EQ", D(2020, 4, 1), 1.5, "z")
    with pytest.raises(ValueError):
        ops.clean_exchange(df, "other")


DEALS = "Symbol string, Date date, Quantity_Traded double, Trade_Price__Wght_Avg_Price double"
MARKET = "SYMBOL string, SERIES string, DATE1 date, OPEN_PRICE double, LOW_PRICE double, CLOSE_PRICE double"


def test_bulk(spark):
    day = D(2024, 1, 1)
    deals = spark.createDataFrame([("A", day, 100.0, 10.0), ("A", day, 50.0, None), ("B", day, 7.0, 5.0)], DEALS)
    market = spark.createDataFrame(
        [("A", "EQ", day, 10.0, 10.0, 12.0), ("A", "BE", day, 10.0, 9.0, 8.0), ("C", "EQ", day, 1.0, 1.0, 1.0)], MARKET
    )
    report = {r.Symbol: r for r in ops.bulk_with_prices(deals, market).collect()}
    a, b = report["A"], report["B"]
    assert (a.Quantity_Traded, a.Trade_Price_Avg_Price, a.CLOSE_PRICE) == (300.0, 10.0, 10.0)
    assert (a.is_greater, a.is_open_equal_low) == (0.5, 0.5)
    assert (b.Quantity_Traded, b.CLOSE_PRICE, b.is_greater, b.is_open_equal_low) == (7.0, None, 0.0, 0.0)
    one = {r.Symbol: r for r in ops.bulk_with_prices(deals, market, series="EQ").collect()}
    assert one["A"].Quantity_Traded == 150.0


def test_clean_bulk_deals(spark):
    df = spark.createDataFrame(
        [("01-Apr-2024", "A", "1,234", "1,234.5")],
        "Date string, Symbol string, `Quantity Traded` string, ` Trade Price / Wght. Avg. Price ` string",
    )
    row = ops.clean_bulk_deals(df).first()
    assert (row.Date, row.Quantity_Traded, row.Trade_Price__Wght_Avg_Price) == (D(2024, 4, 1), 1234.0, None)
    assert ops.clean_bulk_deals(df, lenient=True).first().Trade_Price__Wght_Avg_Price == 1234.5
    other = df.withColumnRenamed(" Trade Price / Wght. Avg. Price ", "Trade Price (Wght. Avg. Price)")
    assert "Trade_Price__Wght_Avg_Price" in ops.clean_bulk_deals(other).columns


def test_master(spark, rows):
    nse = spark.createDataFrame(
        [("A#.", "Alpha", " I1 "), ("B", "", "I2"), (None, None, "I3"), ("N", "Nobody", None), ("Z", "Zed", "I5"),
         ("Z2", "Zed again", "I5")],
        "SYMBOL string, `NAME OF COMPANY` string, `ISIN NUMBER` string",
    )
    bse = spark.createDataFrame([("500001", "Alpha Ltd", "I1"), ("500002", "Beta Ltd", "I2"),
                                 ("500003", "Gamma Ltd", "I3"), ("500004", "Delta Ltd", "I4"), ("5", "No", " ")],
                                "`Security Id` string, `Security Name` string, `ISIN No` string")
    master = ops.security_master(nse, bse)
    assert rows(master, "ISIN", "NSE_SYMBOL", "BSE_SYMBOL", "COMPANY_NAME") == [
        ("I1", "A", "500001", "Alpha"),
        ("I2", "B", "500002", "Beta Ltd"),
        ("I3", None, "500003", "Gamma Ltd"),
        ("I4", " ", "500004", "Delta Ltd"),
        ("I5", "Z", " ", "Zed"),
    ]
    assert tuple(ops.master_coverage(master).first()) == (5, 3, 1, 1)
    assert [r.symbol for r in ops.select_candidates(master, "BSE").collect()] == ["500001", "500002", "500003", "500004"] \
        or ops.select_candidates(master, "BSE").count() == 4
    # Both single-letter symbols and the absent one are too short.
    assert ops.select_candidates(master, "NSE").count() == 0


def test_compare_and_accuracy(spark, rows):
    day = D(2024, 1, 1)
    adjusted = spark.createDataFrame(
        [("A", day, 1.0, 1.004), ("B", day, 2.0, 2.5), ("C", day, 3.0, None), ("D", day, 1.0, 1.0)],
        "SYMBOL string, DATE1 date, CLOSE_PRICE double, ADJ_CLOSE_PRICE double",
    )
    reference = spark.createDataFrame([("A", day, 1.0), ("B", day, 2.0), ("C", day, 3.0)],
                                      "SYMBOL string, DATE1 date, `Adj Close` double")
    comparison = ops.compare_prices(adjusted, reference)
    assert tuple(ops.accuracy(comparison).first()) == (3, 1, pytest.approx(100 / 3))
    assert rows(ops.top_mismatches(comparison), "SYMBOL", "adj_close_diff") == [("B", 0.5)]
    assert rows(ops.sample_matches(comparison), "SYMBOL") == [("A",)]
    assert ops.compare_prices(adjusted, reference, ["A"], "2024-01-02").count() == 0


def test_wide_to_long(spark, rows):
    wide = spark.createDataFrame(
        [(D(2024, 1, 1), 1.0, 0.9, None), (D(2024, 1, 2), None, 0.8, 5.0)],
        "Date date, `A.NS|Close` double, `A.NS|Adj Close` double, `B.NS|Close` double",
    )
    tickers = {"A": "A.NS", "A2": "A.NS", "B": "B.NS", "X": "X.NS"}
    assert rows(ops.wide_to_long(wide, tickers)) == [
        ("A", D(2024, 1, 1), 1.0, 0.9),
        ("B", D(2024, 1, 2), 5.0, None),
    ]


def test_history(spark, rows):
    history = spark.createDataFrame(
        [("NSE", "A", "2024-01-01", 1.0, 0.0), ("NSE", "A", "2024-01-02", 0.0, 0.0), ("BSE", "B", "2024-01-01", None, None)],
        "exchange string, symbol string, date string, dividends double, stock_splits double",
    )
    assert rows(ops.extract_actions(history), "symbol", "date") == [("A", "2024-01-01")]
    assert rows(ops.history_counts(history)) == [("BSE", "B", 1, 0), ("NSE", "A", 2, 1)]
    failed = spark.createDataFrame([("A", "NSE", "boom")], S.FAILED)
    assert ("NSE", "div_stock_split", 1) in rows(ops.history_summary(history, failed=failed))
    assert (None, "failed", 1) in rows(ops.history_summary(history, failed=failed))
    renamed = ops.clean_history(spark.createDataFrame([(1, 2)], "`Adj Close` int, `Stock-Splits` int"))
    assert renamed.columns == ["adj_close", "stock_splits"]


def test_calendar(spark, rows):
    assert rows(ops.business_days(spark, "2024-01-05", "2024-01-09")) == [
        (D(2024, 1, 5),), (D(2024, 1, 8),), (D(2024, 1, 9),)
    ]
    assert ops.business_days(spark, "2024-01-09", "2024-01-05").count() == 0
    loaded = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 10),)], "DATE1 date")
    assert rows(ops.missing_dates(loaded)) == [(D(2024, 1, 8),), (D(2024, 1, 9),)]
    assert rows(ops.next_load_days(loaded, "2024-01-01", "2024-01-12")) == [(D(2024, 1, 11),), (D(2024, 1, 12),)]
    empty = spark.createDataFrame([], "DATE1 date")
    assert ops.next_load_days(empty, "2024-01-05", "2024-01-08").count() == 2
    assert ops.missing_dates(empty).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", None), ("B", None)], "SYMBOL string, SERIES string")
    assert tuple(ops.duplicate_count(df).first()) == (4, 2)
    empty = spark.createDataFrame([], S.PRICES)
    assert tuple(ops.dataset_summary(empty).first()) == (0, None, None, 0, 0)
    assert tuple(ops.duplicate_count(empty).first()) == (0, 0)


def test_a_type_letter_makes_no_number(spark):
    from barloom.functions import to_double

    df = spark.createDataFrame([("12d",), ("12f ",), (" 12 ",), ("1e3",), ("x",), (None,)], "v string")
    assert [r.n for r in df.select(to_double("v").alias("n")).collect()] == [None, None, 12.0, 1000.0, None, None]


def test_a_listed_security_without_a_symbol_is_listed(spark):
    df = spark.createDataFrame([(None, "B"), ("A", " "), (" ", "C"), (None, None)], "BSE_SYMBOL string, NSE_SYMBOL string")
    assert tuple(ops.master_coverage(df).first()) == (4, 2, 1, 1)


def test_a_bad_quote_date_is_null(spark):
    df = spark.createDataFrame([("2024-01-02", 1.0), ("soon", 2.0)], "Date string, `T|Close` double")
    found = ops.wide_to_long(df, {"S": "T"}).collect()
    assert [(r.DATE1, r.Close) for r in found] == [(D(2024, 1, 2), 1.0), (None, 2.0)]


def test_rejects(spark):
    rows = [("A", "EQ", "01-Apr-2020", "f"), ("", "EQ", "x", "f"), ("A", "EQ", "31-Feb-2020", "g"), ("A", None, None, "f")]
    df = spark.createDataFrame(rows, "SYMBOL string, SERIES string, DATE1 string, SOURCE_FILE string")
    assert {tuple(r) for r in ops.rejects(df).collect()} == {("f", "blank key", 2), ("g", "unreadable date", 1)}
