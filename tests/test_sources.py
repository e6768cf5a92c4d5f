"""Raw files written by hand and read back."""

import datetime as dt

import pytest

from barloom import operators as ops
from barloom import schemas as S
from barloom import sources

D = dt.date

LEGACY = "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,ISIN,\n"


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text)
    return str(path)


def test_legacy_layouts_by_name(spark, tmp_path, rows):
    folder = tmp_path / "legacy"
    write(folder, "cm01bhav.csv", LEGACY + "NA,EQ,1,2,0.5,1.5,1.4,1,10,150,01-APR-2016,3,IN1,\n"
          " , EQ,1,2,0.5,1.5,1.4,1,10,150,01-APR-2016,3,IN1,\n")
    # Another column order, and fewer columns.
    write(folder, "cm02bhav.csv", "SERIES,SYMBOL,TIMESTAMP,CLOSE,TOTTRDQTY,TOTTRDVAL\nBE,X ,02-APR-16,7,0,150\n")
    # No date column, no header line, another file name.
    write(folder, "cm03bhav.csv", "SYMBOL,SERIES,CLOSE\nSKIPPED,EQ,1\n")
    write(folder, "cm04bhav.csv", "just,some,text\n")
    write(folder, "other.csv", LEGACY + "OTHER,EQ,1,2,0.5,1.5,1.4,1,10,150,01-APR-2016,3,IN1,\n")
    df = ops.normalize_legacy(sources.read_legacy_prices(spark, str(folder)))
    assert rows(df, "SYMBOL", "SERIES", "DATE1", "CLOSE_PRICE", "AVG_PRICE", "TTL_TRD_QNTY", "NO_OF_TRADES") == [
        ("NA", "EQ", D(2016, 4, 1), 1.5, 15.0, 10, 3),
        ("X", "BE", D(2016, 4, 2), 7.0, None, 0, None),
    ]


def test_full_prices_padded(spark, tmp_path, rows):
    head = ("SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE,"
            " AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER\n")
    line = "A, EQ, 01-Apr-2020, 1, 2, 3, 0.5, 2.5, 2.25, 2, 100, 0.5, 7, {}, {}\n"
    folder = write(tmp_path / "full", "a.csv", head + line.format("60", "60.0") + line.format("60", "60.0"))
    write(tmp_path / "full", "b.csv", head + line.format(" -", " -") + " , EQ, 01-Apr-2020" + ", 1" * 12 + "\n")
    df = ops.normalize_full(sources.read_full_prices(spark, folder))
    assert rows(df, "SYMBOL", "SERIES", "DATE1", "CLOSE_PRICE", "TTL_TRD_QNTY", "DELIV_QTY", "DELIV_PER") == [
        ("A", "EQ", D(2020, 4, 1), 2.25, 100, 60, 60.0),
        ("A", "EQ", D(2020, 4, 1), 2.25, 100, None, None),
    ]
    one = ops.normalize_full(sources.read_full_prices(spark, [f"{folder}/b.csv"]))
    assert rows(one, "DELIV_QTY") == [(None,)]


def test_known_header_skips_the_layout_pass(spark, tmp_path, rows):
    folder = write(tmp_path / "full", "a.csv", "SYMBOL,DATE1,SERIES\nA,01-Apr-2020,EQ\n")
    df = sources.read_full_prices(spark, folder, header=["SYMBOL", "DATE1", "SERIES"])
    assert rows(df, "SYMBOL", "SERIES", "DATE1", "DELIV_PER", "SOURCE_FILE") == [
        ("A", "EQ", "01-Apr-2020", None, "a.csv")
    ]


def test_odd_file_names(spark, tmp_path, rows):
    folder = write(tmp_path / "a b", "x 1+y%z&w.csv", "SYMBOL,SERIES,DATE1\nA,EQ,01-Apr-2020\n")
    write(tmp_path / "a b", "M&M.csv", "SERIES,SYMBOL,DATE1\nEQ,B,01-Apr-2020\n")
    df = sources.read_full_prices(spark, folder)
    assert rows(df, "SYMBOL", "SOURCE_FILE") == [("A", "x 1+y%z&w.csv"), ("B", "M&M.csv")]


def test_no_usable_file(spark, tmp_path):
    folder = write(tmp_path / "full", "a.csv", "nothing\n")
    with pytest.raises(ValueError, match="no header"):
        sources.read_full_prices(spark, folder)
    write(tmp_path / "full", "b.csv", "Symbol,Series,Date1\nA,EQ,01-Apr-2020\n")
    write(tmp_path / "full", "c.csv", '"SYMBOL","NOTE, more",SERIES,DATE1\nA,"x, y",EQ,01-Apr-2020\n')
    with pytest.raises(ValueError, match="no header"):
        sources.read_full_prices(spark, folder)
    skipped = sources.skipped_files(spark, folder, S.PRICE_KEY)
    assert skipped.count() == 2
    (only,) = sources.read_full_prices(spark, str(tmp_path / "full" / "c.csv")).collect()
    assert (only.SYMBOL, only.SERIES, only.DATE1) == ("A", "EQ", "01-Apr-2020")


def test_a_header_that_differs_from_the_given_one_is_an_error(spark, tmp_path):
    folder = write(tmp_path / "full", "a.csv", "DATE1,SYMBOL,SERIES\n01-Apr-2020,B,EQ\n")
    with pytest.raises(Exception, match="CSV header"):
        sources.read_full_prices(spark, folder, header=["SYMBOL", "SERIES", "DATE1"]).collect()


DELIVERY = """Security Wise Delivery Position - Compulsory Rolling Settlement
10,MTO,01042016,123,2
Trade Date <01-APR-2016>,Settlement Type <N>
Record Type,Sr No,Name of Security,Quantity Traded,Deliverable Quantity,% of Deliverable
20,1, ABC ,EQ,100,60,60.0
20,2,DEF,,10,,
20,2,DEF,,10,,

"""


def test_delivery(spark, tmp_path, rows):
    folder = write(tmp_path / "d", "MTO_01042016.DAT", DELIVERY)
    write(tmp_path / "d", "MTO_02042016.DAT", DELIVERY.replace("\n", "\r\n"))
    expected = [
        ("ABC", "EQ", 60, 60.0, D(2016, 4, 1)),
        ("ABC", "EQ", 60, 60.0, D(2016, 4, 2)),
        ("DEF", "UNKNOWN", 0, 0.0, D(2016, 4, 1)),
        ("DEF", "UNKNOWN", 0, 0.0, D(2016, 4, 2)),
    ]
    # The rows do not depend on where a file is split, nor on its preamble.
    for split in ("64", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        df = ops.normalize_delivery(sources.read_delivery(spark, folder))
        assert rows(df, "SYMBOL", "SERIES", "DELIV_QTY", "DELIV_PER", "DATE1") == expected
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    rejected = sources.delivery_rejects(spark, folder)
    assert rows(rejected, "records", "other_lines") == [(3, 4), (3, 4)]


def test_bse(spark, tmp_path, rows):
    text = "SC_CODE,SC_NAME,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,NO_TRADES,NO_OF_SHRS,NET_TURNOV\n" \
           "500002,ABB LTD   ,1,2,0.5,x,1.5,1,7,1000,99.5\n"
    folder = write(tmp_path / "b", "EQ_ISINCODE_010416_T0.CSV", text)
    write(tmp_path / "b", "OTHER.CSV", text.replace("500002", "500003"))
    write(tmp_path / "b", "EQ_ISINCODE_020416_T0.csv", text)
    df = ops.clean_exchange(sources.read_bse_prices(spark, folder), "bse_equity")
    assert rows(df, "SYMBOL", "COMPANY_NAME", "CLOSE", "NO_TRADES", "NET_TURNOV", "DATE1") == [
        ("500002", "ABB LTD", None, 7, 99.5, D(2016, 4, 1)),
        ("500003", "ABB LTD", None, 7, 99.5, None),
    ]


def test_lists(spark, tmp_path, rows):
    folder = tmp_path
    write(folder, "ca.csv", 'SYMBOL,COMPANY,SERIES,PURPOSE,FACE,EX-DATE\nABC,"A, Ltd",EQ,Bonus 1:1,10,05-Jan-2024\n')
    acts = ops.parse_actions(sources.read_actions(spark, f"{folder}/ca.csv"))
    assert rows(acts, "symbol", "ex_date", "action_type") == [("ABC", D(2024, 1, 5), "bonus")]

    write(folder, "nse.csv", "SYMBOL,NAME OF COMPANY, SERIES, ISIN NUMBER\nABC,A Ltd,EQ, IN1\n")
    found = sources.read_security_list(spark, f"{folder}/missing.csv", f"{folder}/nse.csv")
    assert found.columns == ["SYMBOL", "NAME OF COMPANY", "SERIES", "ISIN NUMBER"]


def test_histories(spark, tmp_path, rows):
    folder = tmp_path / "nse" / "ohlcv"
    head = "date,open,high,low,close,adj_close,volume\n"
    write(folder, "GOOD.csv", head + "".join(f"2024-01-{d:02d},1,1,1,1,1,9\n" for d in range(1, 4)))
    write(folder, "SHORT.csv", head + "2024-01-01,1,1,1,1,1,9\n")
    write(folder, "BAD.csv", "date,open\n" + "2024-01-01,1\n" * 3)
    write(folder, "NODATE.csv", head + "soon,1,1,1,1,1,9\n" * 3)
    history = sources.read_histories(spark, str(tmp_path), "NSE")
    checked = ops.completeness_check(history, min_rows=2)
    assert rows(checked, "exchange", "symbol", "rows", "reason") == [
        ("NSE", "BAD", 3, "invalid_columns"),
        ("NSE", "GOOD", 3, None),
        ("NSE", "NODATE", 3, "file_read_error"),
        ("NSE", "SHORT", 1, "insufficient_data"),
    ]
    report = ops.quality_report(checked)
    assert rows(report, "symbol", "details") == [
        ("BAD", "Missing required columns"),
        ("NODATE", ""),
        ("SHORT", "Only 1 rows"),
    ]


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path):
    from barloom.sources.files import layouts

    (tmp_path / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    found = layouts(spark, str(tmp_path), ["A", "B"])
    assert sorted((r.file_path[-5:], r.header) for r in found.collect()) == [("a.csv", "A,B"), ("b.csv", None)]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
