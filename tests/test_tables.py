"""Stored tables, exports, the streaming load and whole jobs, in temporary folders."""

import datetime as dt
import uuid

import pytest

from barloom import operators as ops
from barloom import schemas as S
from barloom import sinks, sources
from barloom.operators import dedupe
from barloom.plans import jobs, registry
from barloom.session import checkpoint_dir
from barloom.sinks import tables
from barloom.streaming import stream_full_prices

D = dt.date

HEAD = ",".join(S.PRICES.fieldNames()) + "\n"


def line(symbol, day, close=2.0, quantity=100):
    return f"{symbol},EQ,{day},1,2,3,0.5,2.5,{close},2,{quantity},0.5,7,60,60.0\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def prices(spark, *keys):
    base = {f.name: None for f in S.PRICES.fields}
    return spark.createDataFrame(
        [{**base, "SYMBOL": s, "SERIES": "EQ", "DATE1": d, "CLOSE_PRICE": c} for s, d, c in keys], S.PRICES
    )


def test_price_store(spark, tmp_path, rows):
    path = str(tmp_path / "prices")
    sinks.write_prices(prices(spark, ("A", D(2023, 5, 1), 1.0), ("A", D(2024, 5, 1), 2.0)), path)
    batch = prices(spark, ("A", D(2024, 5, 1), 9.0), ("B", D(2024, 5, 2), 3.0), ("B", D(2024, 5, 2), 4.0))
    for _ in range(2):
        sinks.append_prices(spark, path, batch)
    expected = [("A", D(2023, 5, 1), 1.0), ("A", D(2024, 5, 1), 2.0), ("B", D(2024, 5, 2), 3.0)]
    assert rows(sources.read_prices(spark, path), "SYMBOL", "DATE1", "CLOSE_PRICE") == expected
    assert rows(sources.read_prices(spark, path, ["A"], "2024-01-01"), "DATE1") == [(D(2024, 5, 1),)]
    assert sources.read_prices(spark, path).columns == S.PRICES.fieldNames()

    plan = sources.read_prices(spark, path, start="2024-01-01", end="2024-12-31").select("SYMBOL")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in text and "ReadSchema: struct<SYMBOL:string,DATE1:date>" in text

    sinks.append_prices(spark, path, prices(spark))
    sinks.append_prices(spark, str(tmp_path / "fresh"), batch)
    assert sources.read_prices(spark, str(tmp_path / "fresh")).count() == 2


def test_keyed_tables(spark, tmp_path, rows):
    path = str(tmp_path / "actions")
    acts = spark.createDataFrame([("A", D(2024, 1, 1), "bonus", 0.0, 1.0, 1.0, 1.0, 1.0)] * 2, S.ACTIONS)
    for _ in range(2):
        sinks.append_ignore(spark, path, acts, S.ACTION_KEY)
    assert sources.read_action_table(spark, path).count() == 1
    sinks.create_if_absent(spark, path, S.ACTIONS)
    assert sources.read_action_table(spark, path).count() == 1
    sinks.create_if_absent(spark, str(tmp_path / "empty"), S.ACTIONS)
    assert spark.read.parquet(str(tmp_path / "empty")).schema == S.ACTIONS


def test_exports(spark, tmp_path, rows):
    master = spark.createDataFrame([(" ", "A", "Alpha, Ltd", "I1")], S.SECURITY_MASTER)
    sinks.export_csv(master, str(tmp_path / "m"))
    assert rows(sources.read_securities(spark, str(tmp_path / "m"))) == [(" ", "A", "Alpha, Ltd", "I1")]
    assert sinks.comparison_path("r", ["A", "B"], "2024-01-01", D(2024, 2, 1)) == "r/comparison_A_B_20240101_to_20240201"
    for _ in range(2):
        sinks.append_report(spark.createDataFrame([("t", "A", "NSE", "r", "d")], S.SKIPPED), str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == 2
    history = spark.createDataFrame([("NSE", "A", 1), ("BSE", "B", 2)], "exchange string, symbol string, v int")
    sinks.export_histories(history, history, str(tmp_path / "h"))
    assert spark.read.option("header", True).csv(str(tmp_path / "h" / "ohlcv")).where("exchange = 'NSE'").count() == 1


class FakeSession:
    """Just the settings that choose the checkpoint folder."""

    def __init__(self, master, **settings):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": lambda _, key, default: settings.get(key, default)})()


def test_checkpoint_folder_comes_from_the_session(spark):
    assert checkpoint_dir(FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///cp"})) == "hdfs:///cp"
    assert checkpoint_dir(spark).startswith("/tmp")
    with pytest.raises(ValueError):
        checkpoint_dir(FakeSession("yarn"))


def test_stream_equals_batch(spark, tmp_path, rows):
    source, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    put(source / "a.csv", HEAD + line("A", "01-Apr-2024") + line("", "01-Apr-2024") + line("A", "31-Feb-2024"))

    def load():
        query = stream_full_prices(spark, str(source), target, checkpoint=checkpoint, max_files=1)
        query.awaitTermination(120)
        assert query.exception() is None
        return rows(sources.read_prices(spark, target), "SYMBOL", "DATE1", "CLOSE_PRICE")

    assert load() == [("A", D(2024, 4, 1), 2.0)]
    # A late file and a file with rows that are loaded already.
    put(source / "b.csv", HEAD + line("A", "28-Mar-2024") + line("A", "01-Apr-2024", 9.0))
    put(source / "c.csv", HEAD + line("B", "02-Apr-2024") + line("B", "02-Apr-2024"))
    expected = [("A", D(2024, 3, 28), 2.0), ("A", D(2024, 4, 1), 2.0), ("B", D(2024, 4, 2), 2.0)]
    assert load() == expected

    batch = ops.normalize_full(sources.read_full_prices(spark, str(source))).dropna(subset=["DATE1"])
    assert [r[:2] for r in rows(ops.keep_first(batch, S.PRICE_KEY), "SYMBOL", "DATE1")] == [r[:2] for r in expected]


def test_stream_refuses_another_layout(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", "DATE1,SYMBOL\n01-Apr-2024,A\n")
    query = stream_full_prices(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), ["SYMBOL", "DATE1"], str(tmp_path / "cp")
    )
    with pytest.raises(Exception):
        query.awaitTermination(120)


def test_jobs(spark, tmp_path, rows):
    raw, target = tmp_path / "raw", str(tmp_path / "prices")
    put(raw / "full" / "a.csv", HEAD + line("A", "02-Apr-2024", 100) + line("A", "03-Apr-2024", 90))
    put(
        raw / "legacy" / "cm1bhav.csv",
        "SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,\n"
        "A,EQ,1,2,0.5,80,1.4,1,10,150,01-APR-2024,3,\nA,EQ,1,2,0.5,7,1.4,1,10,150,02-APR-2024,3,\n",
    )
    put(raw / "delivery" / "MTO_01042024.DAT", "a\nb\nc\nd\n20,1,A,EQ,10,6,60.0\n")
    summary = jobs.build_price_table(
        spark, target, str(raw / "full"), str(raw / "legacy"), str(raw / "delivery"), str(tmp_path / "csv")
    )
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == S.PRICES.fieldNames()
    assert tuple(summary.first()) == (3, D(2024, 4, 1), D(2024, 4, 3), 1, 1)
    stored = sources.read_prices(spark, target)
    assert rows(stored, "DATE1", "CLOSE_PRICE", "DELIV_QTY") == [
        (D(2024, 4, 1), 80.0, 6), (D(2024, 4, 2), 100.0, 60), (D(2024, 4, 3), 90.0, 60)
    ]

    more = put(raw / "full" / "b.csv", HEAD + line("A", "03-Apr-2024", 1) + line("B", "04-Apr-2024", 5))
    assert jobs.update_price_table(spark, target, [more]).first().total_records == 4
    assert rows(jobs.days_to_load(spark, target, "2024-01-01", "2024-04-08")) == [
        (D(2024, 4, 5),), (D(2024, 4, 8),)
    ]

    ca = put(
        raw / "ca.csv",
        "SYMBOL,SERIES,PURPOSE,EX-DATE\nA,EQ,Bonus 1:1,03-Apr-2024\nA,EQ,Dividend Rs 10,03-Apr-2024\n",
    )
    adjusted = jobs.adjust_prices(spark, target, ca, str(tmp_path / "adj"), str(tmp_path / "ca"), export_root=str(tmp_path / "x"))
    assert spark.read.option("header", True).csv(str(tmp_path / "x" / "actions")).count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "x" / "adjusted_prices")).count() == 4
    assert adjusted.columns == S.ADJ_PRICES.fieldNames()
    assert rows(adjusted.where("SYMBOL = 'A'"), "DATE1", "ADJ_CLOSE_PRICE") == [
        (D(2024, 4, 1), pytest.approx(36.0)), (D(2024, 4, 2), pytest.approx(45.0)), (D(2024, 4, 3), 90.0)
    ]

    quotes = spark.createDataFrame(
        [(D(2024, 4, 2), 100.0, 45.0), (D(2024, 4, 3), 90.0, 91.0)],
        "Date date, `A.NS|Close` double, `A.NS|Adj Close` double",
    )
    comparison = jobs.compare_with_quotes(
        spark, str(tmp_path / "adj"), quotes, {"A": "A.NS"}, "2024-04-01", "2024-04-30", str(tmp_path)
    )
    assert tuple(ops.accuracy(comparison).first()) == (2, 1, 50.0)

    deals = put(
        raw / "deals.csv",
        "Date,Symbol,Security Name,Client Name,Buy / Sell,Quantity Traded,Trade Price / Wght. Avg. Price,Remarks\n"
        '02-Apr-2024,A,Alpha,X,BUY,"1,000",99,-\n02-Apr-2024,A,Alpha,Y,SELL,"2,000",101,-\n',
    )
    report = jobs.report_bulk_deals(spark, deals, target, str(tmp_path / "bulk"), table="bulk_deals")
    assert rows(report, "Symbol", "Quantity_Traded", "Trade_Price_Avg_Price", "CLOSE_PRICE") == [("A", 3000.0, 100.0, 100.0)]
    assert spark.table("bulk_deals").count() == 2

    nse = put(raw / "nse.csv", "SYMBOL,NAME OF COMPANY, ISIN NUMBER\nABC,Alpha,I1\n")
    bse = put(raw / "bse.csv", "Security Id,Security Name,ISIN No\n500001,Alpha Ltd,I1\n500002,Beta Ltd,I2\n")
    jobs.build_master(spark, nse, bse, str(tmp_path / "master"))
    master = sources.read_securities(spark, str(tmp_path / "master"))
    assert rows(master) == [("500001", "ABC", "Alpha", "I1"), ("500002", " ", "Beta Ltd", "I2")]

    put(tmp_path / "data" / "bse" / "ohlcv" / "500001.csv", ",".join(S.OHLCV_COLUMNS) + "\n2024-01-01,1,1,1,1,1,1\n")
    checked = jobs.check_histories(
        spark, str(tmp_path / "data"), "BSE", ops.select_candidates(master, "BSE"), 1, str(tmp_path / "skipped")
    )
    assert rows(checked, "symbol", "reason") == [("500001", None), ("500002", "delisted_or_no_data")]

    cleaned = jobs.process_exchange(spark, str(raw / "full"), "nse_bhav_sec", str(tmp_path / "processed"))
    assert cleaned.count() == 4


def test_streams_keep_their_own_progress(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    put(one / "a.csv", HEAD + line("A", "01-Apr-2020"))
    put(two / "b.csv", HEAD + line("B", "02-Apr-2020"))
    targets = [str(tmp_path / "t1"), str(tmp_path / "t2")]
    for target in targets:
        for source in (one, two, one):
            stream_full_prices(spark, str(source), target).awaitTermination()
        assert sorted(r.SYMBOL for r in sources.read_prices(spark, target).collect()) == ["A", "B"]


def test_build_reports_what_it_leaves_out(spark, tmp_path):
    put(tmp_path / "full" / "a.csv", HEAD + line("A", "01-Apr-2020") + line("B", "31-Feb-2020") + line("", "01-Apr-2020"))
    put(tmp_path / "legacy" / "cm1bhav.csv", "SYMBOL,SERIES\nX,EQ\n")
    report = str(tmp_path / "report")
    jobs.build_price_table(
        spark, str(tmp_path / "t"), full=str(tmp_path / "full"), legacy=str(tmp_path / "legacy"), report=report
    )
    found = {(r.reason, r.rows) for r in spark.read.option("header", True).csv(report).collect()}
    assert found == {("unreadable date", "1"), ("blank key", "1"), ("no header with the required columns", None)}


def test_other_failures_are_not_absence(spark, tmp_path):
    put(tmp_path / "t" / "part-0.parquet", "no parquet")
    with pytest.raises(Exception):
        sinks.append_prices(spark, str(tmp_path / "t"), prices(spark, ("A", D(2024, 5, 1), 9.0)))
    assert (tmp_path / "t" / "part-0.parquet").read_text() == "no parquet"


@pytest.mark.parametrize("rows_together", [1, 100])
def test_large_batches_are_appended_by_years(spark, tmp_path, monkeypatch, rows, rows_together):
    """No two chunks of years are shuffled at once, and the staged batch goes; the rows are the same."""
    written, staged = [], tmp_path / "staged"
    monkeypatch.setattr(tables, "_CHUNK_ROWS", rows_together)
    monkeypatch.setattr(tables, "scratch_dir", lambda spark: str(staged))
    write = tables.write_prices
    monkeypatch.setattr(tables, "write_prices", lambda df, path, mode="overwrite": (written.append(path), write(df, path, mode)))
    days = [("A", D(y, m, 1), float(y + m)) for y in (1999, 2001, 2024) for m in (1, 12)]
    old, fresh = str(tmp_path / "old"), str(tmp_path / "fresh")
    write(prices(spark, ("A", D(2001, 12, 1), 1.0), ("B", D(1999, 6, 1), 1.0)), old)
    for path, chunks in ((old, 3), (old, 3), (fresh, 3)):
        written.clear()
        sinks.append_prices(spark, path, prices(spark, *days, *days, ("A", None, 5.0)))
        assert len(written) == (chunks if rows_together == 1 else 1)
        assert not staged.exists()
    new = sorted((s, d, c) for s, d, c in days)
    assert rows(sources.read_prices(spark, fresh), "SYMBOL", "DATE1", "CLOSE_PRICE") == new
    kept = [r if r[1] != D(2001, 12, 1) else (*r[:2], 1.0) for r in new] + [("B", D(1999, 6, 1), 1.0)]
    assert rows(sources.read_prices(spark, old), "SYMBOL", "DATE1", "CLOSE_PRICE") == kept


def test_append_by_another_key_takes_all_years_at_once(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(tables, "_CHUNK_ROWS", 1)
    path = str(tmp_path / "t")
    sinks.append_prices(spark, path, prices(spark, ("A", D(2020, 1, 1), 1.0), ("A", D(2021, 1, 1), 2.0)), keys=["SYMBOL"])
    assert len(rows(sources.read_prices(spark, path), "SYMBOL")) == 1


@pytest.mark.parametrize("most", [0, 5])
def test_distinct_rows(spark, tmp_path, monkeypatch, rows, most):
    monkeypatch.setattr(dedupe, "REPEATED", most)
    monkeypatch.setattr(dedupe, "scratch_dir", lambda spark: str(tmp_path / uuid.uuid4().hex))
    # Of the first two rows the null stands elsewhere, which a fingerprint does not tell.
    data = [("a", None), (None, "a"), ("b", "c"), ("b", "c"), ("b ", "c"), (None, None), (None, None), ("d", "e")]
    df = spark.createDataFrame(data, "`x.1` string, y string").repartition(3)
    found = sorted((tuple(r) for r in ops.distinct_rows(df).collect()), key=str)
    assert found == sorted(set(data), key=str)
    single = spark.createDataFrame([("a", "b"), ("c", "d")], "x string, y string")
    assert ops.distinct_rows(single) is single


@pytest.mark.parametrize("name", ["files_full_prices", "stream_full_prices_loaded", "stream_reject_report"])
def test_written_files_take_little_disk(spark, tmp_path, monkeypatch, name):
    """Text is packed, and staged batches are gone when the query returns."""
    for module in (registry, tables, dedupe):
        monkeypatch.setattr(module, "scratch_dir", lambda spark: str(tmp_path / uuid.uuid4().hex))
    found = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    names = [p.name for p in tmp_path.rglob("part-*") if p.stat().st_size]
    assert any(n.endswith(".csv.gz") for n in names)
    assert not [p for p in tmp_path.iterdir() if list(p.glob("YEAR=*")) and not list(p.glob("_SUCCESS"))]
    stores = [p for p in tmp_path.iterdir() if list(p.rglob("YEAR=*"))]
    assert len(stores) == (0 if name == "files_full_prices" else 1)
    assert found.count() > 0
