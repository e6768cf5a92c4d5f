"""History files, logs, keyed tables, ordered exports, sketches and lists, from files made here."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom import operators as ops
from barloom import schemas as S
from barloom import sinks, sources
from barloom.functions import legacy_date, to_double
from barloom.streaming import read_stream_rejects, stream_full_prices

HEADER = "date,open,high,low,close,adj_close,volume"
ROW = "2024-01-{:02d},1,2,0.5,1.5,1.4,10"


def write(folder, files):
    folder.mkdir(parents=True)
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines), encoding="utf-8")


@pytest.fixture
def root(tmp_path):
    days = [ROW.format(d) for d in range(1, 31)]
    write(tmp_path / "nse" / "ohlcv", {
        "OK.csv": [HEADER, *days],
        # The first row counts, not the least date.
        "LATE.csv": [HEADER, "someday,1,2,0.5,1.5,1.4,10", *days],
        "NODATE.csv": [HEADER.replace("date", "day"), *days],
        "FEW.csv": ["﻿" + HEADER, *days[:3]],
        "M&M+A.csv": [HEADER],
        "EMPTY.csv": [],
        "BLANK.csv": ["", ""],
        "NOCOLUMN.csv": ["date,open"],
    })
    write(tmp_path / "bse" / "ohlcv", {"500001.csv": [",".join(reversed(HEADER.split(","))), *[",".join(reversed(r.split(","))) for r in days]]})
    return str(tmp_path)


def test_every_reason_of_a_history_file(spark, root):
    names = ["OK", "LATE", "NODATE", "FEW", "M&M+A", "EMPTY", "BLANK", "NOCOLUMN", "GONE"]
    candidates = spark.createDataFrame([("NSE", n) for n in names] + [("BSE", "500001"), ("BSE", "OK"), ("NSE", "OK")], "exchange string, symbol string")
    rows = sources.read_histories(spark, root, "NSE").unionByName(sources.read_histories(spark, root, "BSE"))
    checked = ops.check_history_files(candidates, sources.history_files(spark, root), rows).collect()
    assert {(r.exchange, r.symbol): (r.rows, r.reason) for r in checked} == {
        ("NSE", "OK"): (30, None),
        ("NSE", "LATE"): (31, "file_read_error"),
        ("NSE", "NODATE"): (30, "invalid_columns"),
        ("NSE", "FEW"): (3, "insufficient_data"),
        ("NSE", "M&M+A"): (0, "insufficient_data"),
        ("NSE", "EMPTY"): (None, "delisted_or_no_data"),
        ("NSE", "BLANK"): (0, "file_read_error"),
        ("NSE", "NOCOLUMN"): (0, "invalid_columns"),
        ("NSE", "GONE"): (None, "delisted_or_no_data"),
        ("BSE", "500001"): (30, None),
        ("BSE", "OK"): (None, "delisted_or_no_data"),
    }
    assert len(checked) == 11
    failed = {(r.symbol, r.error) for r in ops.failed_report(spark.createDataFrame(checked)).collect()}
    assert failed == {
        ("LATE", "first row without a readable date"),
        ("BLANK", "no columns to read from the file"),
    }


def test_files_of_an_exchange_without_a_folder(spark, tmp_path):
    assert sources.history_files(spark, str(tmp_path)).count() == 0


def test_contents_are_not_read_for_the_list_of_files(spark, root):
    plan = sources.history_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan binaryFile" in line]
    assert scans and all("content" not in line.split("Batched")[0] for line in scans)


def test_histories_round_trip_with_odd_symbols(spark, tmp_path, rows):
    names = ["A", "M&M", "X/Y", "50%", "a b+c", "001"]
    days = [(e, n, f"2024-01-0{d}", float(d), 1.0, 1.0, 1.0, 1.0, d) for e in ("NSE", "BSE") for n in names for d in (1, 2)]
    prices = spark.createDataFrame(days, "exchange string, symbol string, date string, open double, high double, low double, close double, adj_close double, volume bigint")
    sinks.export_histories(prices, None, str(tmp_path / "out"))
    for exchange in ("NSE", "BSE"):
        back = sources.read_histories(spark, str(tmp_path / "out"), exchange, exported=True)
        assert rows(back, "symbol", "date", "open") == sorted((n, f"2024-01-0{d}", f"{d}.0") for n in names for d in (1, 2))
    files = sources.history_files(spark, str(tmp_path / "out"), exported=True)
    assert {(r.exchange, r.symbol, r.header) for r in files.collect()} == {(e, n, HEADER) for e in ("NSE", "BSE") for n in names}


def test_a_repeated_run_does_not_double_the_log(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    for run, error in (("2024-01-01", "first try"), ("2024-01-01", "timeout"), ("a/b 1%", "gone, for good")):
        sinks.append_log(spark.createDataFrame([("S", "NSE", error)], S.FAILED), path, run)
    assert rows(sinks.read_log(spark, path, S.FAILED), "error", "run_id") == [("gone, for good", "a/b 1%"), ("timeout", "2024-01-01")]


def full_row(symbol, day, series="EQ"):
    return ",".join([symbol, series, day, *["1"] * 12])


def test_rejects_of_a_stream_survive_a_replay(spark, tmp_path, rows):
    header = ",".join(S.PRICES.fieldNames())
    write(tmp_path / "in", {"one.csv": [header, full_row("A", "01-Jan-2024"), full_row(" ", "01-Jan-2024"), full_row("B", "31-Feb-2024")]})
    target = str(tmp_path / "prices")
    expected = [("one.csv", "blank key", 1), ("one.csv", "unreadable date", 1)]
    for n in range(2):  # Another checkpoint: the same batch again.
        stream_full_prices(spark, str(tmp_path / "in"), target, checkpoint=str(tmp_path / f"progress{n}")).awaitTermination()
        assert rows(read_stream_rejects(spark, target), "SOURCE_FILE", "reason", "rows") == expected
        assert sources.read_prices(spark, target).count() == 1
    write(tmp_path / "more", {"two.csv": [header, full_row("C", "02-Jan-2024")]})
    (tmp_path / "more" / "two.csv").rename(tmp_path / "in" / "two.csv")
    stream_full_prices(spark, str(tmp_path / "in"), target, checkpoint=str(tmp_path / "progress1")).awaitTermination()
    assert rows(read_stream_rejects(spark, target), "SOURCE_FILE", "reason", "rows") == expected
    assert sources.read_prices(spark, target).count() == 2


def test_the_batch_of_an_append_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def day(n):
        seen.add(1)
        return dt.date(2024, 1, n)

    batch = spark.range(1, 21).withColumn("DATE1", F.udf(day, "date").asNondeterministic()("id")).select(
        *[F.col("DATE1") if f.name == "DATE1" else (F.lit("A") if f.name in ("SYMBOL", "SERIES") else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.PRICES.fields]
    )
    path = str(tmp_path / "prices")
    for n in (1, 2, 3):
        sinks.append_prices(spark, path, batch)
        assert seen.value == 20 * n
        assert sources.read_prices(spark, path).count() == 20
    sinks.append_prices(spark, path, batch.where("false"))
    assert sources.read_prices(spark, path).count() == 20


def test_keyed_tables_need_no_exchange(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"), F.col("id").alias("v"))
    for name in ("keyed_a", "keyed_b"):
        sinks.write_keyed_table(rows, name, ["k"], ["v"], 4, str(tmp_path / name))
    a, b = spark.table("keyed_a"), spark.table("keyed_b")
    joined = a.groupBy("k").agg(F.sum("v").alias("s")).hint("merge").join(b, "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and joined.count() == 1000


def test_replacing_a_table_leaves_begun_jobs_alone(spark, tmp_path):
    rows = spark.range(10).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    sinks.replace_keyed_table(rows, "swapped", ["k"], ["v"], 2, str(tmp_path))
    begun = spark.table("swapped")
    sinks.replace_keyed_table(rows.union(rows), "swapped", ["k"], ["v"], 2, str(tmp_path))
    assert begun.count() == 10 and spark.table("swapped").count() == 20
    sinks.replace_keyed_table(rows.limit(1), "swapped", ["k"], ["v"], 2, str(tmp_path))
    assert spark.table("swapped").count() == 1
    assert len(spark.catalog.listTables(pattern="swapped__*")) == 2


def test_summaries_merge(spark):
    prices = spark.range(20_000).select(
        F.concat(F.lit("S"), F.col("id") % 5000).alias("SYMBOL"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int")).alias("DATE1")
    )
    parts = [ops.yearly_summary(prices.where(F.crc32(F.col("SYMBOL").cast("binary")) % 2 == n)) for n in (0, 1)]
    merged = ops.summary_counts(ops.merge_summaries(*parts)).collect()
    whole = {r["YEAR"]: r for r in ops.summary_counts(ops.yearly_summary(prices)).collect()}
    for r in merged:
        w = whole[r["YEAR"]]
        assert (r.rows, r.first_day, r.last_day) == (w.rows, w.first_day, w.last_day)
        assert abs(r.days - w.days) <= 0.03 * w.days
    all_years = ops.summary_counts(ops.merge_summaries(*parts, by=())).first()
    assert abs(all_years.symbols - 5000) <= 0.03 * 5000 and all_years.rows == 20_000


def test_exports_in_order(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") % 70).alias("a"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("b")).repartition(6)
    sinks.export_in_order(df, str(tmp_path / "out"), ["a", "b"])
    lines = [line.split(",") for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines() if not line.startswith("position")]
    assert [int(line[0]) for line in lines] == list(range(1, 5001))
    found = [(int(a), b) for _, a, b in lines]
    assert found == sorted(found, key=lambda r: (r[0], r[1] != "", int(r[1] or 0)))


def test_lists_of_two_layouts_with_line_ends_in_quotes(spark, tmp_path, rows):
    write(tmp_path / "lists", {"a.csv": ["﻿SYMBOL, NAME ,ISIN", 'A,"Two', 'lines, ""so""",IN1'], "b.csv": ["ISIN,SYMBOL", "IN2,B"]})
    read = sources.read_security_list(spark, str(tmp_path / "lists"))
    assert rows(read, "SYMBOL", "NAME", "ISIN") == [("A", 'Two\nlines, "so"', "IN1"), ("B", None, "IN2")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_security_list(spark, str(tmp_path / "none"))


def test_values_that_are_no_numbers(spark):
    wide = spark.createDataFrame([("2024-01-01", "n/a", "3")], "Date string, `A|Close` string, `B|Close` string")
    assert [tuple(r) for r in ops.wide_to_long(wide, {"A": "A", "B": "B"}).collect()] == [("B", dt.date(2024, 1, 1), 3.0)]
    texts = ["1.5", " 2 ", "12d", "3.F ", "-", "", None, "inf", "nan", "1e3", "x"]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(to_double("t")).collect()
    assert [r[0] for r in found] == [1.5, 2.0, None, None, None, None, None, float("inf"), None, 1000.0, None]


def test_two_digit_years(spark):
    texts = {"01-Apr-98": dt.date(1998, 4, 1), "29-FEB-00": dt.date(2000, 2, 29), "31-dec-68": dt.date(2068, 12, 31), "01-Jan-69": dt.date(1969, 1, 1), "1999-12-31": dt.date(1999, 12, 31), "04/01/1998": None}
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", legacy_date("t").alias("d")).collect()
    assert {r.t: r.d for r in found} == texts


def test_histories_are_not_all_written_by_one_task(spark, tmp_path):
    """Few bytes, many files; the number of a part file is that of its task."""
    prices = spark.range(400).select(
        F.lit("NSE").alias("exchange"), F.concat(F.lit("S"), "id").alias("symbol"), F.lit("2024-01-01").alias("date"), F.lit(1.0).alias("open")
    )
    sinks.export_histories(prices, None, str(tmp_path / "h"))
    files = list((tmp_path / "h" / "ohlcv").rglob("part-*.csv"))
    assert len(files) == 400 and len({f.name.split("-")[1] for f in files}) > 8
