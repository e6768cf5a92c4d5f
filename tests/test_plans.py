"""What the physical plans must and must not contain."""

import datetime as dt
import re

import pytest

from barloom import operators as ops
from barloom import schemas as S
from barloom.plans.derived import _spread
from barloom.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
DAY = dt.date(2024, 1, 2)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert word not in plan


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "prices")
    spark.createDataFrame([], S.PRICES).write.parquet(path)
    return spark.read.parquet(path)


def test_adjusted_prices_do_not_move_price_rows(spark, stored, tmp_path):
    actions = spark.createDataFrame([], S.ACTIONS)
    plan = plan_of(ops.adjusted_prices(stored, actions, broadcast_bytes=ops.adjust.BROADCAST_BYTES))
    wide = [row for row in plan.splitlines() if "FileScan" in row and "TURNOVER_LACS" in row]
    assert len(wide) == 1
    # The wide scan is the streamed side of the top join: no exchange lies between.
    top = plan[: plan.index(wide[0])]
    assert "BroadcastHashJoin" in top and "Exchange" not in top
    # The other scans of prices read the key and the close only.
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert "SYMBOL:string,DATE1:date" in schemas
    assert "SYMBOL:string,SERIES:string,DATE1:date,CLOSE_PRICE:double" in schemas


def test_large_action_tables_are_not_broadcast(spark, stored):
    actions = spark.createDataFrame([("A", DAY, "bonus", 0.0, 1.0, 1.0, 1.0, 1.0)], S.ACTIONS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ops.adjusted_prices(stored, actions, broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan
    # Once cut to one close per day, once whole; days and factors stay in one partitioning.
    assert plan.count("FileScan") == 2
    assert plan.count("Window ") + plan.count("Window(") >= 2


def test_keep_first_limits_before_the_exchange(stored):
    plan = plan_of(ops.keep_first(stored, S.PRICE_KEY))
    limit = re.search(r"WindowGroupLimit[^\n]*Partial", plan)
    assert limit and plan.index("Exchange") < limit.start()


def test_price_table_exchanges(stored):
    delivery = stored.select("SYMBOL", "SERIES", "DATE1", "DELIV_QTY", "DELIV_PER")
    plan = plan_of(ops.price_table(stored, stored.drop("DELIV_QTY", "DELIV_PER"), delivery))
    assert plan.count("Exchange hashpartitioning") == 2


def test_bulk_sides_are_aggregated_before_the_join(spark, stored):
    deals = spark.createDataFrame([("A", DAY, 1.0, 1.0)], "Symbol string, Date date, Quantity_Traded double, "
                                                         "Trade_Price__Wght_Avg_Price double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(ops.bulk_with_prices(deals, stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")


def test_summary_counts_distinct_on_a_small_table(stored):
    plan = plan_of(ops.dataset_summary(stored))
    scan = plan.index("FileScan")
    assert "Expand" in plan[:scan] and plan.index("Expand") < plan.rindex("HashAggregate")


def test_calendar_queries_read_days_only(stored):
    assert "ReadSchema: struct<DATE1:date>" in plan_of(ops.missing_dates(stored))


def test_tasks_of_a_parsed_view_grow_with_its_rows(spark, tmp_path, monkeypatch):
    """One file of many rows is no longer cut into as many tasks as there are cores only."""
    monkeypatch.setattr("barloom.plans.derived._TASK_ROWS", 10)
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert _spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == 100
    monkeypatch.setattr("barloom.plans.derived._TASK_ROWS", 10_000)
    assert _spread(spark.read.parquet(str(tmp_path / "one"))).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_queries_limit_generated_methods_on_any_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    QUERIES["normalize_full"](other, SF_DIR)
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
