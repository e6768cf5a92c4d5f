"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry
from barloom.plans.oracle import ORACLE
from barloom.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_each_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= entry.queries().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF_DIR) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-3:] == ["CLOSE_PRICE", "ADJ_CLOSE_PRICE", "TTL_TRD_QNTY"]
    assert df.count() > 0
