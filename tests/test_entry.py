"""The entry points with and without what the optional subpackage needs."""

import sys

import __spark_entry__ as entry
from barloom.plans.oracle import ORACLE
from barloom.plans.registry import QUERIES


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()


def test_other_queries_stay_without_a_module(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("barloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr("barloom.llm", raising=False)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)
