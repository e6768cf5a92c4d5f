"""The registered queries and the pipeline, on the smallest tables."""

import pytest
from oracle_compare import compare, connect

import __spark_entry__ as entry
import corpus_pipeline
from barloom.llm import decontaminate, jaccard, quality
from barloom.llm.queries import ORACLE, QUERIES

from .conftest import TEXTS
from .test_operators import brute_components

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES.items() <= entry.queries().items()
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    assert compare(spark, connect(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) == []


def test_jaccard_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in QUERIES["op4_jaccard"](spark, SF_DIR).select("doc_id", "n_shingles", "component_id").collect())
    assert found == sorted(brute_components(rows))


def test_stages(spark, documents, benchmark):
    """Each stage takes what the one before kept, and its own decisions hold for that."""
    kept = quality.clean(documents)
    assert {r.doc_id for r in kept.collect()} <= {i for i, _ in TEXTS}
    once = jaccard.keep_one(kept)
    clean = decontaminate.decontaminate(once, benchmark)
    assert once.columns == clean.columns == documents.columns
    assert decontaminate.mark_contaminated(clean, benchmark).where("contaminated").count() == 0
    found = jaccard.near_duplicates(clean)
    assert found.where("n_shingles > 0").groupBy("component_id").count().where("count > 1").count() == 0


def test_pipeline(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    n = found.count()
    assert 0 < n < documents.count()
    assert found.select("doc_id").distinct().count() == n
    assert found.join(documents, "doc_id", "left_anti").count() == 0
