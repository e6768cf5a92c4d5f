"""What queries leave on disk while they run: shuffle files of finished steps and files that nothing reads any more."""

import time
import uuid

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import common, jaccard, line_dedup
from barloom.session import CLEANUP

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_dir", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    return tmp_path


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for i in range(files.size()) if (f := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffle_files_go_when_a_step_is_stored(spark):
    before = shuffle_files(spark)
    frame = common.stored(spark.range(1000).repartition(4, "id").groupBy("id").count())
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert frame.count() == 1000
    assert spark.conf.get(CLEANUP, None) is None


def test_released_files_are_deleted(spark, scratch):
    first = common.stored(spark.range(3).toDF("n"))
    second = common.stored(first.select(F.col("n") + 1))
    common.release(first, second.select("*"))
    assert len(list(scratch.iterdir())) == 1
    assert second.count() == 3


def test_temporary_files_are_deleted(spark, scratch):
    with common.temporary(spark) as outer:
        with common.temporary(spark) as inner:
            one = inner(common.stored(spark.range(3).toDF("n")))
            common.stored(one)
        assert len(list(scratch.iterdir())) == 1
        two = outer(common.stored(one))
    assert len(list(scratch.iterdir())) == 1
    assert two.count() == 3
    with pytest.raises(ZeroDivisionError), common.temporary(spark):
        common.stored(two)
        1 / 0
    assert len(list(scratch.iterdir())) == 1


@pytest.mark.parametrize(("stage", "left"), [(line_dedup.dedup_lines, 1), (jaccard.keep_one, 3)])
def test_stages_leave_what_their_result_reads(documents, scratch, stage, left):
    found = stage(documents)
    assert len(list(scratch.iterdir())) == left
    assert found.count() > 0


def test_pipeline_leaves_the_last_stage_only(spark, scratch):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert len(list(scratch.iterdir())) == 1


def test_blocks_in_slices_are_all_met(spark, monkeypatch):
    """The number of slices changes no group."""
    words = [chr(97 + i % 26) * (i % 5 + 2) for i in range(40)]
    rows = [(i, " ".join(words[i % 4 :] + [f"end{i // 4}"])) for i in range(24)] + [(50 + i, f"short line {i % 3}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {}
    for n in (1, 4):
        monkeypatch.setattr(line_dedup, "SLICES", n)
        found[n] = sorted(tuple(r) for r in line_dedup.summarise(docs).collect())
    assert found[1] == found[4]
    assert sum(r[2] for r in found[1]) > 20
