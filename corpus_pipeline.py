"""A training corpus from raw documents: five stages, each written before the next reads it.

quality rules -> fuzzy line dedup -> near duplicates -> benchmark decontamination -> BPE.
Each stage works on all documents that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import bpe, decontaminate, jaccard, line_dedup, quality
from barloom.llm.common import read_table, release, stored, temporary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failed lines go, and documents that the rules reject."""
    return quality.clean(docs)


def fuzzy_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of like lines stays; documents left without text go."""
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates stays."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", fuzzy_lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_round_trip),
]

# No stage but the first can be said in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        before = docs
        with temporary(spark) as keep:
            docs = keep(stored(stage(spark, before, sf_dir)))
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
