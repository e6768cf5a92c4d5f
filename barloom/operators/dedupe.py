"""Duplicate handling: keep-first by key, keep only new keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import scratch_dir, written_once

_RANK = "__rank"

# Fingerprints that are broadcast at most.
REPEATED = 500_000


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties broken by the remaining columns.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    exchange as well, so each map task sends at most one row of a key and a hot
    key never reaches one task whole.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = [F.col(c) if isinstance(c, str) else c for c in order]
    ordering += [F.col(f"`{c}`").asc_nulls_last() for c in rest]
    if not ordering:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def new_keys(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column | str] = ()
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, one per key.

    The target is first cut to the batch's keys. A batch that Spark can broadcast
    then filters the target where it is scanned, and only the few keys found are
    moved; a larger one falls back to an exchange by key. Rows without a whole key
    are dropped.
    """
    keys = list(keys)
    batch = batch.dropna(subset=keys)
    present = target.select(*keys).join(batch.select(*keys), keys, "left_semi").distinct()
    return keep_first(batch.join(present, keys, "left_anti"), keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    """``df.distinct()``, without moving rows that no other can be equal to.

    Runs the plan of ``df`` to count fingerprints first; those that occur more than once are written below the
    checkpoint folder. Rows with one of these are compared as they are, so the result is exact. Where
    they are too many to be broadcast, all rows are compared.
    """
    spark = df.sparkSession
    fingerprint = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__print")
    path = scratch_dir(spark)
    with written_once(spark):
        df.select(fingerprint).groupBy("__print").count().where("count > 1").select("__print").write.parquet(path)
    repeated = spark.read.schema("__print bigint").parquet(path)
    n = repeated.count()
    if not n:
        return df
    if n > REPEATED:
        return df.distinct()
    marked, repeated = df.select("*", fingerprint), F.broadcast(repeated)
    compared = marked.join(repeated, "__print", "left_semi").select(*[f"`{c}`" for c in df.columns]).distinct()
    return marked.join(repeated, "__print", "left_anti").select(*[f"`{c}`" for c in df.columns]).union(compared)
