"""What several operators share: words, row keys, stored intermediate tables."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.once import with_once
from barloom.session import delete_folder, scratch_dir, written_once

# Everything in ASCII that is neither a digit nor a letter separates words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_GAP = r"[\x20\x09-\x0D]+"

# A side of a join is broadcast when its rows, counted, are no more than this.
BROADCAST_ROWS = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; Spark's ``lower`` is the same and faster where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def words_of(text: Column, gap: str = WORD_GAP) -> Column:
    """Words in order; no words for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``key_id``, ``key_hash`` and ``body`` of each row, and no other column.

    Rows with equal id and text (nulls too) share a key and hence a result, so
    repeated rows and repeated ids are safe and null ids join.
    """
    text = F.col(f"`{text_col}`")
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("key_id"),
        F.xxhash64(text).alias("key_hash"),
        text.alias("body"),
    )


KEY = ["key_id", "key_hash"]


def packed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key_id``, ``key_hash``, ``body``, and all columns of the row by number: ``_c0``, ``_c1`` and so on.

    Whatever the columns are called, none clashes with a working column.
    """
    text = F.col(f"`{text_col}`")
    return df.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("key_id"),
        F.xxhash64(text).alias("key_hash"),
        text.alias("body"),
        *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(df.columns)],
    )


def original(columns: list[str], name: str) -> Column:
    """A column of the frame that was packed; ``columns`` are its names."""
    return F.col(f"_c{columns.index(name)}")


def unpacked(columns: list[str], **changed: Column) -> list[Column]:
    """The columns of the frame again, some of them replaced."""
    return [changed.get(c, original(columns, c)).alias(c) for c in columns]


def stored(df: DataFrame) -> DataFrame:
    """``df`` written below the cluster's checkpoint folder and read back.

    Cuts the lineage: a lost executor costs a read of these files, not a new run.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    with written_once(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    if (made := _MADE.get()) is not None:
        made.add(path)
    return out


# Folders of stored frames, and those made inside ``temporary``.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_MADE: ContextVar[set[str] | None] = ContextVar("made", default=None)


def release(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` frames which nothing reads any more."""
    for frame in frames:
        if path := _FOLDERS.pop(frame, None):
            delete_folder(frame.sparkSession, path)
            (_MADE.get() or set()).discard(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Files of all that is stored inside are deleted at the end, but those of frames given to what this yields.

    What leaves the block must not read any of the others.
    """
    outer, made, kept = _MADE.get(), set(), set()

    def keep(frame: DataFrame) -> DataFrame:
        kept.add(_FOLDERS[frame])
        return frame

    token = _MADE.set(made)
    try:
        yield keep
    finally:
        _MADE.reset(token)
        for path in made - kept:
            delete_folder(spark, path)
        if outer is not None:
            outer.update(made & kept)


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint only when the counted ``rows`` stay below the limit."""
    return F.broadcast(df) if rows <= limit else df


def sliding(df: DataFrame, name: str, width: int, merge: Callable[[Column, Column], Column]) -> DataFrame:
    """Replace an array column by the merge of each ``width`` neighbours, by doubling.

    Each step merges the array with itself or the original, moved; four passes do
    for any width up to eight. The last ``width - 1`` places are left to be cut off.
    """

    def moved(column: str, by: int) -> Column:
        return F.slice(column, by + 1, F.greatest(F.size(column) - by, F.lit(0)))

    rest = [c for c in df.columns if c != name]
    df, have = df.withColumn("_base", F.col(name)), 1
    for bit in bin(width)[3:]:
        df = with_once(df, _next=F.zip_with(name, moved(name, have), merge)).select(*rest, "_base", F.col("_next").alias(name))
        have *= 2
        if bit == "1":
            df = with_once(df, _next=F.zip_with(name, moved("_base", have), merge))
            df = df.select(*rest, "_base", F.col("_next").alias(name))
            have += 1
    return df.drop("_base")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


__all__ = [
    "BROADCAST_ROWS",
    "KEY",
    "SPACE_GAP",
    "WORD_GAP",
    "broadcast_if_small",
    "keyed",
    "original",
    "packed",
    "lower_ascii",
    "read_table",
    "release",
    "sha256_hex",
    "sliding",
    "stored",
    "temporary",
    "unpacked",
    "with_once",
    "words_of",
]
