"""Token-id files: all ids of a shard in one array, document bounds in Elias-Fano code.

``write`` sorts documents by id, encodes them and writes one file per partition; a file
is a run of shards. Spark's own writer and committer make the files, so they can lie in
any store and a lost or repeated task leaves no half file. ``read`` takes them back.

A shard, little-endian: ``MAGIC``; 64-bit words ``width, n_docs, n_ids, n_null, part, shard``;
document bounds (n_docs + 1 values) and document ids (those not null), each as
``eliasfano`` writes them; the ids in ``width`` bytes each; ``TAIL``, which the text
writer adds as its line end. ``part`` and ``shard`` number the files and the shards
in a file in ascending order of document id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.session import scratch_dir

from .bpe import SLICE_BYTES, WORD_BPE, slices, vocabulary
from .common import stored
from .eliasfano import EliasFano, encode

MAGIC, TAIL = b"BLTOKEN1", "\nBLTEND\n"
SHARD_IDS = 4_000_000
END_ID = 1
_HEAD = len(MAGIC) + 6 * 8


def _shard(doc_ids: list, bounds: list[np.ndarray], ids: list[np.ndarray], part: int, number: int) -> bytes:
    flat = np.concatenate(ids)
    width = 2 if int(flat.max(initial=0)) < 1 << 16 else 4
    keys = pa.chunked_array(doc_ids)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(bounds))])
    head = np.array([width, len(keys), len(flat), keys.null_count, part, number], "<i8").tobytes()
    known = encode(keys.drop_null().to_numpy())
    return b"".join((MAGIC, head, encode(ends), known, flat.astype(f"<u{width}").tobytes()))


def write(
    documents: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_BPE,
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode whole texts, append ``end_id`` to each, write in ascending order of an integer id.

    A null text is empty; null ids come first; equal ids stand next to each other. A
    shard ends with the document that brings it to ``shard_ids`` ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(tokenizer, "library")
        part, number, held = TaskContext.get().partitionId(), 0, 0
        keys, sizes, ids = [], [], []
        for batch in batches:
            for rows in slices(batch, "_text", 2 * SLICE_BYTES):
                found, offsets = words.encode(rows.column("_text"))
                keys.append(rows.column("_id"))
                sizes.append(np.diff(offsets) + 1)
                ids.append(np.insert(found, offsets[1:], end_id))
                held += len(ids[-1])
                if held >= shard_ids:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([_shard(keys, sizes, ids, part, number)], pa.binary())})
                    keys, sizes, ids, held, number = [], [], [], 0, number + 1
        if keys:
            yield pa.RecordBatch.from_pydict({"value": pa.array([_shard(keys, sizes, ids, part, number)], pa.binary())})

    rows = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text"))
    ordered = rows.repartitionByRange("_id").sortWithinPartitions("_id")
    shards = ordered.mapInArrow(run, "value binary")
    shards.select(F.col("value").cast("string")).write.option("lineSep", TAIL).text(path)


class Shard:
    """One shard of a file, read in place: ``document(i)`` goes through select."""

    def __init__(self, data: memoryview):
        if bytes(data[: len(MAGIC)]) != MAGIC:
            raise ValueError("not a token file")
        width, self.n_docs, self.n_ids, nulls, self.part, self.number = (
            int(x) for x in np.frombuffer(data, "<i8", 6, len(MAGIC))
        )
        self.bounds = EliasFano(data[_HEAD:])
        keys_at = _HEAD + self.bounds.size
        keys = EliasFano(data[keys_at:])
        self.doc_ids = [None] * nulls + keys.values().tolist()
        at = keys_at + keys.size
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at)
        self.size = at + width * self.n_ids + len(TAIL)

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]


def shards(data: bytes) -> Iterator[Shard]:
    view, at = memoryview(data), 0
    while at < len(view):
        shard = Shard(view[at:])
        yield shard
        at += shard.size


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, part, shard, ``start`` in all files, n_tokens, ids_crc32 (and ids).

    Files are read once, each by one task. The starts are a prefix scan: within a
    file by the task, over files from one row per file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                before = 0
                for shard in shards(content.as_buffer()):
                    bounds = shard.bounds.values()
                    wide = memoryview(shard.ids.astype("<u4")).cast("B")
                    columns = {
                        "doc_id": pa.array(shard.doc_ids, pa.int64()),
                        "part": pa.array(np.full(shard.n_docs, shard.part)),
                        "shard": pa.array(np.full(shard.n_docs, shard.number)),
                        "start": pa.array(bounds[:-1] + before),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids_crc32": pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                    }
                    if with_ids:
                        offsets = pa.array(bounds - bounds[0], pa.int32())
                        columns["ids"] = pa.ListArray.from_arrays(offsets, pa.array(shard.ids.astype(np.int64)))
                    yield pa.RecordBatch.from_pydict(columns)
                    before += shard.n_ids

    schema = "doc_id bigint, part bigint, shard bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    files = spark.read.format("binaryFile").load(path).select("content")
    rows = stored(files.mapInArrow(run, schema + (", ids array<bigint>" if with_ids else "")))
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    earlier = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = totals.select("part", F.coalesce(earlier, F.lit(0)).alias("first"))
    return rows.join(firsts, "part").withColumn("start", F.col("start") + F.col("first")).drop("first")


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    write(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")
