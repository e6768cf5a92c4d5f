"""Documents and their token counts in flat token files that have no index.

A file is a run of fixed-width ids in which one id ends each document. Files are cut
into blocks; numpy finds the end ids of a block in one comparison, and the block
becomes one row: ids, end ids, the run before the first and after the last, the runs
between. A document that crosses blocks is put together by a prefix scan over these
rows: the ids before the block less the place of the last end id before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.session import scratch_dir

from .bpe import WORD_BPE, encoded

BLOCK_IDS = 1 << 20
WIDTH = 2
# In files of ``write_flat`` 0 ends a document and token ids stand one higher.
SEPARATOR = 0


def write_flat(documents: DataFrame, path: str, text: str = "text", tokenizer: str = WORD_BPE, width: int = WIDTH) -> None:
    """Whole texts as flat token files, one per input partition, documents in row order.

    Spark's text writer puts the separator where a text file has line ends; null and
    empty texts give documents without tokens. ``width`` must hold the vocabulary's size.
    """

    def values(words, rows, ids, offsets):
        if len(words.table) >= 1 << 8 * width:
            raise ValueError(f"{len(words.table)} ids do not fit {width} bytes")
        data = pa.py_buffer((ids + 1).astype(f"<u{width}").tobytes())
        at = pa.py_buffer((offsets * width).astype("<i4").tobytes())
        return {"value": pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, at, data])}

    texts = documents.select(F.col(f"`{text}`").alias("_text"))
    rows = encoded(texts, values, "value binary", "_text", tokenizer, "library")
    rows.select(F.col("value").cast("string")).write.option("lineSep", "\0" * width).text(path)


def blocks(spark: SparkSession, path: str, separator: int, width: int, block_ids: int) -> DataFrame:
    """One row per block: file, block, n_ids, n_ends, head, tail, and ``inner``, the lengths between."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                ids = np.frombuffer(content.as_buffer(), f"<u{width}")
                for block, first in enumerate(range(0, len(ids), block_ids)):
                    part = ids[first : first + block_ids]
                    ends = np.flatnonzero(part == separator)
                    row = {
                        "file": name.as_py(),
                        "block": block,
                        "n_ids": len(part),
                        "n_ends": len(ends),
                        "head": int(ends[0]) if len(ends) else len(part),
                        "tail": len(part) - 1 - int(ends[-1]) if len(ends) else len(part),
                    }
                    row = {k: pa.array([v]) for k, v in row.items()}
                    inner = pa.array(np.diff(ends) - 1)
                    row["inner"] = pa.ListArray.from_arrays(pa.array([0, len(inner)], pa.int32()), inner)
                    yield pa.RecordBatch.from_pydict(row)

    schema = "file string, block bigint, n_ids bigint, n_ends bigint, head bigint, tail bigint, inner array<bigint>"
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, schema)


def count_tokens(
    spark: SparkSession, path: str, separator: int = SEPARATOR, width: int = WIDTH, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """One row per document: file, ``doc`` (from 0 in the file), ``start`` (in ids), n_tokens, ``ended``.

    End ids are not counted. Ids after the last end id of a file are a document that
    has not ended. An empty file or folder gives no rows. Files hold up to 2 GB, one
    task each; a window holds the blocks of one file.
    """
    found = blocks(spark, path, separator, width, block_ids)
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    first = F.coalesce(F.sum("n_ids").over(before), zero)
    found = found.withColumn("first", first).withColumn("docs", F.coalesce(F.sum("n_ends").over(before), zero))
    # Where the open document began: just after the last end id so far.
    after_end = F.when(F.col("n_ends") > 0, F.col("first") + F.col("n_ids") - F.col("tail"))
    found = found.withColumn("open", F.coalesce(F.max(after_end).over(before), zero))
    found = found.withColumn("last", F.lead("block").over(order).isNull())
    opened = F.col("first") - F.col("open")
    closed = F.when(F.col("n_ends") > 0, F.concat(F.array(opened + F.col("head")), "inner")).otherwise(F.array().cast("array<bigint>"))
    # What the file ends with, if it is not an end id.
    rest = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(opened + F.col("n_ids"))
    closed = F.transform(closed, lambda n: F.struct(n.alias("n"), F.lit(True).alias("ended")))
    left = F.when(F.col("last") & (rest > 0), F.array(F.struct(rest.alias("n"), F.lit(False).alias("ended"))))
    runs = F.concat(closed, F.coalesce(left, F.array().cast("array<struct<n:bigint,ended:boolean>>")))
    rows = found.select("file", "docs", "open", F.posexplode(runs))
    # Within a block the starts are again a prefix sum of the lengths.
    within = Window.partitionBy("file", "docs", "open").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.col("col.n") + 1).over(within), zero)
    return rows.select(
        "file",
        (F.col("docs") + F.col("pos")).alias("doc"),
        (F.col("open") + earlier).alias("start"),
        F.col("col.n").alias("n_tokens"),
        F.col("col.ended").alias("ended"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    write_flat(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    part = F.regexp_extract("file", r"part-(\d+)", 1).cast("bigint").alias("file_no")
    return count_tokens(spark, path).select(part, "doc", "start", "n_tokens", "ended")
