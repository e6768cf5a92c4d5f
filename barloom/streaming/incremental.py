from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom import schemas as S
from barloom.operators.normalize import normalize_full
from barloom.operators.quality import rejects
from barloom.sinks.exports import append_log, read_log
from barloom.sinks.tables import append_prices
from barloom.sources.files import SOURCE_FILE, file_name
from barloom.sources.prices import FULL_GLOB


REJECTS = "SOURCE_FILE string, reason string, rows bigint"


def _reject_log(target: str) -> str:
    return f"{target.rstrip('/')}.rejects"


def read_stream_rejects(spark: SparkSession, target: str, reject_log: str | None = None) -> DataFrame:
    """SOURCE_FILE, reason, rows, run_id of all that the streams into ``target`` left out."""
    return read_log(spark, reject_log or _reject_log(target), REJECTS)


def stream_full_prices(
    spark: SparkSession,
    source: str,
    target: str,
    header: Sequence[str] | None = None,
    checkpoint: str | None = None,
    max_files: int | None = None,
    reject_log: str | None = None,
    glob: str = FULL_GLOB,
) -> StreamingQuery:
    """Load every file that is new in ``source`` into the price table, then stop.

    Each micro-batch runs the batch append by key, so a replay after a failure
    adds nothing twice. The files must share the layout ``header`` (by default
    the canonical column order). Progress is kept beside the target, apart for each
    source, unless ``checkpoint`` names another folder. What the table does not take is counted
    by file and reason in ``reject_log`` (by default beside the target too), one folder per
    source and micro-batch, so a replay replaces its counts; ``read_stream_rejects`` reads them.
    """
    schema = ", ".join(f"`{name}` string" for name in (header or S.PRICES.fieldNames()))
    reader = spark.readStream.schema(schema).options(
        header=True,
        enforceSchema=False,
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        pathGlobFilter=glob,
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    progress = hashlib.sha256(source.rstrip("/").encode()).hexdigest()[:16]

    log = reject_log or _reject_log(target)

    def load(batch: DataFrame, batch_id: int) -> None:
        append_log(rejects(batch), log, f"{progress}-{batch_id}")
        rows = normalize_full(batch, distinct=False).where(F.col("DATE1").isNotNull())
        append_prices(batch.sparkSession, target, rows)

    return (
        reader.csv(source)
        .select("*", file_name().alias(SOURCE_FILE))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint or f"{target.rstrip('/')}.streams/{progress}")
        .trigger(availableNow=True)
        .start()
    )
