"""Stored tables that grow by key."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from barloom import schemas as S
from barloom.operators.dedupe import keep_first, new_keys
from barloom.session import delete_folder, scratch_dir, written_once
from barloom.sources.tables import YEAR, read_prices

# Files of a year partition are cut by symbol and day, so both prune row groups.
_WITHIN = ["SYMBOL", "DATE1"]

# A large batch is appended by years, so many at once as make up these rows.
_CHUNK_ROWS = 2_000_000
# Smaller than the default, for a little more time.
_CODEC = {"compression": "zstd"}


def _by_year(df: DataFrame) -> DataFrame:
    """Rows spread so that each year goes to few files and no file grows without bound.

    The rebalance hint lets AQE split a large year over several tasks and merge
    small ones.
    """
    return (
        df.withColumn(YEAR, F.year("DATE1"))
        .hint("rebalance", YEAR)
        .sortWithinPartitions(YEAR, *_WITHIN)
    )


def write_prices(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a price table partitioned by year. Overwriting makes a repeated run harmless."""
    with written_once(df.sparkSession):
        _by_year(df).write.mode(mode).options(**_CODEC).partitionBy(YEAR).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table with at least a schema is stored at ``path``; other failures are raised."""
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def append_prices(spark: SparkSession, path: str, batch: DataFrame, keys: list[str] | None = None) -> None:
    """Append the rows of ``batch`` whose key the stored price table lacks.

    The batch's plan runs once: it is written below the checkpoint folder, and its span of days is
    observed while that happens. Then the new keys are taken from those files, which are deleted at the end. Only the
    years and days of the batch are read from the table. A large batch whose keys hold the day is
    appended some years at a time, so that only these are shuffled at once. Running it again with the same batch
    adds nothing, also after one that ended between two years.
    """
    keys = keys or S.PRICE_KEY
    seen, staged = Observation(), scratch_dir(spark)
    batch = batch.dropna(subset=keys)
    schema = batch.schema
    batch = batch.observe(seen, F.min("DATE1").alias("lo"), F.max("DATE1").alias("hi"))
    by_day = "DATE1" in keys
    writer = (batch.withColumn(YEAR, F.year("DATE1")) if by_day else batch).write.options(**_CODEC)
    try:
        with written_once(spark):
            (writer.partitionBy(YEAR) if by_day else writer).parquet(staged)
        span = seen.get
        if span["lo"] is None:
            return
        # Appending also makes the table, and spares rows of a writer that came in between.
        fresh = not exists(spark, path)
        for files, lo, hi in _years_together(spark, staged, span["lo"], span["hi"]) if by_day else [([staged], span["lo"], span["hi"])]:
            rows = spark.read.schema(schema).parquet(*files)
            if fresh:
                rows = keep_first(rows, keys)
            else:
                rows = new_keys(read_prices(spark, path, start=str(lo), end=str(hi)), rows, keys)
            write_prices(rows, path, mode="append")
            for folder in files:
                delete_folder(spark, folder)
    finally:
        delete_folder(spark, staged)


def _years_together(spark: SparkSession, staged: str, lo: dt.date, hi: dt.date) -> list[tuple[list[str], dt.date, dt.date]]:
    """(folders, first day, last day) of years of a staged batch that are appended together; one row a year comes to the driver."""
    counts = spark.read.parquet(staged).groupBy(YEAR).count().orderBy(YEAR).collect()
    chunks, held = [], 0
    for year, n in counts:
        if not chunks or held + n > _CHUNK_ROWS:
            chunks.append([])
            held = 0
        chunks[-1].append(year)
        held += n
    return [
        ([f"{staged}/{YEAR}={y}" for y in years], max(lo, dt.date(years[0], 1, 1)), min(hi, dt.date(years[-1], 12, 31)))
        for years in chunks
    ]


def append_ignore(spark: SparkSession, path: str, batch: DataFrame, keys: list[str]) -> None:
    """Append to a plain keyed table, keeping the rows it has."""
    if not exists(spark, path):
        keep_first(batch.dropna(subset=keys), keys).write.mode("errorifexists").parquet(path)
        return
    new_keys(spark.read.parquet(path), batch, keys).write.mode("append").parquet(path)


def create_if_absent(spark: SparkSession, path: str, schema) -> None:
    """An empty table with the given schema, unless one is stored already."""
    if not exists(spark, path):
        writer = spark.createDataFrame([], schema).write.mode("ignore")
        writer.parquet(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalog table, such as the cleaned bulk deals."""
    df.write.mode("overwrite").saveAsTable(name)


def write_keyed_table(df: DataFrame, name: str, keys: list[str], order: list[str], buckets: int, path: str | None = None) -> None:
    """A new catalog table in buckets of ``keys``, each sorted by the keys and ``order``.

    Windows, groups and joins by these keys, also of two such tables with as many buckets, then
    need no exchange. Rows are brought together by key first, so a bucket is one file. It holds what
    its keys have: choose ``buckets`` so that one fits a task.
    """
    together = df.repartition(buckets, *keys)
    writer = together.write.bucketBy(buckets, *keys).sortBy(*keys, *order).format("parquet").mode("errorifexists")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def replace_keyed_table(
    df: DataFrame, name: str, keys: list[str], order: list[str], buckets: int, path: str | None = None
) -> None:
    """Make ``name`` show these rows, in buckets, without a moment in which it shows half of them.

    Each version is a table of its own, and ``name`` is a view that is moved when the new one is whole.
    Jobs that have begun go on with the version they know; the one before the current stays for
    them, older ones are dropped.
    """
    spark = df.sparkSession
    version = f"{name}__{uuid.uuid4().hex}"
    write_keyed_table(df, version, keys, order, buckets, f"{path.rstrip('/')}/{version}" if path else None)
    before = spark.sql(f"describe extended {name}").where("col_name = 'View Text'").first() if spark.catalog.tableExists(name) else None
    spark.sql(f"create or replace view {name} as select * from {version}")
    shown = {version, before["data_type"].split()[-1].strip("`").split(".")[-1] if before else version}
    for table in spark.catalog.listTables(pattern=f"{name}__*"):
        if table.name not in {s.lower() for s in shown} | shown:
            spark.sql(f"drop table {table.name}")
