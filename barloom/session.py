"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings of speed alone, which any session takes while it runs.
SPEED = {
    # Wide projections of parsed text make methods that the JVM would not compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Folders are listed by this many tasks at most, not by one for each of up to 10,000 folders.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
}

# Whether the shuffle files of a plan go when it ends, or else when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# AQE splits hot join partitions and coalesces small ones; UTC keeps dates stable.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    **SPEED,
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "barloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots.

    ``master`` stays unset on a cluster, where spark-submit provides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def set_speed(spark: SparkSession) -> None:
    """``SPEED`` on a session that ``build_session`` did not make; results stay the same."""
    for key, value in SPEED.items():
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster, or a temporary one in local tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="barloom-checkpoint-")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder name below the checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/barloom-{uuid.uuid4().hex}"


@contextmanager
def written_once(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when the write ends.

    Only for plans that run once: a frame that is run again would have to make them anew.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
