"""Spark session settings shared by jobs, tests and the benchmark.

On a cluster the session already exists (spark-submit / notebook); ``configure``
only sets the SQL options the engine relies on. ``local_session`` is for tests
and the benchmark on one machine.
"""
from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Options every job needs, whatever the cluster size.
SQL_OPTIONS = {
    # Naive timestamps in the data are UTC; calendar keys must not shift.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch sort-merge to broadcast when a side turns small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A job of many steps would keep the shuffle files of all of them on the
    # executors' disks until the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in SQL_OPTIONS.items():
        spark.conf.set(k, v)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "plaint") -> SparkSession:
    """Single-JVM session for tests and the local benchmark (UI off)."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1) * 2)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("PLAINT_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SQL_OPTIONS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a folder of our own is
    only set when it is unset (local tests), never on a configured cluster.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="plaint-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def landed(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written as a new table in the shared checkpoint folder and read back: worked out once, whatever reads it."""
    return _written(df, scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}"), compression)


def _written(df: DataFrame, path: str, compression: str | None) -> DataFrame:
    writer = df.write.option("compression", compression) if compression else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame, name: str, compression: str | None = "zstd") -> Iterator[DataFrame]:
    """As ``landed``, for the time of a block: its end deletes the table, so nothing that outlives it may read it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}")
    try:
        yield _written(df, path, compression)
    finally:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
