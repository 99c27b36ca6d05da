"""A scored table kept up by micro-batches: copy-on-write by hash bucket, and a versioned model pointer.

Rows live in buckets of their id's hash. A batch rewrites only the buckets it touches, in a folder of its own, and then
commits a manifest that names every bucket's folder; a version counts once its commit marker exists, which the file system
creates in one step. A batch reads the last version before its own number, so a retry or a replay starts from the same
state and leaves the same table. The model in use is told by a pointer with versions of the same kind: each batch loads
it, or trains and commits a new one; then all buckets are scored again.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import refresh as RF
from ..operators.clean import dedup_by_id
from .jobs import _existing, _run

BUCKETS = 32


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Committed versions in ``folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _commit(rows: DataFrame, folder: str, version: int) -> None:
    """Writes a version; Spark's commit marker, created last, makes it count."""
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version}")


def _last(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame | None:
    known = [v for v in _versions(spark, folder) if before is None or v < before]
    return spark.read.parquet(f"{folder}/version={known[-1]}") if known else None


class ScoredTable:
    """Folders: ``data`` (buckets, a folder for each attempt), ``manifest`` (version -> bucket, path), ``pointer`` (version -> model path), ``models``, ``log``."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "complaint_id", buckets: int = BUCKETS):
        self.spark, self.folder, self.key, self.buckets = spark, folder, key, buckets

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def paths(self, before: int | None = None) -> dict[int, str]:
        got = _last(self.spark, f"{self.folder}/manifest", before)
        return {r["bucket"]: r["path"] for r in got.collect()} if got is not None else {}  # a row a bucket

    def read(self, schema, before: int | None = None, only: set[int] | None = None) -> DataFrame:
        paths = [p for b, p in sorted(self.paths(before).items()) if only is None or b in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def model(self, before: int | None = None) -> str | None:
        got = _last(self.spark, f"{self.folder}/pointer", before)
        return got.first()["path"] if got is not None else None

    def rewrite(self, rows: DataFrame, touched: set[int], version: int) -> None:
        """The touched buckets become ``rows``; the others keep their folders."""
        out = f"{self.folder}/data/{version}-{uuid.uuid4().hex}"
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.partitionBy("bucket").parquet(out)
        written = {r[0] for r in self.spark.read.parquet(out).select("bucket").distinct().collect()} if touched else set()
        named = {b: p for b, p in self.paths(version).items() if b not in touched} | {b: f"{out}/bucket={b}" for b in written}
        _commit(self.spark.createDataFrame(sorted(named.items()), "bucket int, path string"), f"{self.folder}/manifest", version)


def upsert_step(table: ScoredTable, batch: DataFrame, batch_id: int, enrich_new: Callable[[DataFrame], DataFrame], train: Callable[[DataFrame], PipelineModel],
                score: Callable[[DataFrame, PipelineModel], DataFrame], schema, retrain: Callable[[int], bool] = lambda batch_id: False) -> None:
    """One micro-batch of fresh rows (``schema`` names the scored table's columns, sentiment and scores among them).

    Ids are de-duplicated; known ids keep their cached sentiment, all else is taken from the fresh row; the model of the
    pointer, or a new one (asked for, or none exists), scores what is rewritten; a stamp row is logged."""
    spark, key = table.spark, table.key
    fresh = dedup_by_id(batch, key, order=[c for c in batch.columns if c != key]).withColumn("bucket", table.bucket()).checkpoint()
    touched = {r[0] for r in fresh.select("bucket").distinct().collect()}
    old = table.read(schema, batch_id, touched)
    cache = old.select(key, *RF.SENT_COLS).filter(F.col("sent_compound").isNotNull())
    joined = fresh.drop("bucket").join(cache.withColumnRenamed(key, "_known").withColumn("_hit", F.lit(True)), F.col(key).eqNullSafe(F.col("_known")), "left")
    new = enrich_new(joined.filter(F.col("_hit").isNull()).select(*batch.columns))
    known = joined.filter(F.col("_hit")).select(*batch.columns, *RF.SENT_COLS)
    rows = known.unionByName(new.select(*known.columns)).checkpoint()
    n_new = new.count()

    def merged(old: DataFrame) -> DataFrame:
        stay = old.join(rows.select(F.col(key).alias("_new")), F.col(key).eqNullSafe(F.col("_new")), "left_anti")
        return stay.select(*rows.columns).unionByName(rows)

    path = table.model(batch_id)
    retrained = path is None or bool(retrain(batch_id))
    if retrained:
        model = train(merged(table.read(schema, batch_id)))
        path = f"{table.folder}/models/{batch_id}-{uuid.uuid4().hex}"
        model.write().save(path)
        touched = set(range(table.buckets))  # a new model scores every row anew
        old = table.read(schema, batch_id)
    else:
        model = PipelineModel.load(path)
    table.rewrite(score(merged(old), model).select(*[f.name for f in schema]), touched, batch_id)
    if retrained:
        _commit(spark.createDataFrame([(path,)], "path string"), f"{table.folder}/pointer", batch_id)
    total = table.read(schema).count()
    RF.refresh_log(spark, total, n_new, retrained, batch_id).write.mode("overwrite").parquet(f"{table.folder}/log/batch={batch_id}")


def stream_upsert(table: ScoredTable, source_dir: str, source_schema: str, checkpoint: str, enrich_new, train, score, schema, retrain=lambda batch_id: False, files_per_trigger: int = 1) -> DataFrame:
    """Keeps ``table`` up from a file stream; returns its last version."""
    stream = table.spark.readStream.schema(source_schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)

    def step(batch: DataFrame, batch_id: int) -> None:
        upsert_step(table, batch, batch_id, enrich_new, train, score, schema, retrain)

    _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step).trigger(availableNow=True).start())
    return table.read(schema)


def progress(table: ScoredTable) -> DataFrame:
    """The stamp rows of all batches."""
    from .jobs import LOG_SCHEMA

    return _existing(table.spark, f"{table.folder}/log", LOG_SCHEMA + ", batch int").drop("batch")
