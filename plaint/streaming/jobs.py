"""Structured Streaming re-aims of the reference's incremental behaviours.

* ``stream_mis_monthly`` – file stream of bulk rows -> per (month, segment)
  running aggregate (complete mode), each batch's full result written to a
  table through ``foreachBatch`` (small: months x segments).
* ``stream_refresh``     – file stream of case rows -> per batch: de-dup, anti-join
  against the cache table, score only unseen ids, write them and one progress
  row into the batch's own partitions (idempotent on retry).
* ``stream_dedup``       – de-dup of ids against everything written before.

Checkpoints live in the shared checkpoint folder, so a restarted query resumes
from its last committed batch."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mis
from ..operators import refresh as RF
from ..operators.clean import dedup_by_id
from ..operators.refresh import refresh_log


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def stream_mis_monthly(spark: SparkSession, source_dir: str, schema: str, target: str,
                       out_path: str, checkpoint: str, files_per_trigger: int = 1) -> DataFrame:
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    flags = mis.mis_flags(stream, target).filter(F.col("year_month").isNotNull())
    seg = F.explode(F.array(F.lit(mis.SEGMENT_ALL),
                            F.when(F.col("is_target"), F.lit(mis.SEGMENT_TARGET))))
    long = flags.select("year_month", seg.alias("segment"), "timely_yes", "relief", "has_narr") \
                .filter(F.col("segment").isNotNull())
    agg = long.groupBy("year_month", "segment").agg(
        F.count(F.lit(1)).alias("complaints"), F.count_if("timely_yes").alias("timely"),
        F.count_if("relief").alias("relief"), F.count_if("has_narr").alias("narrative"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(write).trigger(availableNow=True).start())
    _run(q)
    return mis._rates(spark.read.parquet(out_path)).filter(F.col("year_month").rlike(r"^\d{4}-\d{2}"))


def _existing(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, empty if it isn't there yet; any other read error is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


SENT_KINDS = {"sent_neg": "double", "sent_neu": "double", "sent_pos": "double", "sent_compound": "double",
              "sentiment_label": "string", "sentiment_band": "string", "is_negative": "int"}
LOG_SCHEMA = "updated_at timestamp, rows long, new_rows long, retrained boolean, batch_id long"


def refresh_step(spark: SparkSession, batch: DataFrame, batch_id: int, cache_path: str, log_path: str,
                 score_new, key: str = "complaint_id", retrain=None) -> None:
    """One micro-batch: de-duplicate ids, score those that no earlier batch cached, write them and a stamp row.

    Both tables are partitioned by batch and a batch overwrites only its own partition, so a retry after a
    crash at any point (also between the two writes) leaves every id and stamp once. ``retrain`` (a function
    of the batch id, or None) runs after the cache write and switches the stamp's retrained flag."""
    kinds = {f.name: f.dataType.simpleString() for f in batch.schema}
    schema = f"{key} {kinds[key]}, " + ", ".join(f"{c} {SENT_KINDS[c]}" for c in RF.SENT_COLS) + ", batch int"
    cache = _existing(spark, cache_path, schema).filter(F.col("batch") < batch_id)
    logged = _existing(spark, log_path, LOG_SCHEMA + ", batch int").filter(F.col("batch") < batch_id)
    rest = [c for c in batch.columns if c != key]
    ids = dedup_by_id(batch, key, order=rest)
    new = ids.join(cache.select(F.col(key).alias("_known")), F.col(key).eqNullSafe(F.col("_known")), "left_anti")
    out = f"{cache_path}/batch={batch_id}"
    score_new(new).select(key, *RF.SENT_COLS).write.mode("overwrite").parquet(out)
    n_new = spark.read.parquet(out).count()
    before = logged.agg(F.sum("new_rows")).first()[0] or 0  # a row for each batch
    retrained = bool(retrain and retrain(batch_id))
    refresh_log(spark, before + n_new, n_new, retrained, batch_id).write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")


def stream_refresh(spark: SparkSession, source_dir: str, schema: str, cache_path: str,
                   log_path: str, checkpoint: str, score_new, key: str = "complaint_id",
                   files_per_trigger: int = 1, retrain=None) -> DataFrame:
    """Score only ids not yet in the cache table; each batch writes its own partition of cache and log."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        refresh_step(spark, batch, batch_id, cache_path, log_path, score_new, key, retrain)

    q = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert)
         .trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(cache_path)


def stream_dedup(spark: SparkSession, source_dir: str, schema: str, key: str, event_time: str,
                 out_path: str, checkpoint: str, files_per_trigger: int = 1) -> DataFrame:
    """The first batch's row of every id, whatever its event time: an id is new if no earlier batch wrote it.

    Of one batch's rows the earliest survives (ties: the least of the other columns). State is the output
    table itself, so no watermark drops late rows or lets far-apart repeats through."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    kinds = f"{schema}, batch int"

    def keep(batch: DataFrame, batch_id: int) -> None:
        seen = _existing(spark, out_path, kinds).filter(F.col("batch") < batch_id).select(F.col(key).alias("_known"))
        rest = [c for c in batch.columns if c not in (key, event_time)]
        first = batch.groupBy(key).agg(F.min(F.struct(event_time, *rest)).alias("_r")).select(key, "_r.*")
        new = first.join(seen, F.col(key).eqNullSafe(F.col("_known")), "left_anti").select(*batch.columns)
        new.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    q = (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)
         .trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out_path).drop("batch")
