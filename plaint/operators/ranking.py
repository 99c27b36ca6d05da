"""Exact global ranks and running sums without a single-partition window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
Here one range shuffle sorts the rows (Spark samples the key to pick bounds);
each partition numbers or sums its own rows in place, without another shuffle,
and the totals of all earlier partitions are added (a table with one row per
partition, so the prefix sum over it is tiny)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType

# monotonically_increasing_id() is the partition shifted by this, plus the row's place in it
_PLACE_BITS = 33


def _ranged(df: DataFrame, order: list[Column], partitions: int | None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def global_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                      partitions: int | None = None, total_name: str | None = None) -> DataFrame:
    """1-based row number of every row in the total order ``order``; with
    ``total_name`` the total row count is attached as well."""
    # Range bounds come from sampling; materialize once (reliable checkpoint in
    # the shared checkpoint folder) so the counts below see the same partitions.
    local = _ranged(df, order, partitions).withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    local = local.withColumn("_pid", F.shiftright("_at", _PLACE_BITS))
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy()).alias("_total"))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = local.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, F.col("_off") + F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1) + 1)
    if total_name:
        out = out.withColumnRenamed("_total", total_name)
    return out.drop("_pid", "_at", "_off", "_total")


def ntile_from_rank(rank: Column, total: Column, tiles: int) -> Column:
    """ntile(tiles) from a 1-based rank and the row count (first n % tiles
    buckets hold one extra row, like SQL NTILE)."""
    q = F.floor(total / tiles)
    r = total % tiles
    big = r * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(F.floor((rank - 1 - big) / F.greatest(q, F.lit(1))) + r + 1).cast("int")


def global_cumsum(df: DataFrame, order: list[Column], sums: dict[str, str],
                  partitions: int | None = None) -> DataFrame:
    """Running sums (inclusive) along the total order ``order``, all in one pass: ``sums`` maps a new column to the
    long or double column that it sums; nulls add nothing."""
    real = {name: isinstance(df.schema[value].dataType, (DoubleType, FloatType)) for name, value in sums.items()}
    schema = StructType(df.schema.fields + [StructField(name, DoubleType() if real[name] else LongType()) for name in sums])
    at = {value: df.columns.index(value) for value in sums.values()}
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = {name: np.float64(0) if real[name] else np.int64(0) for name in sums}
        for batch in batches:
            new = []
            for name, value in sums.items():
                kind = pa.float64() if real[name] else pa.int64()
                total = np.cumsum(batch.column(at[value]).cast(kind).fill_null(0).to_numpy(zero_copy_only=False)) + before[name]
                before[name] = total[-1] if len(total) else before[name]
                new.append(pa.array(total, kind))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    local = _ranged(df, order, partitions).mapInArrow(run, schema).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    totals = local.groupBy("_pid").agg(*[F.sum(value).alias(f"_t_{name}") for name, value in sums.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{name}").over(w), F.lit(0)).alias(f"_o_{name}") for name in sums])
    out = local.join(F.broadcast(offsets), "_pid")  # one row per partition
    return out.withColumns({name: F.col(name) + F.col(f"_o_{name}") for name in sums}).drop("_pid", *[f"_o_{name}" for name in sums])
