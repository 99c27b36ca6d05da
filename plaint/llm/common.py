"""Helpers shared by the training-data operators: tables in the shared folder, bounded Arrow slices, text rows."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.session import ensure_checkpoint_dir

#: Words are runs of anything but these six ASCII white-space characters.
WHITE = " \t\n\x0b\f\r"
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder that the cluster names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends there, and lost executors cost no rerun."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the rows of a batch between Spark and Python (documents are kilobytes each)."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


_held: dict[str, Callable[[], None]] = {}


def holds(name: str) -> Callable:
    """Marks a function that empties what workers remember for the operators that claim ``name``."""
    def mark(forget: Callable[[], None]) -> Callable[[], None]:
        _held[name] = forget
        return forget
    return mark


def claim(name: str) -> None:
    """A task begins to use the memory ``name``: those that other operators left in this worker are emptied.

    Spark's Python workers live on, so without this the memories of a job's operators would add up."""
    for other, forget in _held.items():
        if other != name:
            forget()
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: workers live on for other tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds at most ``limit`` bytes in a slice (one longer value stands alone).

    A column of integers gives the sizes themselves."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(np.nan_to_num((values if pa.types.is_integer(values.type) else pc.binary_length(values)).to_numpy(zero_copy_only=False).astype("f8")))
        lo = 0
        while lo < n:
            base = sizes[lo - 1] if lo else 0.0
            hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
    give_back()


def text_beside(batches: Iterator[pa.RecordBatch], at: int | None) -> Iterator[pa.RecordBatch]:
    """(row, text): the text is taken out of the struct ``row`` (its field ``at``), so that it is sent once; with None it is there."""
    for batch in batches:
        if at is None:
            yield batch
        else:
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.struct_field(batch.column(0), [at]).cast(pa.string())], names=["row", "text"])


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's values, null as the empty text."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def letters_only(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\p{L}")


def word_ranges(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes as an array, starts, ends) of the words in ``data``."""
    a = np.frombuffer(data, np.uint8)
    word = np.ones(a.size + 2, np.bool_)
    word[1:-1] = ~((a == 32) | ((a >= 9) & (a <= 13)))
    word[0] = word[-1] = False
    edge = np.flatnonzero(word[1:] != word[:-1])
    return a, edge[::2], edge[1::2]


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme, as Spark's default file system would resolve it; executors then open the same place."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toString()


def store(uri: str):
    """(pyarrow file system, path) of a qualified path."""
    from pyarrow import fs

    head, sep, rest = uri.partition(":")
    if head in ("s3a", "s3n"):
        uri = "s3" + sep + rest
    if head == "file" and not rest.startswith("//"):
        uri = f"file://{rest}"
    return fs.FileSystem.from_uri(uri)
