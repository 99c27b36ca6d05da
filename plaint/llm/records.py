"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A record is: length (8 bytes), masked CRC-32C of those bytes (4), data (length bytes), masked CRC-32C of the data (4);
all integers are little-endian. Data is the row's id (8 bytes), 1 if there is one else 0, the bytes of a token id, and
the token ids. A shard's index holds (offset, token ids before it in the shard, token ids) of each record, 8 bytes each.
"""
from __future__ import annotations

import functools
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chunks import library_encoder
from .common import claim, fresh_folder, qualified, slices, small_batches, store, table, texts_of

#: Fixed by the format: the reflected Castagnoli polynomial and the mask.
POLYNOMIAL, MASK = 0x82F63B78, 0xA282EAD8
BLOCK = 256
HEAD, HEAD_BYTES = "<qBB", 10


@functools.lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(the checksum's step for 16 bits, the effect of BLOCK zero bytes on each byte of the state)."""
    t = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        t = (t >> 1) ^ np.where(t & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    state = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
    for _ in range(BLOCK // 2):
        state = t[state & 0xFFFF] ^ (state >> 16)
    return t, state


def crc32c(parts: list[bytes]) -> np.ndarray:
    """CRC-32C of each part (four bytes or longer): blocks of all parts go through the register side by side, then each part's blocks are joined."""
    if not parts:
        return np.zeros(0, np.uint32)
    step, shift = _tables()
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    if size.min() < 4:
        raise ValueError("parts of four bytes or longer only")
    pad = -size % BLOCK  # zeros in front leave an empty register empty
    zeros = bytes(BLOCK)
    data = np.frombuffer(bytearray().join(x for p, n in zip(parts, pad.tolist()) for x in (zeros[:n], p)), np.uint8)
    ends = np.cumsum(size + pad)
    first = (ends - size)[:, None] + np.arange(4)
    data[first] ^= 0xFF  # the register starts with ones
    lanes = np.ascontiguousarray(data.view("<u2").reshape(-1, BLOCK // 2).T)
    crc = np.zeros(lanes.shape[1], np.uint32)
    for row in lanes:
        crc = step[(crc ^ row) & 0xFFFF] ^ (crc >> 16)
    blocks = (size + pad) // BLOCK
    order = np.argsort(-blocks, kind="stable")
    at, count = (np.cumsum(blocks) - blocks)[order], blocks[order]
    state = np.zeros(len(parts), np.uint32)
    for j in range(int(count[0])):
        m = int(np.searchsorted(-count, -j, side="left"))
        s = state[:m]
        state[:m] = shift[0][s & 255] ^ shift[1][s >> 8 & 255] ^ shift[2][s >> 16 & 255] ^ shift[3][s >> 24] ^ crc[at[:m] + j]
    out = np.empty_like(state)
    out[order] = ~state
    return out


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def frame(parts: list[bytes]) -> list[bytes]:
    """The records of the parts."""
    heads = [struct.pack("<Q", len(p)) for p in parts]
    a, b = masked(crc32c(heads)).astype("<u4"), masked(crc32c(parts)).astype("<u4")
    return [h + a[i].tobytes() + p + b[i].tobytes() for i, (h, p) in enumerate(zip(heads, parts))]


def unframe(records: list[bytes]) -> list[bytes]:
    """The data of whole records, after all checks."""
    parts = [r[12:-4] for r in records]
    heads = [r[:8] for r in records]
    if [struct.unpack("<Q", h)[0] for h in heads] != list(map(len, parts)):
        raise ValueError("a record's length differs from the index")
    told = np.frombuffer(b"".join(r[8:12] + r[-4:] for r in records), "<u4").reshape(-1, 2)
    if not (np.array_equal(told[:, 0], masked(crc32c(heads))) and np.array_equal(told[:, 1], masked(crc32c(parts)))):
        raise ValueError("a record's checksum is wrong")
    return parts


def write_records(df: DataFrame, vocabulary: str, end_id: int, folder: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the token ids of ``df`` (plus ``end_id``) in ascending order of ``key`` (null first; ties in no set order), a shard for each range of keys.

    Returns the shards that count: (shard, data_path, index_path, records, ids). Each attempt at a task writes files of
    its own; the returned table is written too and names those of the attempt that Spark took, so lost executors and
    repeated tasks do no harm. Null text counts as empty, an empty table gives no shard."""
    spark = df.sparkSession
    folder = qualified(spark, folder)
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("chunks")
        encoder, width = library_encoder(vocabulary, "space")
        end = np.array([end_id], "<u2" if width == 2 else "<u4").tobytes()
        fs, place = store(folder)
        shard = TaskContext.get().partitionId()
        name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
        index: list[np.ndarray] = []
        offset = ids = records = 0
        out = None
        for batch in slices(batches, limit=4 << 20):
            out = out or fs.open_output_stream(f"{place}/{name}.records")
            got = encoder.encode(texts_of(batch))
            parts = [struct.pack(HEAD, k or 0, k is not None, width) + x + end for k, x in zip(batch.column(0).to_pylist(), got)]
            whole = frame(parts)
            n = np.fromiter(((len(x) + width) // width for x in got), np.int64, len(got))
            size = np.fromiter(map(len, whole), np.int64, len(whole))
            index.append(np.stack((offset + np.cumsum(size) - size, ids + np.cumsum(n) - n, n), 1))
            out.write(b"".join(whole))
            offset, ids, records = offset + int(size.sum()), ids + int(n.sum()), records + len(whole)
        if out:
            out.close()
            with fs.open_output_stream(f"{place}/{name}.index") as f:
                f.write(np.concatenate(index).astype("<u8").tobytes())
            yield pa.RecordBatch.from_pydict({"shard": [shard], "data_path": [f"{folder}/{name}.records"], "index_path": [f"{folder}/{name}.index"], "records": [records], "ids": [ids]}, schema=pa.schema([("shard", pa.int64()), ("data_path", pa.string()), ("index_path", pa.string()), ("records", pa.int64()), ("ids", pa.int64())]))

    rows = small_batches(df).select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text")).repartitionByRange("key").sortWithinPartitions("key")
    shards = rows.mapInArrow(run, "shard long, data_path string, index_path string, records long, ids long")
    shards.write.parquet(f"{folder}/shards")
    return spark.read.parquet(f"{folder}/shards")


def read_some(data_path: str, index_path: str, picks: list[int] | None = None, step: int = 4 << 20) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(index rows, data) of a shard's records in blocks of about ``step`` bytes, or of the records numbered ``picks`` in that order (for shuffled reads)."""
    fs, place = store(index_path)
    with fs.open_input_file(place) as f:
        index = np.frombuffer(f.read(), "<u8").reshape(-1, 3).astype(np.int64)
    fs, place = store(data_path)
    with fs.open_input_file(place) as f:
        ends = np.append(index[1:, 0], f.size())
        if picks is not None:
            for k in picks:
                yield index[k: k + 1], unframe([f.read_at(int(ends[k] - index[k, 0]), int(index[k, 0]))])
            return
        lo = 0
        while lo < len(index):
            hi = max(lo + 1, int(np.searchsorted(ends, index[lo, 0] + step, side="right")))
            at = int(index[lo, 0])
            data = f.read_at(int(ends[hi - 1]) - at, at)
            yield index[lo:hi], unframe([data[a - at: b - at] for a, b in zip(index[lo:hi, 0].tolist(), ends[lo:hi].tolist())])
            lo = hi


def read_records(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every record of the shards; ``start`` counts the ids of all shards before it.

    Every length and checksum is verified; a wrong one ends the job with an error."""
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per shard
    todo = shards.withColumn("base", F.coalesce(before, F.lit(0)))
    # a task for each shard
    todo = todo.select("data_path", "index_path", "base").repartition(max(1, shards.count()), "data_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for index, parts in read_some(row["data_path"], row["index_path"]):
                    heads = [struct.unpack_from(HEAD, p) for p in parts]
                    ids = [np.frombuffer(p, "<u2" if h[2] == 2 else "<u4", offset=HEAD_BYTES).astype("<u4") for p, h in zip(parts, heads)]
                    if any(len(x) != n for x, n in zip(ids, index[:, 2].tolist())):
                        raise ValueError("a record's ids differ from the index")
                    cols = [pa.array([h[0] if h[1] else None for h in heads], pa.int64()), pa.array(index[:, 1] + row["base"]), pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())]
                    if with_ids:
                        cols.append(pa.array(ids, pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def op6_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents as binary records in ascending doc_id order, read back from the files."""
    import public_tokenizers

    folder = fresh_folder(spark, "records")
    shards = write_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, folder)
    return read_records(shards, with_ids=False)
