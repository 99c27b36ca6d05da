"""Document fingerprints from closed syncmers.

A k-mer of code points is a closed syncmer if the least of its inner s-mers (by hash) is its first or its last one.
That depends on the k-mer alone, so an edit elsewhere moves an anchor but never changes the choice. A fingerprint
keeps the anchors with the least hashes, each with its position; likeness is the share of matched anchors among the
least hashes of both, where matched anchors must also stand in the same order in both texts.
"""
from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import slices, small_batches, table, texts_of, written

K, S, ANCHORS = 12, 4, 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters neighbours."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n codes in a row."""
    out = np.zeros(max(0, codes.size - n + 1), np.uint64)
    for i in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i: codes.size - n + 1 + i]
    return _mix(out)


def closed_syncmers(codes: np.ndarray, k: int = K, s: int = S) -> np.ndarray:
    """Starts of the k-mers whose least s-mer is the first or the last one (of equals any counts)."""
    if codes.size < k:
        return np.zeros(0, np.int64)
    h, w = _grams(codes, s), k - s + 1
    low, width = h, 1
    while 2 * width <= w:  # minima over windows, doubling
        low = np.minimum(low[: low.size - width], low[width:])
        width *= 2
    low = np.minimum(low[: h.size - w + 1], low[w - width: w - width + h.size - w + 1])
    return np.flatnonzero((low == h[: low.size]) | (low == h[w - 1: w - 1 + low.size]))


def fingerprint_many(texts: list[str], anchors: int = ANCHORS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes ascending, positions) of each text: its ``anchors`` syncmers with the least 32-bit hashes, the first of equal ones.

    A text shorter than a k-mer has one anchor, the whole text; the empty text has none."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(size)
    starts = ends - size
    at = closed_syncmers(codes)
    owner = np.searchsorted(ends, at, side="right")
    inside = at + K <= ends[owner] if at.size else np.zeros(0, np.bool_)  # none across two texts
    at, owner = at[inside], owner[inside]
    h = np.zeros(at.size, np.uint64)
    for i in range(K):
        h = h * np.uint64(0xD6E8FEB86659FD93) + codes[at + i]
    h = (_mix(h) >> np.uint64(32)).astype(np.uint32)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
        if a == b:
            if not size[i]:
                out.append((np.zeros(0, np.uint32), np.zeros(0, np.uint32)))
                continue
            whole = int.from_bytes(hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little")
            out.append((np.array([whole], np.uint32), np.zeros(1, np.uint32)))
            continue
        x = h[a:b]
        if x.size > 4 * anchors:  # candidates first: the least ones, with room for repeats
            limit = np.partition(x, 4 * anchors)[4 * anchors]
            pick = np.flatnonzero(x <= limit)
            values, first = np.unique(x[pick], return_index=True)
            if values.size < anchors:
                values, first = np.unique(x, return_index=True)
            else:
                first = pick[first]
        else:
            values, first = np.unique(x, return_index=True)
        out.append((values[:anchors], (at[a + first[:anchors]] - starts[i]).astype(np.uint32)))
    return out


def fingerprint_bytes(fp: tuple[np.ndarray, np.ndarray]) -> bytes:
    return np.stack(fp, 1).astype("<u4").tobytes()


def encode_fingerprint(fp: tuple[np.ndarray, np.ndarray]) -> str:
    return base64.b64encode(fingerprint_bytes(fp)).decode()


def decode_fingerprint(text: str) -> tuple[np.ndarray, np.ndarray]:
    got = np.frombuffer(base64.b64decode(text), "<u4").reshape(-1, 2)
    return got[:, 0], got[:, 1]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], anchors: int = ANCHORS) -> float:
    """0 to 1: of the least hashes of both, the share in both at places in the same order; 1 for two empty texts."""
    if not a[0].size or not b[0].size:
        return float(a[0].size == b[0].size)
    union = np.union1d(a[0], b[0])
    # beyond its own last hash a full sketch says nothing
    if a[0].size >= anchors or b[0].size >= anchors:
        limit = min(x[0][-1] for x in (a, b) if x[0].size >= anchors)
        union = union[union <= limit][:anchors]
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    near = common <= union[-1]
    p, q = a[1][i[near]], b[1][j[near]]
    chain: list[int] = []  # the longest run of matches in the same order
    for y in q[np.lexsort((q, p))].tolist():
        k = bisect.bisect_right(chain, y)
        chain[k: k + 1] = [y]
    return len(chain) / union.size


#: The result as it is written: digest and fingerprints in bytes.
RESULT = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
KINDS = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "binary": pa.binary()}


def _schema(kind: str) -> pa.Schema:
    return pa.schema([(name, KINDS[k]) for name, k in (x.split() for x in kind.split(", "))])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tie, text) to (doc_id, tie, size, packed): the texts compressed one by one, for the shuffle."""
    codec = pa.Codec("zstd")
    for batch in slices(batches):
        texts = batch.column(2).cast(pa.binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, texts), pa.int64()), pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())], names=["doc_id", "tie", "size", "packed"])


def _unpacked(batch: pa.RecordBatch) -> list[str]:
    codec = pa.Codec("zstd")
    return [codec.decompress(x, n, asbytes=True).decode() if n else "" for n, x in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]


def _answer(docs: list[tuple[int | None, str, str]]) -> list[tuple]:
    """Result rows of (doc_id, text, next text)."""
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in docs]
    own = fingerprint_many([t for _, t, _ in docs])
    new = fingerprint_many(edited)
    # the next text is mostly the next row's own
    follow: list = [own[i + 1] if i + 1 < len(docs) and docs[i + 1][1] == docs[i][2] else None for i in range(len(docs))]
    rest = [i for i, x in enumerate(follow) if x is None]
    for i, x in zip(rest, fingerprint_many([docs[i][2] for i in rest])):
        follow[i] = x
    return [(d[0], len(d[1]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).digest(), fingerprint_bytes(o), fingerprint_bytes(w), likeness(o, w), likeness(o, f)) for d, e, o, w, f in zip(docs, edited, own, new, follow)]


def fingerprint(df: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row of ``df``; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([encode_fingerprint(x) for x in fingerprint_many(texts_of(batch))], pa.string())], names=["doc_id", "fingerprint"])

    return small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def edited_pairs(df: DataFrame) -> DataFrame:
    """The contract's rows: each text, its edited text and the next document (descending doc_id; null ids last, ties by text hash; after the last the first).

    Texts are compressed one by one, dealt out by ranges of doc_id and sorted, so the next row follows in the same task.
    A task keeps its first and last rows aside; those two per task are tied together afterwards. All comes from one
    written run, as another run might draw other ranges; fingerprints and digests are written as compressed bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    rows = rows.mapInArrow(_pack, "doc_id long, tie long, size long, packed binary")
    # texts and fingerprints are large rows: a quarter of the usual data in a task keeps its sort and its writer small
    tasks = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(tasks, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "tie").select("doc_id", "size", "packed")
    kind = f"{RESULT}, part long, place string, text string"
    names = [x.split()[0] for x in kind.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first = TaskContext.get().partitionId(), None, True
        schema = _schema(kind)

        def aside(row: tuple, place: str) -> tuple:
            return (row[0], *[None] * 6, part, place, row[1])

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

        for batch in slices(batches, "size", limit=1 << 20):
            got = list(zip(batch.column(0).to_pylist(), _unpacked(batch)))
            out = [aside(got[0], "first")] if first else []
            first = False
            line = ([last] if last else []) + got
            out += [(*x, part, None, None) for x in _answer([(a[0], a[1], b[1]) for a, b in zip(line, line[1:])])] if len(line) > 1 else []
            last = line[-1]
            if out:
                yield batch_of(out)
        if last is not None:
            yield batch_of([aside(last, "last")])

    done = written(rows.mapInArrow(run, kind), "edited", compression="zstd")
    # two rows per task: every task's last document meets the first of the next task that has any
    ends = done.filter("place is not null").select("part", "place", "doc_id", "text")
    order = Window.orderBy("part")
    parts = ends.filter("place = 'first'").select("part").withColumn("next", F.lead("part").over(order))
    parts = parts.withColumn("next", F.coalesce("next", F.first("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    firsts = ends.filter("place = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    lasts = ends.filter("place = 'last'").select("part", "doc_id", "text").join(parts, "part").join(firsts, "next").select("doc_id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = _answer([tuple(c[i].as_py() for c in batch.columns)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _schema(RESULT).types)], schema=_schema(RESULT))

    got = done.filter("place is null").select(*names[:7]).union(lasts.mapInArrow(finish, RESULT))
    # base64() breaks its lines
    plain = {c: F.translate(F.base64(c), "\r\n", "") for c in ("fingerprint", "edited_fingerprint")}
    return got.withColumns({"edited_sha256": F.lower(F.hex("edited_sha256")), **plain})


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed-syncmer fingerprints of every document and of its edited text, and their likeness."""
    return edited_pairs(table(spark, sf_dir, "documents"))
