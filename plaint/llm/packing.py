"""Best-fit decreasing packing of token pieces into sequences of a fixed length.

Pieces of equal length are interchangeable, so the whole corpus' best-fit decreasing packing follows from its count
of pieces per length: a table of at most ``capacity`` rows. The packing runs over that table, with a segment tree
over the remaining capacities 0..capacity that finds the tightest open bin in logarithmic time; equal bins are moved
together. Its steps, again bounded by the capacity and not by the corpus, then place every piece by its rank among
the pieces of its length.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .chunks import library_encoder
from .common import claim, slices, small_batches, table, texts_of, written

CAPACITY, END_ID = 4096, 1


class TightestBin:
    """A segment tree over remaining capacities: which ones have open bins, and the least of them from a given one on."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.n)
        self.bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def push(self, remaining: int, first: int, count: int) -> None:
        """``count`` bins numbered from ``first`` have ``remaining`` left."""
        if not count or not remaining:
            return
        self.bins[remaining].append((first, count))
        k = remaining + self.n
        while k and not self.any[k]:
            self.any[k] = 1
            k >>= 1

    def pop(self, remaining: int) -> tuple[int, int]:
        got = self.bins[remaining].pop()
        if not self.bins[remaining]:
            k = remaining + self.n
            self.any[k] = 0
            while k > 1:
                k >>= 1
                self.any[k] = self.any[2 * k] | self.any[2 * k + 1]
        return got

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open bin that is ``least`` or more."""
        k = least + self.n
        if self.any[k]:
            return least
        while k > 1:
            if not k & 1 and self.any[k + 1]:
                k += 1
                while k < self.n:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.n
            k >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """(steps, number of bins) for ``counts`` pieces of each length.

    A step (length, rank, per_bin, first_bin, used) puts the pieces of that length from that rank on into bins from
    ``first_bin`` on, ``per_bin`` into each, behind the ``used`` tokens there. The result equals placing one piece
    after the other, longest first, each into the tightest open bin: after a piece its bin is again the tightest one
    as long as another piece fits, so a bin takes as many as fit."""
    tree, steps, bins = TightestBin(capacity), [], 0
    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        left, rank = counts[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, per = capacity, capacity // length
                first, open_bins = bins, -(-left // per)
                bins += open_bins
            else:
                per = remaining // length
                first, open_bins = tree.pop(remaining)
            full = min(open_bins, left // per)
            if full:
                steps.append((length, rank, per, first, capacity - remaining))
                tree.push(remaining - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < open_bins:
                if left:
                    steps.append((length, rank, left, first + full, capacity - remaining))
                    tree.push(remaining - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
                tree.push(remaining, first + full, open_bins - full)
    return np.array(steps, np.int64).reshape(-1, 5), bins


def pieces(df: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(part, nth, doc_id, piece, start, length, ids_crc32[, ids]) for the token ids of each row of ``df`` (``doc_id``, ``text``) plus ``end_id``.

    ``nth`` numbers a task's (``part``'s) pieces of one length. Longer documents are cut into pieces of ``capacity``, the
    last may be shorter. Null text counts as empty and gives a piece of the end id alone; repeated rows give their pieces
    again; a null doc_id stays null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("chunks")
        encoder, width = library_encoder(vocabulary, "white")
        kind = "<u2" if width == 2 else "<u4"
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, limit=4 << 20):
            doc, no, start, length, crc, ids = [], [], [], [], [], []
            for k, got in zip(batch.column(0).to_pylist(), encoder.encode(texts_of(batch))):
                all_ids = np.append(np.frombuffer(got, kind).astype("<u4"), np.uint32(end_id))
                for p, at in enumerate(range(0, all_ids.size, capacity)):
                    x = all_ids[at: at + capacity]
                    doc.append(k)
                    no.append(p)
                    start.append(at)
                    length.append(x.size)
                    crc.append(zlib.crc32(x.tobytes()))
                    if with_ids:
                        ids.append(x)
            size = np.array(length, np.int64)
            order = np.argsort(size, kind="stable")
            ordered = size[order]
            first = np.searchsorted(ordered, ordered, side="left")
            nth = np.empty_like(size)
            nth[order] = seen[ordered] + np.arange(size.size) - first
            seen += np.bincount(size, minlength=capacity + 1)
            cols = [pa.array(np.full(size.size, part)), pa.array(nth), pa.array(doc, pa.int64()), pa.array(no, pa.int32()), pa.array(start, pa.int64()), pa.array(size), pa.array(crc, pa.int64())]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, names=["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    rows = small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "part long, nth long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a written table of pieces()) with sequence_id and offset in place of part and nth.

    Pieces of one length get consecutive ranks over all parts from the counts per part and length, so no group of
    pieces meets in one task; the steps, a few thousand rows whatever the corpus, go to every task."""
    spark = cut.sparkSession
    counts = cut.groupBy("part", "length").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("base"))
    total = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    steps, _ = best_fit_decreasing(total, capacity)
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = spark.sparkContext.broadcast(steps)
    ranked = cut.join(base, ["part", "length"])
    kept = [c for c in cut.columns if c not in ("part", "nth", "length")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        starts = (steps[:, 0] << 45) | steps[:, 1]
        for batch in batches:
            length, rank = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            s = steps[np.searchsorted(starts, (length << 45) | rank, side="right") - 1]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(length), pa.array(s[:, 3] + k // s[:, 2]), pa.array(s[:, 4] + k % s[:, 2] * length)], names=[*kept, "length", "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select("length", (F.col("base") + F.col("nth")).alias("rank"), *kept).mapInArrow(run, f"{kinds}, length long, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, input_ids, doc_ids) from packed pieces with ids: each at most the capacity long, its pieces in order of their offset."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return rows.select("sequence_id", F.flatten(F.col("p.ids")).alias("input_ids"), F.col("p.doc_id").alias("doc_ids"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' token pieces packed best-fit decreasing into sequences of at most 4096 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))


def packed_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    cut = written(pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    return pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
