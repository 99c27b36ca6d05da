"""The most frequent terms of texts, and texts' weights over them, without a shuffle of all terms.

Few of the terms (uni- and bigrams) of a corpus get into a bounded vocabulary, but a count of all of them moves more
bytes than the texts have. Here tasks first count terms by hash bucket in one array of fixed size. A bucket's sum is at
least that of each of its terms, so a term of a high total is in a high bucket: a second pass counts, exactly and by the
terms themselves, those of the highest buckets. If that gives enough terms above the buckets' bound, all others lie
below them; if not, the bound is lowered. Words come as arrays of strings; an Arrow batch numbers its distinct words, so
that terms are numbers (pairs of numbers) until they are sent."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .text import STOP_WORDS

#: Hash buckets of the first pass (a power of two), and rows of the table by which their counts are summed.
BUCKETS, BLOCKS = 1 << 20, 16
#: Tasks of the first pass for each core, at most: each sends its counts.
TASKS_A_CORE = 4
#: The bound lies at so many times the wanted terms' rank among the buckets at first, and is divided by this later.
MORE, LOWER = 3, 4
#: Words of a slice of a batch, about.
SLICE_WORDS = 500_000


def words(text: str, pattern: str) -> Column:
    """The lower-case runs of word characters of a column; null counts as empty."""
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(pattern), 1)


def _stop() -> pa.Array:
    return pa.array(STOP_WORDS, pa.string())


class Grams:
    """The terms of a batch of word lists, stop words removed before bigrams: ``names`` are the distinct words, ``uni`` and
    ``bi`` hold an entry per occurrence: the list's place in the batch and the place of its word, or words, in ``names``."""

    def __init__(self, lists: pa.Array):
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        self.names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.repeat(np.arange(len(lists)), sizes)
        kept = ~pc.is_in(self.names, value_set=_stop()).to_numpy(zero_copy_only=False).astype(bool)[codes] if len(codes) else np.zeros(0, bool)
        rows, codes = rows[kept], codes[kept]
        beside = rows[1:] == rows[:-1]
        self.uni, self.bi = (rows, codes), (rows[1:][beside], codes[:-1][beside], codes[1:][beside])

    def buckets(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash buckets, of ``n``, of all unigrams and bigrams; they depend on the words only."""
        h = pd.util.hash_array(np.array(self.names.to_pylist(), object), categorize=False) if len(self.names) else np.zeros(0, np.uint64)
        mixed = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (h >> np.uint64(31))
        _, a, b = self.bi
        last = np.uint64(n - 1)
        pairs = (mixed[a] + h[b]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (h[self.uni[1]] & last).astype(np.int64), ((pairs >> np.uint64(32)) & last).astype(np.int64)


def word_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches cut to some SLICE_WORDS words (one longer list stands alone)."""
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE_WORDS, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def bucket_counts(docs: DataFrame, column: str) -> np.ndarray:
    """How often terms of each hash bucket occur in ``column``, an array of words."""
    n = BUCKETS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in word_slices(batches, column):
            for found in Grams(batch.column(batch.schema.get_field_index(column))).buckets(n):
                total += np.bincount(found, minlength=n)
        if total.any():
            parts = total.reshape(BLOCKS, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(BLOCKS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.int64) for x in table.column("n"))
        return pa.table({"block": table.column("block")[:1].cast(pa.int32()), "n": pa.array([total.tobytes()], pa.binary())})

    few = docs.select(column).coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism * TASKS_A_CORE))
    out = np.zeros((BLOCKS, n // BLOCKS), np.int64)
    for r in few.mapInArrow(count, "block int, n binary").groupBy("block").applyInArrow(add, "block int, n binary").collect():  # 8 bytes a bucket
        out[r["block"]] = np.frombuffer(r["n"], np.int64)
    return out.ravel()


def term_totals(docs: DataFrame, column: str, wanted: np.ndarray, key: str | None = None) -> DataFrame:
    """(term, df, total) of all terms in the ``wanted`` buckets: documents that hold it, and occurrences. A row is a
    document; with ``key``, all rows of a key are one."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))
    kind, buckets = "" if key is None else f"key {docs.schema[key].dataType.simpleString()}, ", len(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_wanted = np.unpackbits(shared.value, count=buckets).astype(bool)
        for batch in word_slices(batches, column):
            grams = Grams(batch.column(batch.schema.get_field_index(column)))
            n = max(1, len(grams.names))
            one, two = (is_wanted[x] for x in grams.buckets(buckets))
            rows = np.concatenate([grams.uni[0][one], grams.bi[0][two]])
            # words are numbered from 1, so that a unigram is a pair without a second word
            terms = np.concatenate([(grams.uni[1][one] + 1) * (n + 1), (grams.bi[1][two] + 1) * (n + 1) + grams.bi[2][two] + 1])
            terms, at = np.unique(terms, return_inverse=True)
            if not len(terms):
                continue
            pairs, tf = np.unique(rows * len(terms) + at, return_counts=True)
            row, at = np.divmod(pairs, len(terms))
            first, second = np.divmod(terms, n + 1)
            a = grams.names.take(pa.array(first - 1))
            b = grams.names.take(pa.array(second - 1, mask=second == 0))
            names = pc.coalesce(pc.binary_join_element_wise(a, b, " "), a)
            if key is None:
                total = np.bincount(at, weights=tf, minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([names, pa.array(np.bincount(at, minlength=len(terms)), pa.int64()), pa.array(total, pa.int64())], names=["term", "df", "total"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)).take(pa.array(row)), names.take(pa.array(at)), pa.array(tf, pa.int64())], names=["key", "term", "total"])

    if key is None:
        return docs.select(column).mapInArrow(count, "term string, df long, total long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    counts = docs.select(key, column).mapInArrow(count, kind + "term string, total long").groupBy("key", "term").agg(F.sum("total").alias("total"))
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("total").alias("total"))


def top_terms(docs: DataFrame, column: str, least_docs: int, most: int, key: str | None = None) -> list[Row]:
    """(term, df, total) of the ``most`` terms with the highest totals (ties by term) of at least ``least_docs`` documents;
    ``most`` rows come to the driver."""
    buckets = bucket_counts(docs, column)
    lowest = max(least_docs, 1)  # a term occurs at least once in each of its documents
    least = max(lowest, int(np.sort(buckets)[::-1][min(MORE * most, len(buckets) - 1)]))
    while True:
        counts = term_totals(docs, column, buckets >= least, key).filter((F.col("df") >= least_docs) & (F.col("total") >= least))
        top = counts.orderBy(F.col("total").desc(), "term").limit(most).collect()
        if len(top) == most or least == lowest:
            return top
        least = max(lowest, least // LOWER)


class Lookup:
    """Finds the terms of a vocabulary, of one or two words each, in word lists."""

    def __init__(self, terms: list[str]):
        parts = [t.split(" ") for t in terms]
        names = sorted({w for p in parts for w in p})
        at = {w: i for i, w in enumerate(names)}
        self.size, self.names, self.width = len(terms), pa.array(names, pa.string()), len(names) + 1
        self.one = np.full(self.width, -1)  # the last place is that of unknown words
        for i, p in enumerate(parts):
            if len(p) == 1:
                self.one[at[p[0]]] = i
        pairs = sorted((at[p[0]] * self.width + at[p[1]], i) for i, p in enumerate(parts) if len(p) == 2)
        self.pairs, self.pair_terms = (np.array([x[i] for x in pairs], np.int64) for i in (0, 1))

    def counts(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, term, occurrences) of the vocabulary's terms, by list and term."""
        grams = Grams(lists)
        known = pc.fill_null(pc.index_in(grams.names, value_set=self.names), self.width - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        rows, terms = [grams.uni[0]], [self.one[known[grams.uni[1]]]]
        if len(self.pairs):
            row, a, b = grams.bi
            wanted = known[a] * self.width + known[b]
            place = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
            rows.append(row)
            terms.append(np.where(self.pairs[place] == wanted, self.pair_terms[place], -1))
        row, term = np.concatenate(rows), np.concatenate(terms)
        found = term >= 0
        both, tf = np.unique(row[found] * max(1, self.size) + term[found], return_counts=True)
        return *np.divmod(both, max(1, self.size)), tf


def weighed(lookup: Lookup, idf: np.ndarray, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list, term, weight): (1 + ln tf) * idf, the weights of a list of length 1."""
    row, term, tf = lookup.counts(lists)
    log = 1 + np.log(np.arange(1, tf.max() + 1, dtype=float)) if len(tf) else np.zeros(0)  # equal counts weigh exactly the same
    w = log[tf - 1] * idf[term]
    norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(lists)))
    return row, term, w / np.where(norm > 0, norm, 1)[row]


def text_weights(docs: DataFrame, key: str, column: str, vocab: list[Row]) -> DataFrame:
    """(key, term, weight) of each row's terms of ``vocab`` (term, idf), worked out within the row; a key must have one row."""
    shared = docs.sparkSession.sparkContext.broadcast(([r["term"] for r in vocab], np.array([r["idf"] for r in vocab], float)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf = shared.value
        lookup, names = Lookup(terms), pa.array(terms, pa.string())
        for batch in word_slices(batches, column):
            row, term, w = weighed(lookup, idf, batch.column(batch.schema.get_field_index(column)))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)).take(pa.array(row)), names.take(pa.array(term)), pa.array(w)], names=[key, "term", "weight"])

    return docs.select(key, column).mapInArrow(weigh, f"`{key}` {docs.schema[key].dataType.simpleString()}, term string, weight double")
