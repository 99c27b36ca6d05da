"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each padded to a 23-bit word of the perfect binary Golay code. A
word's keys are the codewords within four bits: one, or six for words three bits from their codeword. Two words at
most two bits apart always share a key (the word halfway between lies within three bits of its own codeword). Of
four differing bits, some two segments get at most two each, so linked fingerprints agree in the joint key of one
pair of segments; each bucket of equal keys is then verified bit by bit.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import claim, holds, slices, small_batches, table, texts_of, written

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
#: A bucket with more fingerprints than this is verified in blocks by several tasks.
BUCKET_ROWS = 20_000


def _shingle_hashes(data: bytes, words: int) -> np.ndarray:
    """XXH64 of every shingle of one lower-cased text (fewer words: of the whole sequence)."""
    import xxhash

    parts = data.split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - words + 1)
    one = xxhash.xxh64_intdigest
    return np.fromiter([one(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[len(parts) - n:].tolist())], np.uint64, n)


def simhash(texts: list[str], words: int = SHINGLE_WORDS) -> np.ndarray:
    """The fingerprints: a bit is set if more than half of the shingle hashes (repeats included) have it; no word gives zero.

    Only A-Z are lower-cased; words are runs without the six ASCII white-space characters."""
    out = np.zeros(len(texts), np.uint64)
    lanes = np.uint64(0x0101010101010101)
    for i, t in enumerate(texts):
        h = _shingle_hashes(t.encode("utf-8", "surrogatepass").lower(), words)
        n = h.size
        if not n:
            continue
        groups = np.arange(0, n, 255)
        fp = 0
        for k in range(8):  # eight bits at once: each byte of a sum counts one of them, over 255 hashes at most
            sums = np.add.reduceat((h >> np.uint64(k)) & lanes, groups)
            counts = sums.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
            for byte in range(8):
                if 2 * int(counts[byte]) > n:
                    fp |= 1 << (8 * byte + k)
        out[i] = fp
    return out


def fingerprints(df: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, key: str = "doc_id") -> DataFrame:
    """(``key``, fp long) of each row of ``df`` (columns ``key`` and ``text``; others are not looked at). Null text: no words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("simhash")
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(simhash(texts_of(batch), words).view(np.int64))], names=[key, "fp"])

    rows = small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id") if key == "doc_id" else F.col(key), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, fp long")


@functools.lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword's 12-bit index of every 23-bit word, the up to 6 key indices of every coset as an error table).

    The systematic [23, 12, 7] code of the generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1; a codeword's
    index is its upper 12 bits. For each of the 2048 syndromes: the error patterns of at most four bits, first the least."""
    poly = 0b101011100011

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= poly << (bit - 11)
        return word

    of_bit = [syndrome(1 << b) for b in range(23)]
    patterns: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = e = 0
            for b in bits:
                s ^= of_bit[b]
                e |= 1 << b
            patterns[s].append(e)
    errors = np.full((2048, 6), -1, np.int64)
    for s, found in enumerate(patterns):
        assert len(found) in (1, 6)
        errors[s, : len(found)] = found
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for b in range(12):
        low[1 << b: 2 << b] = low[: 1 << b] ^ of_bit[b]
    for b in range(11):
        high[1 << b: 2 << b] = high[: 1 << b] ^ of_bit[12 + b]
    x = np.arange(1 << 23)
    return (low.astype(np.int16)[x & 4095] ^ high.astype(np.int16)[x >> 12]), errors


@holds("simhash")
def forget() -> None:
    golay.cache_clear()


def segment_keys(words: np.ndarray) -> np.ndarray:
    """The key indices of 23-bit words: 6 columns, -1 where there are fewer."""
    syndromes, errors = golay()
    e = errors[syndromes[words]]
    return np.where(e >= 0, (words[:, None] ^ e) >> 11, -1)


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(joint keys, index of their fingerprint): for each pair of segments every combination of their key indices."""
    per = [segment_keys(((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64)) for a, n in SEGMENTS]
    keys, owner = [], []
    for k, (a, b) in enumerate(PAIRS):
        joint = (per[a][:, :, None] << 12) | per[b][:, None, :] | (k << 24)
        ok = (per[a][:, :, None] >= 0) & (per[b][:, None, :] >= 0)
        at = np.nonzero(ok)
        keys.append(joint[ok])
        owner.append(at[0])
    return np.concatenate(keys), np.concatenate(owner)


def forest(fp: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect what all links within ``fp`` connect: one less than the members of each group.

    A search from each fingerprint looks only at those that no group has yet, so a dense group costs little."""
    rest, links = fp, []
    while rest.size:
        todo, rest = [rest[0]], rest[1:]
        while todo and rest.size:
            v = todo.pop()
            near = np.bitwise_count(rest ^ v) <= bits
            if near.any():
                got = rest[near]
                links += [(int(v), int(g)) for g in got]
                todo.extend(got)
                rest = rest[~near]
    return links


def _link_buckets(keyed: DataFrame, bits: int) -> DataFrame:
    """(a, b): verified links that connect each bucket's members; rows (key, block, fp) sorted by bucket within partitions."""
    def linked(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
        cut = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [key.size]))
        size = np.diff(cut)
        two = cut[:-1][size == 2]
        near = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits]
        found = [np.stack((fp[near], fp[near + 1]), 1)]
        for k in np.flatnonzero(size > 2):
            if got := forest(np.unique(fp[cut[k]: cut[k + 1]]), bits):
                found.append(np.array(got, np.uint64))
        got = np.concatenate(found).view(np.int64)
        return np.unique(np.sort(got[got[:, 0] != got[:, 1]], 1), axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []  # rows since the start of the last bucket, which may go on

        def batch_of(got: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1]))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy().astype(np.int64) * 4096 + batch.column(1).to_numpy()
            fp = batch.column(2).to_numpy().view(np.uint64)
            if held and held[-1][0][-1] == key[0] == key[-1]:
                held.append((key, fp))
                continue
            key, fp = np.concatenate([k for k, _ in held] + [key]), np.concatenate([f for _, f in held] + [fp])
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
            held = [(key[last:], fp[last:])]
            if last:
                yield batch_of(linked(key[:last], fp[:last]))
        if held:
            yield batch_of(linked(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held])))

    return keyed.select("key", "block", "fp").mapInArrow(run, "a long, b long")


def links(distinct: DataFrame, bits: int = MAX_BITS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect whatever all links at ``bits`` or fewer bits connect."""
    if bits > 4:
        raise ValueError("three segments of the Golay code cover at most four differing bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(lo, 4096).to_numpy()
                keys, owner = fuzzy_keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(fp[owner])], names=["key", "fp"])

    keyed = distinct.select("fp").mapInArrow(run, "key int, fp long")
    keyed = keyed.withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(1 << 16)).cast("int"))
    # blocks: a bucket of up to bucket_rows stays whole; a larger one is compared block against block
    sizes = keyed.groupBy("key").count().filter(F.col("count") > bucket_rows).select("key", F.least(F.lit(64), F.ceil(F.col("count") / (bucket_rows / 2))).cast("int").alias("blocks"))
    sized = keyed.join(sizes, "key", "left").withColumn("n", F.coalesce("blocks", F.lit(1)))
    own = F.pmod("part", "n")
    blocks = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.least(own, j) * 64 + F.greatest(own, j))
    rows = sized.select("key", F.explode(F.when(F.col("n") == 1, F.array(F.lit(0))).otherwise(blocks)).alias("block"), "fp")
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block")
    return _link_buckets(rows, bits).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of ``edges`` (a, b) with the smallest node of its connected component.

    Alternating star contraction: each round ties larger and then smaller neighbours to a node's least neighbour; the
    edge table is written in the shared folder after each round, and rounds end when it doesn't change any more."""
    now = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        now = written(small, "links")
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("the star contraction did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def near_duplicates(df: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``df``: components of documents whose fingerprints differ in ``bits`` bits or fewer.

    Repeated texts share a fingerprint and thus a component; texts without words have fingerprint zero and link like others.
    A component's id is its smallest non-null doc_id (null only if it has none); repeated rows stay repeated. Only
    distinct fingerprints are keyed and compared, so thousands of copies count once."""
    docs = written(fingerprints(df, words=words), "fingerprints")
    rooted = _rooted(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), bits)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _rooted(distinct: DataFrame, bits: int) -> DataFrame:
    """(fp, least, root) of distinct fingerprints (fp, least); a component has one root."""
    distinct = written(distinct, "distinct")
    comp = written(components(links(distinct, bits)), "components")
    # only fingerprints with links have a root; the others stand for themselves
    return distinct.join(comp, distinct["fp"] == comp["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def one_per_component(df: DataFrame, words: int = SHINGLE_WORDS, bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``df`` (doc_id, text and others) without near duplicates: exactly one of each component stays.

    It is the first by (doc_id, nulls last; fingerprint; hash of id and text), so rows without doc_id are judged too, and different
    texts under one doc_id are told apart. Of rows with equal doc_id and text any one stays."""
    key = F.unhex(F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))), 256))
    who = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"), key.alias("key"))
    docs = written(fingerprints(df.select(who.alias("who"), "text"), words=words, key="who"), "fingerprints")
    rooted = _rooted(docs.groupBy("fp").agg(F.min("who").alias("least")), bits)
    first = rooted.groupBy("root").agg(F.min(F.struct("least.none", "least.id", "fp", "least.key")).alias("first"))
    return df.withColumn("_key", key).join(first.select(F.col("first.key").alias("_key")), "_key", "left_semi").dropDuplicates(["_key"]).drop("_key")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
