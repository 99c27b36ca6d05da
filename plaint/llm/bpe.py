"""Byte-level BPE with a two-tier lookup: a minimal perfect hash for whole pre-tokens, a heap over linked bytes for the rest."""
from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import ChunkEncoder
from .common import claim, holds, slices, small_batches, table, texts_of


class MinimalPerfectHash:
    """Puts n different byte strings on the slots 0..n-1 without a collision: a displacement for each of n/4 buckets.

    Buckets are placed from the largest on; each tries displacements until all its keys fall on free slots."""

    def __init__(self, keys: list[bytes]):
        import xxhash

        self.n, self.buckets = len(keys), max(1, len(keys) // 4)
        self.shift = [0] * self.buckets
        self.slots: list[int] = [-1] * self.n
        groups: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for k, key in enumerate(keys):
            h = xxhash.xxh64_intdigest(key)
            groups[h % self.buckets].append((h, k))
        free = np.ones(max(1, self.n), np.bool_)
        tries = np.arange(512, dtype=np.uint64)
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            members = groups[b]
            if not members:
                break
            h = np.array([x for x, _ in members], np.uint64)
            d = np.uint64(0)
            while True:  # 512 displacements at once
                at = self._slots(h[None, :], (tries + d)[:, None])
                ok = free[at].all(1)
                if len(members) > 1:
                    ok &= (np.diff(np.sort(at, 1), axis=1) != 0).all(1)
                if ok.any():
                    break
                d += np.uint64(512)
            k = int(ok.argmax())
            self.shift[b] = int(d) + k
            free[at[k]] = False
            for s, (_, key) in zip(at[k].tolist(), members):
                self.slots[s] = key

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        """As _slot(), for arrays."""
        mixed = (h ^ (d * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
        return ((mixed >> np.uint64(20) & np.uint64(0xFFFFFFFF)) % np.uint64(max(1, self.n))).astype(np.int64)

    def _slot(self, h: int, d: int) -> int:
        return ((h ^ (d * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * 0xFF51AFD7ED558CCD >> 20 & 0xFFFFFFFF) % self.n

    def find(self, key: bytes) -> int:
        """The number of the only key that can equal ``key``; -1 without keys."""
        import xxhash

        if not self.n:
            return -1
        h = xxhash.xxh64_intdigest(key)
        return self.slots[self._slot(h, self.shift[h % self.buckets])]


class BytePairs:
    """Encodes and decodes by the ranks of a vocabulary file (base64 token and rank on a line)."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        self.tokens = [base64.b64decode(a) for a, _ in rows]
        self.ids = [int(b) for _, b in rows]
        self.hash = MinimalPerfectHash(self.tokens)
        self.rank = dict(zip(self.tokens, self.ids))
        self.bytes_of = dict(zip(self.ids, self.tokens))
        self.split = regex.compile(pattern).findall
        self.code = "H" if max(self.ids, default=0) < 1 << 16 else "I"
        self.chunks = ChunkEncoder(self.encode_many, "space")

    def whole(self, pretoken: bytes) -> int | None:
        """First tier: the id of a pre-token that is a token itself."""
        k = self.hash.find(pretoken)
        return self.ids[k] if k >= 0 and self.tokens[k] == pretoken else None

    def merged(self, pretoken: bytes) -> list[int]:
        """Second tier: the pair of neighbours with the lowest rank merges first, the leftmost of equals; neighbours are linked, pairs wait in a heap."""
        rank, n = self.rank, len(pretoken)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if (r := rank.get(pretoken[i: i + 2])) is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            r, i, e = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or end[j] != e:
                continue  # one of the two has merged since
            alive[j] = 0
            end[i] = e
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get(pretoken[i: end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            if (p := before[i]) >= 0 and (r := rank.get(pretoken[p: e])) is not None:
                heapq.heappush(heap, (r, p, e))
        out, i = [], 0
        while i < n:
            out.append(rank[pretoken[i: end[i]]])
            i = after[i]
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            ids = array(self.code)
            for x in self.split(t):
                data = x.encode("utf-8", "surrogatepass")
                if (one := self.whole(data)) is not None:
                    ids.append(one)
                else:
                    ids.extend(self.merged(data))
            out.append(ids.tobytes())
        return out

    def encode(self, texts: list[str]) -> list[array]:
        """The ids of each text; chunks between single spaces are looked up among those seen before."""
        out = []
        for got in self.chunks.encode(texts):
            ids = array(self.code)
            ids.frombytes(got)
            out.append(ids)
        return out

    def decode(self, ids: array) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_loaded: dict[tuple[str, str], BytePairs] = {}


@holds("bpe")
def forget() -> None:
    for pairs in _loaded.values():
        pairs.chunks.forget()


def byte_pairs(path: str, pattern: str) -> BytePairs:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = BytePairs(path, pattern)
    return _loaded[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids, decoded]) of each row of ``df`` (``doc_id``, ``text``).

    ``decoded`` are the bytes of the ids just made, so its digest differs from the text's if a step were wrong. Null text
    counts as empty (no ids); whole texts are encoded, repeated rows each by themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("bpe")
        pairs = byte_pairs(path, pattern)
        for batch in slices(batches, limit=4 << 20):
            ids = pairs.encode(texts_of(batch))
            decoded = [pairs.decode(x) for x in ids]
            cols = [batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in decoded])]
            if with_ids:
                cols += [pa.array([np.frombuffer(x, x.typecode).astype(np.int64) for x in ids], pa.list_(pa.int64())), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(cols)])

    rows = small_batches(df).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>, decoded binary" * with_ids)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document and the bytes they decode to, as digests."""
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)
