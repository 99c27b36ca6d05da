"""Periodic runs: maximal repetitions of words by suffix trees, and texts with the repeats collapsed.

A run is a stretch of words with smallest period q and at least two periods that no neighbouring word extends. Every
run holds a Lyndon root: the longest Lyndon word that starts at some position, in the order of the words or in the
reverse one. So each position gives two candidate roots; longest common extensions of a root and its shift, to the
right by a suffix tree of the text and to the left by one of its reversal, give the run or show that there is none.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, slices, small_batches, table, texts_of

#: Fixed by the contract: the shortest run in words.
MIN_LENGTH = 12
#: Entries of the Euler tour in a block of the range-minimum structure.
BLOCK = 16


class SuffixTree:
    """Ukkonen's tree of ``symbols`` (ints from 1 to ``sigma - 1``; 0 ends the text) with constant-time LCA over its Euler tour."""

    def __init__(self, symbols: list[int], sigma: int):
        self.size = len(symbols)
        self.sigma = sigma
        self._build(symbols + [0])
        self._tour()

    def _build(self, s: list[int]) -> None:
        sigma, n = self.sigma, len(s)
        start, end, link = [0], [0], [0]
        go: dict[int, int] = {}
        leaf = [0] * n
        node = edge = length = pending = 0
        for i, c in enumerate(s):
            last = 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                key = node * sigma + s[edge]
                nxt = go.get(key)
                if nxt is None:
                    leaf[i - pending + 1] = go[key] = len(start)
                    start.append(i)
                    end.append(n)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    a = start[nxt]
                    span = (end[nxt] if end[nxt] <= i else i + 1) - a
                    if length >= span:
                        node = nxt
                        edge += span
                        length -= span
                        continue
                    if s[a + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = go[key] = len(start)
                    start += (a, i)
                    end += (a + length, n)
                    link += (0, 0)
                    leaf[i - pending + 1] = go[split * sigma + c] = split + 1
                    start[nxt] = a + length
                    go[split * sigma + s[a + length]] = nxt
                    if last:
                        link[last] = split
                    last = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self._leaf = np.array(leaf)
        self._edge = np.array(end) - np.array(start)
        keys = np.fromiter(go.keys(), np.int64, len(go))
        kids = np.fromiter(go.values(), np.int64, len(go))
        order = np.argsort(keys)
        self._parent, self._symbol, self._kid = keys[order] // sigma, keys[order] % sigma, kids[order]

    def _tour(self) -> None:
        """String depths along the Euler tour (children in the order of their symbols), and where each leaf stands in it."""
        nodes = self._edge.size
        first = np.searchsorted(self._parent, np.arange(nodes + 1))
        at, stop, kid, edge = first[:-1].tolist(), first[1:].tolist(), self._kid.tolist(), self._edge.tolist()
        depth, seen, tour = [0] * nodes, [0] * nodes, []
        path, v, d = [], 0, 0
        while True:
            tour.append(d)
            p = at[v]
            if p < stop[v]:
                at[v] = p + 1
                path.append(v)
                v = kid[p]
                d += edge[v]
                depth[v] = d
                seen[v] = len(tour)
            elif path:
                v = path.pop()
                d = depth[v]
            else:
                break
        self._seen = np.array(seen)[self._leaf]
        pad = -len(tour) % BLOCK
        blocks = np.array(tour + [1 << 30] * pad, np.int32).reshape(-1, BLOCK)
        self._flat = blocks.ravel()
        self._to, self._from = np.minimum.accumulate(blocks, 1).ravel(), np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self._least = [blocks.min(1)]
        while len(self._least[-1]) > 1 << (len(self._least) - 1):
            half, top = 1 << (len(self._least) - 1), self._least[-1]
            self._least.append(np.minimum(top[:-half], top[half:]))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common symbols of the suffixes at ``i`` and ``j`` (different positions): the string depth of their leaves' LCA."""
        a, b = self._seen[i], self._seen[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        p, q = a // BLOCK, b // BLOCK
        out = np.minimum(self._from[a], self._to[b])
        far = q - p > 1
        lo, hi = p[far] + 1, q[far]
        level = np.frexp((hi - lo).astype("f8"))[1] - 1
        most = np.zeros(lo.size, np.int32)
        for k in np.unique(level):
            x = level == k
            most[x] = np.minimum(self._least[k][lo[x]], self._least[k][hi[x] - (1 << int(k))])
        out[far] = np.minimum(out[far], most)
        near = np.flatnonzero(p == q)
        if near.size:
            x, y = a[near], b[near]
            best = self._flat[x]
            for k in range(1, BLOCK):
                best = np.where(x + k <= y, np.minimum(best, self._flat[np.minimum(x + k, y)]), best)
            out[near] = best
        return out

    def ranks(self, reverse: bool = False) -> list[int]:
        """The rank of each suffix; with ``reverse`` the order of symbols is turned about, the end of the text stays the least."""
        if not reverse:
            order = np.argsort(self._seen[: self.size])
        else:
            symbol = np.where(self._symbol == 0, self.sigma, self._symbol)  # descending, the end first
            by = np.lexsort((symbol, self._parent))  # a stack turns ascending into descending
            kid = self._kid[by].tolist()
            first = np.searchsorted(self._parent, np.arange(self._edge.size + 1)).tolist()
            suffix = [-1] * self._edge.size
            for i, v in enumerate(self._leaf.tolist()):
                suffix[v] = i
            stack, found = [0], []
            while stack:
                v = stack.pop()
                if suffix[v] >= 0:
                    found.append(suffix[v])
                else:
                    stack += kid[first[v]: first[v + 1]]
            order = np.array(found)
            order = order[order < self.size]
        out = np.empty(self.size, np.int64)
        out[order] = np.arange(self.size)
        return out.tolist()


def lyndon_ends(rank: list[int]) -> np.ndarray:
    """Where the longest Lyndon word of each position ends: the next position with a smaller suffix."""
    n = len(rank)
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out)


def runs_of(codes: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """(start, length, period) of every run of at least ``min_length`` and two periods, by start and period."""
    n = codes.size
    if n < 2:
        return np.zeros((0, 3), np.int64)
    values, symbols = np.unique(codes, return_inverse=True)
    symbols = symbols.ravel() + 1
    sigma = values.size + 1
    ahead, back = SuffixTree(symbols.tolist(), sigma), SuffixTree(symbols[::-1].tolist(), sigma)
    found = []
    for reverse in (False, True):
        i = np.arange(n)
        j = lyndon_ends(ahead.ranks(reverse))
        p = j - i
        ok = 2 * p <= n
        i, j, p = i[ok], j[ok], p[ok]
        right, left = np.zeros(i.size, np.int64), np.zeros(i.size, np.int64)
        x = j < n
        right[x] = ahead.lce(i[x], j[x])
        x = i > 0
        left[x] = back.lce(n - i[x], n - j[x])  # the words before i and before j, in the reversal
        length = left + p + right
        x = (length >= 2 * p) & (length >= min_length)
        found.append(np.stack([i[x] - left[x], length[x], p[x]], 1))
    out = np.unique(np.concatenate(found), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def segments(codes: np.ndarray, owner: np.ndarray, min_length: int = MIN_LENGTH) -> list[tuple[int, int]]:
    """[start, end) of the stretches that may hold runs; no run reaches beyond one.

    A run of length L >= min_length and period q <= L / 2 has L - q >= k = half of min_length words that recur q words on,
    so each of its words lies in a window of k words that recurs in the run. Words in no window that recurs in their own
    stretch are cut away (at first a stretch is a text), until none is left to cut. Equal windows have equal hashes, so a
    collision only leaves a stretch longer.
    """
    k = (min_length + 1) // 2
    at, stretch = np.arange(codes.size), owner.astype(np.uint64)
    values = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    while at.size >= min_length:
        own = values[at]
        n = at.size - k + 1
        key = np.zeros(n, np.uint64)
        for x in range(k):
            key = key * np.uint64(0xD6E8FEB86659FD93) + own[x: x + n]
        key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) + stretch[:n] * np.uint64(0x94D049BB133111EB)
        whole = np.flatnonzero(stretch[:n] == stretch[k - 1:])
        key = key[whole]
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(whole.size, np.bool_)
        again[order[1:][same]] = again[order[:-1][same]] = True
        cover = np.zeros(at.size + 1, np.int64)
        np.add.at(cover, whole[again], 1)
        np.add.at(cover, whole[again] + k, -1)
        kept = np.cumsum(cover[:-1]) > 0
        at, before = at[kept], at.size
        if not at.size:
            break
        cut = np.concatenate(([True], (np.diff(at) > 1) | (np.diff(stretch[kept].view(np.int64)) != 0)))
        stretch = np.cumsum(cut).astype(np.uint64)
        if at.size == before:
            break
    if at.size < min_length:
        return []
    heads = np.flatnonzero(np.concatenate(([True], stretch[1:] != stretch[:-1])))
    ends = np.concatenate((heads[1:], [at.size]))
    return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(heads, ends) if b - a >= min_length]


def collapse(df: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, keep: tuple[str, ...] | None = None) -> DataFrame:
    """(row, n_words, runs, collapsed) for each row of ``df``: ``row`` is a struct of its columns (all, or ``keep``), so that no name can clash.

    ``runs``: an array of (start, length, period), in words, by start and period. ``collapsed``: the words that no run
    contains after its first period, joined by one space. Null and blank texts have no words, no run and an empty text;
    repeated rows give equal results. No text is cut; a worker holds one bounded slice of texts, and the trees of one
    stretch, at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in slices(batches, "_text", 4 << 20):
            words = [x.encode("utf-8", "surrogatepass").split() for x in texts_of(batch, "_text")]
            sizes = np.array([len(w) for w in words], np.int64)
            offsets = np.concatenate(([0], np.cumsum(sizes)))
            known: defaultdict[bytes, int] = defaultdict(count().__next__)
            codes = np.fromiter((known[w] for one in words for w in one), np.int64, int(offsets[-1]))
            del known
            runs: list[list] = [[] for _ in words]
            owner = np.repeat(np.arange(len(words)), sizes)
            for a, b in segments(codes, owner, min_length):
                found = runs_of(codes[a:b], min_length)
                if len(found):
                    d = int(owner[a])
                    found[:, 0] += a - offsets[d]
                    runs[d].append(found)
            texts, lists = [], []
            for one, found in zip(words, runs):
                if found:
                    all_runs = np.concatenate(found)
                    gone = np.zeros(len(one) + 1, np.int64)
                    np.add.at(gone, all_runs[:, 0] + all_runs[:, 2], 1)
                    np.add.at(gone, all_runs[:, 0] + all_runs[:, 1], -1)
                    one = [one[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]
                    lists.append([dict(zip(("start", "length", "period"), r)) for r in all_runs.tolist()])
                else:
                    lists.append([])
                texts.append(b" ".join(one))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(lists, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["row", "n_words", "runs", "collapsed"])

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep or df.columns]).alias("row"), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return small_batches(rows).mapInArrow(run, schema)


def words_of(text: Column) -> Column:
    trim = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(WHITE))
    return F.when(trim == "", F.array().cast("array<string>")).otherwise(F.split(trim, r"[ \t\n\x0B\f\r]+", -1))


def planted(doc_id: Column, text: Column) -> Column:
    """The contract's text: where crc32(doc_id) % 10 is 0, the words from the a-th on repeat with period p; others stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words, g = words_of(text), F.floor(h / 10)
    n = F.size(words).cast("long")
    a = F.pmod(g, F.nullif(n, F.lit(0)))
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    def word(w: Column, a: Column, p: Column, i: Column) -> Column:
        return F.get(w, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int"))

    made = F.transform(F.array(F.struct(words.alias("w"), a.alias("a"), p.alias("p"), n.alias("n"))),
                       lambda s: F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), s["n"] - 1), lambda i: word(s["w"], s["a"], s["p"], i)), " "))
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), F.get(made, F.lit(0))).otherwise(text)


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document's text (with the contract's planted periods), digests of them and of the collapsed text.

    A null doc_id plants nothing."""
    docs = table(spark, sf_dir, "documents").select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    got = collapse(docs, keep=("doc_id",))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    got = got.withColumn("best", best)
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return got.select(
        "row.doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
