"""Substring dedup: words in windows that an earlier document has are removed, by suffix automata over shards of the reference.

The reference is the corpus itself, so its automaton has no size bound and can't be broadcast; instead the reference
is cut into shards that hold together whatever can match. Each window's least 5-word gram (by hash) is its anchor;
consecutive windows with one anchor make a run, and equal windows always meet in the shard of their anchor. Runs whose
anchor only one document has can't match and are dropped first; runs that repeat an earlier one word by word are known
to match. For the rest a shard streams its runs in ascending order of documents through a suffix automaton of what
came before: matching statistics of ``window`` words or more are the maximal spans to remove. Runs of an anchor that very
many share (the edges of a common passage, where each run reaches into its document's own words) are cut into windows,
each a shard of its own.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import claim, holds, slices, small_batches, table, texts_of, word_ranges, written

WINDOW, GRAM = 13, 5
#: Runs gathered in a task before equal ones are folded.
FOLD_ROWS = 300_000
#: Runs of one anchor that may meet in one automaton; with more, each of their windows is a shard of its own.
MANY_RUNS = 1000
#: Windows that a task remembers to tell repeats before the shuffle.
SEEN_WINDOWS = 100_000
B1, B2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_power_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(base^i, base^-i) modulo 2^64 for i < size; one pair of tables a base, grown as needed up to four million entries."""
    if base not in _power_tables or _power_tables[base][0].size < size:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.cumprod(x))
        if size > 1 << 22:  # a very long text; not kept
            return out[0], out[1]
        _power_tables[base] = (out[0], out[1])
    return _power_tables[base]


@holds("substrings")
def forget() -> None:
    _power_tables.clear()


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A hash of values[start:end] for every range, from sums of one polynomial."""
    power, inverse = _powers(base, 1 << max(1, int(values.size)).bit_length())
    sums = np.zeros(values.size + 1, np.uint64)
    np.cumsum(values * power[: values.size], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def runs_of(texts: list[str], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, anchor hash, hash of the run's words, first window, windows) of every run of the texts."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(raw)
    a, starts, ends = word_ranges(data)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
    if starts.size < window:
        return none
    word = _range_hashes(a.astype(np.uint64) + np.uint64(1), starts, ends, B1)
    text_ends = np.cumsum([len(x) + 1 for x in raw])
    owner = np.searchsorted(text_ends, starts, side="right")
    g = np.zeros(word.size - gram + 1, np.uint64)
    for i in range(gram):
        g = g * np.uint64(B2) + word[i: word.size - gram + 1 + i]
    g = _mix(g)
    n, wide = word.size - window + 1, window - gram + 1
    least = g[:n].copy()
    for j in range(1, wide):
        np.minimum(least, g[j: j + n], out=least)
    at = np.zeros(n, np.int64)
    for j in range(wide - 1, -1, -1):  # the first of equal ones
        at = np.where(g[j: j + n] == least, np.arange(j, j + n), at)
    whole = owner[:n] == owner[window - 1:]
    key = np.where(whole, at, -1)
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (owner[1:n] != owner[: n - 1]))))
    size = np.diff(np.append(first, n))
    ok = whole[first]
    first, size = first[ok], size[ok]
    if not first.size:
        return none
    run = _range_hashes(word, first, first + size + window - 1, B2)
    text_first = np.searchsorted(owner, np.arange(len(texts)), side="left")
    return owner[first], g[key[first]], run, first - text_first[owner[first]], size


RUN = "shard long, known int, anchor long, run long, doc_id long, first int, size int"


def _run_batch(doc: np.ndarray, anchor: np.ndarray, run: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Runs as rows. A run that repeats one of a smaller doc_id in this batch is known to match and needn't meet its shard: however
    many copies there are, a batch sends one run to it; known ones are spread evenly."""
    order = np.lexsort((first, doc, run, anchor))
    doc, anchor, run, first, size = doc[order], anchor[order], run[order], first[order], size[order]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (run[1:] != run[:-1])))
    least = doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    known = doc > least
    spread = _mix(doc.view(np.uint64) * np.uint64(B1) + first.astype(np.uint64))
    shard = np.where(known, spread, anchor)
    cols = [shard.view(np.int64), known.astype(np.int32), anchor.view(np.int64), run.view(np.int64), doc, first.astype(np.int32), size.astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[x.split()[0] for x in RUN.split(", ")])


def runs(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """The runs of each row of ``df`` (doc_id, text); rows without doc_id are neither reference nor searched."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("substrings")
        held: list[tuple] = []
        n = 0
        for batch in slices(batches, limit=1 << 20):
            doc = batch.column(0).to_numpy()
            owner, *rest = runs_of(texts_of(batch), window)
            held.append((doc[owner], *rest))
            n += owner.size
            if n > FOLD_ROWS:
                yield _run_batch(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if n:
            yield _run_batch(*map(np.concatenate, zip(*held)))

    return small_batches(df).filter("doc_id is not null").mapInArrow(make, RUN)


def candidates(found: DataFrame) -> DataFrame:
    """(known, anchor, doc_id, first, size): runs known to match an earlier document (known = 1) and those that may match in part.

    Rows of a shard are read in order of (known, anchor, run, doc_id), so a run repeats if the run before is the same; a run is worth a
    search if its anchor has another one. Only the current anchor's first run waits, whatever the anchor's size."""
    kind = "known int, anchor long, doc_id long, first int, size int"

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # (anchor, run, least doc_id) of the last row
        waiting: list[tuple] = []  # rows of the last anchor's only run so far that aren't known to match
        for batch in batches:
            if not batch.num_rows:
                continue
            known, anchor, run, doc, first, size = (c.to_numpy() for c in batch.columns)
            free = known == 0
            new_anchor = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (known[1:] != known[:-1])))
            new_run = new_anchor | np.concatenate(([True], run[1:] != run[:-1]))
            goes_on = last is not None and free[0] and last[0] == anchor[0]
            least = doc[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
            if goes_on and last[1] == run[0]:
                head = np.cumsum(new_run) == 1
                least[head] = last[2]
            matched = ~free | (doc > least)
            group = np.cumsum(new_anchor) - 1
            several = np.bincount(group, weights=new_run)[group] > 1
            if goes_on:
                same = last[1] == run[0] and not several[0]
                if same and last[3]:
                    several[group == 0] = True
                elif not same:  # the anchor has a second run now
                    several[group == 0] = True
                    if waiting:
                        yield _candidate_batch(*(np.array(c, t) for c, t in zip(zip(*waiting), (np.int32, np.int64, np.int64, np.int32, np.int32))))
                        waiting = []
            else:
                waiting = []
            tail = group == group[-1]
            if free[-1] and not several[-1]:  # the last anchor may go on in the next batch
                w = np.flatnonzero(tail & ~matched)
                waiting = (waiting if goes_on and group[-1] == 0 else []) + list(zip(known[w].tolist(), anchor[w].tolist(), doc[w].tolist(), first[w].tolist(), size[w].tolist()))
            else:
                waiting = []
            last = (anchor[-1], run[-1], least[-1], bool(several[-1])) if free[-1] else None
            out = matched | several
            if out.any():
                yield _candidate_batch(matched[out].astype(np.int32), anchor[out], doc[out], first[out], size[out])

    rows = found.repartition("shard").sortWithinPartitions("known", "anchor", "run", "doc_id")
    return rows.select("known", "anchor", "run", "doc_id", "first", "size").mapInArrow(resolve, kind)


def _candidate_batch(*cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["known", "anchor", "doc_id", "first", "size"])


class Automaton:
    """A suffix automaton of several sequences, grown one after the other."""

    def __init__(self):
        self.go: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, symbols: list) -> None:
        go, link, length = self.go, self.link, self.length

        def copy(p: int, q: int, c) -> int:
            k = len(go)
            go.append(dict(go[q]))
            length.append(length[p] + 1)
            link.append(link[q])
            link[q] = k
            while p >= 0 and go[p].get(c) == q:
                go[p][c] = k
                p = link[p]
            return k

        last = 0
        for c in symbols:
            q = go[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else copy(last, q, c)
                continue
            cur = len(go)
            go.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in go[p]:
                go[p][c] = cur
                p = link[p]
            if p >= 0:
                q = go[p][c]
                link[cur] = q if length[q] == length[p] + 1 else copy(p, q, c)
            last = cur

    def matches(self, symbols: list, window: int) -> list[int]:
        """The starts of the windows of ``symbols`` that occur in the sequences: where the longest match is ``window`` or longer."""
        go, link, length = self.go, self.link, self.length
        state = size = 0
        out = []
        for i, c in enumerate(symbols):
            while state and c not in go[state]:
                state = link[state]
                size = length[state]
            if c in go[state]:
                state = go[state][c]
                size += 1
            else:
                size = 0
            if size >= window:
                out.append(i - window + 1)
        return out


def search(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, first, size): spans of windows that a smaller doc_id of the same anchor has; ``pieces`` are (anchor, doc_id, first, words).
    Null words stand for one window that is known to match."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, doc_here = None, None
        automaton, later = Automaton(), {}
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for anchor, doc, first, words in zip(*(c.to_pylist() for c in batch.columns)):
                if words is None:
                    out.append((doc, first, 1))
                    continue
                if anchor != here:
                    here, doc_here, automaton, later = anchor, doc, Automaton(), {}
                elif doc != doc_here:  # a document is reference only for later ones
                    for x in later.values():
                        automaton.add(x)
                    doc_here, later = doc, {}
                symbols = words.split(" ")
                got = automaton.matches(symbols, window)
                for k in got:
                    if out and out[-1][0] == doc and out[-1][1] + out[-1][2] == first + k:
                        out[-1] = (doc, out[-1][1], out[-1][2] + 1)
                    else:
                        out.append((doc, first + k, 1))
                if len(got) < len(symbols) - window + 1:
                    later[words] = symbols
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32())], names=["doc_id", "first", "size"])

    rows = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "first")
    return rows.select("anchor", "doc_id", "first", "words").mapInArrow(run, "doc_id long, first int, size int")


def _words(text: str) -> list[str]:
    return [x.decode("utf-8", "surrogatepass") for x in text.encode("utf-8", "surrogatepass").split()]


def _cut_pieces(joined: DataFrame, window: int) -> DataFrame:
    """(anchor, doc_id, first, words) for the runs of each text.

    A run with ``many`` is cut into windows, each with a hash of all its words as its anchor, so that equal windows meet whatever runs
    they are in. A window that this task has seen in a smaller doc_id, word by word, goes on without words: known to match, spread evenly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}  # window -> least doc_id
        for batch in slices(batches, limit=2 << 20):
            out: list[tuple] = []
            for doc, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                w = _words(text or "")
                for x in found:
                    anchor, first, size = x["anchor"], x["first"], x["size"]
                    if not x["many"]:
                        out.append((anchor, doc, first, " ".join(w[first: first + size + window - 1])))
                        continue
                    for k in range(first, first + size):
                        words = " ".join(w[k: k + window])
                        if seen.get(words, doc) < doc:
                            out.append((hash((doc, k)), doc, k, None))
                            continue
                        if len(seen) >= SEEN_WINDOWS:
                            seen.clear()
                        seen[words] = doc
                        digest = hashlib.blake2b(words.encode("utf-8", "surrogatepass"), digest_size=8).digest()
                        out.append((int.from_bytes(digest, "little", signed=True), doc, k, words))
            if out:
                a, d, f, x = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(d, pa.int64()), pa.array(f, pa.int32()), pa.array(x, pa.string())], names=["anchor", "doc_id", "first", "words"])

    return joined.select("doc_id", "text", "found").mapInArrow(run, "anchor long, doc_id long, first int, words string")


def _pieces(df: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """The pieces to search for the ``found`` runs that may match in part."""
    partly = found.filter("known = 0")
    # at most one row per MANY_RUNS runs
    many = partly.groupBy("anchor").count().filter(F.col("count") > MANY_RUNS).select("anchor", F.lit(True).alias("many"))
    partly = partly.join(F.broadcast(many), "anchor", "left").withColumn("many", F.col("many").isNotNull())
    per_text = partly.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "first", "size", "many")).alias("found"))
    return _cut_pieces(df.join(per_text, "doc_id"), window)


def spans(df: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, first, size): every span of windows (numbers of their first words) that a document with a smaller id has too."""
    found = written(candidates(runs(df, window)), "candidates")
    return found.filter("known = 1").select("doc_id", "first", "size").union(search(_pieces(df, found, window), window))


def remove_repeats(df: DataFrame, window: int = WINDOW, keep_columns: tuple[str, ...] = ("doc_id",), as_is: bool = False) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256, kept) for each row of ``df`` (doc_id, text); ``kept`` are the kept words joined by a
    space (with ``as_is`` a text that loses none is returned as it is), ``row`` is a struct of ``keep_columns``, so that no name can clash.

    A word is removed if a window of ``window`` words over it also starts in a document with a smaller doc_id; all is judged on
    the input. Null or empty texts have no words. A doc_id stands for one text: rows that repeat an id must repeat the text, and
    never remove each other's words. Rows without doc_id are returned whole."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = written(spans(docs, window), "spans").groupBy("doc_id").agg(F.collect_list(F.struct("first", "size")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=2 << 20):
            n_words, n_removed, digests, kept = [], [], [], []
            for text, got in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                w = (text or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(w))
                if got:
                    change = np.zeros(len(w) + 1, np.int32)
                    at = np.array([x["first"] for x in got])
                    np.add.at(change, at, 1)
                    np.add.at(change, at + np.array([x["size"] for x in got]) + window - 1, -1)
                    stay = (np.cumsum(change)[:-1] == 0).tolist()
                    w = [x for x, s in zip(w, stay) if s]
                n_removed.append(n_words[-1] - len(w))
                joined = b" ".join(w)
                digests.append(hashlib.sha256(joined).hexdigest())
                kept.append(text if as_is and len(w) == n_words[-1] else joined.decode("utf-8", "replace"))
            cols = [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "n_words", "n_removed", "kept_sha256", "kept"])

    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep_columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = rows.join(marked, "doc_id", "left").select("row", "text", "spans")
    return joined.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, kept string")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that a window shared with an earlier document covers, removed."""
    return remove_repeats(table(spark, sf_dir, "documents")).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
m AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
hit AS (
  SELECT DISTINCT win.doc_id, win.i + r.j AS p FROM win JOIN m ON win.k = m.k AND m.least < win.doc_id CROSS JOIN range(0, 13) r(j)),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT words.doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY words.p) AS t
  FROM words LEFT JOIN hit ON hit.doc_id = words.doc_id AND hit.p = words.p WHERE hit.p IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
