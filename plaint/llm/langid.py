"""Language identification by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton. A text is parsed greedily into the
longest phrases that occur in a language's sample; phrases x log2(sample length) / characters estimates the cross
entropy against that language (a letter that the sample lacks costs LETTER_BITS), and the language with the least wins.
"""
from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import claim, holds, slices, small_batches, table, text_beside, texts_of

#: Bounds of the training sample: documents per language, characters of each, characters over all languages.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_TOTAL = 32, 1000, 512_000
UNKNOWN = "und"
#: What a letter costs that a sample lacks: it has to be told among all code points, not among places of the sample. Without
#: this the shortest sample would win every text in a script that the samples know badly.
LETTER_BITS = 20.1
#: Entries of the transition table, about: as many of the most frequent letters as fit get a column each (16 to 250 of them);
#: transitions by the other letters of the samples are kept as sorted pairs.
TABLE_ENTRIES, MIN_COLUMNS, MAX_COLUMNS = 1 << 24, 16, 250


def training_sample(labelled: DataFrame, docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, total: int = SAMPLE_TOTAL) -> dict[str, list[str]]:
    """{language: excerpts}: per non-null ``lang`` the ``docs`` distinct texts with the smallest hashes, ``chars`` characters of each.

    Over many languages ``docs``, then ``chars``, shrink so that all excerpts stay within ``total`` characters.
    Repeated texts count once; null texts and texts without a letter are left out.
    """
    rows = labelled.select("text", "lang").filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h", 0.03).alias("n")).collect()}
    if not sizes:
        return {}
    docs = max(1, min(docs, total // (chars * len(sizes))))
    chars = max(1, min(chars, total // (docs * len(sizes))))
    # a hash threshold leaves a few times the wanted rows before anything is shuffled
    cuts = labelled.sparkSession.createDataFrame([(k, min(1 << 30, int((1 << 30) * (6 * docs + 20) / max(n, 1)))) for k, n in sizes.items()], "lang string, cut long")
    near = rows.join(F.broadcast(cuts), "lang").filter(F.pmod("h", F.lit(1 << 30)) < F.col("cut"))
    near = near.select("lang", "h", F.pmod("h", F.lit(1 << 30)).alias("k"), F.substring("text", 1, chars).alias("x")).dropDuplicates(["lang", "h"])
    picked = near.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("k", "h"))).filter(F.col("r") <= docs)
    out: dict[str, list[str]] = {}
    for r in picked.select("lang", "r", "x").collect():  # bounded by SAMPLE_TOTAL characters
        out.setdefault(r["lang"], []).append((r["r"], r["x"]))
    return {k: [x for _, x in sorted(v)] for k, v in sorted(out.items())}


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts just the substrings of ``symbols``; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
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
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return go


@functools.lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def _symbols(texts: list[str], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes of all texts in a row, offsets): lower-cased, runs of non-letters as one 0, none at a text's start."""
    lower = [x.lower() for x in texts]
    cls = classes[np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(x) for x in lower], dtype=np.int64)
    before = np.zeros_like(cls)
    before[1:] = cls[:-1]
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    before[starts[starts < cls.size]] = 0
    keep = (cls != 0) | (before != 0)
    kept = np.concatenate(([0], np.cumsum(keep)))
    return cls[keep], np.concatenate(([0], kept[ends]))


class Parser:
    """The automata of all languages in one transition table, walked by many texts in step.

    Every letter of the samples has a class of its own; letters without a column in the table go by sorted (state, class)
    pairs. A letter in no sample has class 1, which matches nowhere.
    An entry holds the next state (times the classes) and how many phrases the step ends: one if a match breaks off,
    one more for a symbol that occurs nowhere in the sample."""

    def __init__(self, sample: dict[str, list[str]]):
        self.langs = sorted(sample)
        letter = _is_letter()
        seen: dict[str, int] = {}
        for xs in sample.values():
            for c in "".join(xs).lower():
                if c.isalpha():
                    seen[c] = seen.get(c, 0) + 1
        self.classes = letter.astype(np.int32)
        for k, c in enumerate(sorted(seen, key=lambda c: (-seen[c], c))):
            self.classes[ord(c)] = 2 + k
        self.kinds = 2 + len(seen)
        self.lacks = np.ones((self.kinds, len(self.langs)), np.bool_)
        built, self.roots, bits, base = [], [], [], 0
        for lang in self.langs:
            flat, offsets = _symbols(sample[lang], self.classes)
            symbols = [c for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for c in [*flat[a:b].tolist(), 0]]
            self.lacks[list({0, *symbols} - {1}), len(bits)] = False
            go = suffix_automaton(symbols)
            p = np.repeat(np.arange(len(go)), [len(x) for x in go])
            c = np.fromiter((c for x in go for c in x), np.int64, p.size)
            q = np.fromiter((q for x in go for q in x.values()), np.int64, p.size)
            built.append((base, len(go), p[c != 1], c[c != 1], q[c != 1]))
            self.roots.append(base)
            bits.append(math.log2(max(2, len(symbols))))
            base += len(go)
        n = self.columns = min(self.kinds, max(MIN_COLUMNS, min(MAX_COLUMNS, TABLE_ENTRIES // max(base, 1))))
        self.table = np.empty((base, n), np.int32 if base * n * 4 < 2**31 else np.int64)
        keys, nexts = [], []
        for first, size, p, c, q in built:
            t = self.table[first: first + size]
            root = np.full(n, -1, np.int64)
            own = (p == 0) & (c < n)
            root[c[own]] = q[own]
            t[:] = np.where(root >= 0, ((first + root) * n) << 2 | 1, (first * n) << 2 | 2)
            t[0] = np.where(root >= 0, ((first + root) * n) << 2, (first * n) << 2 | 1)
            own = c < n
            t[p[own], c[own]] = ((first + q[own]) * n) << 2
            keys.append((first + p[~own]) * self.kinds + c[~own])
            nexts.append((first + q[~own]) * n)
        key, after = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, nexts))
        order = np.argsort(key)
        self.rare, self.after = np.append(key[order], np.int64(-1)), np.append(after[order], np.int64(0))
        self.table = self.table.ravel()
        self.bits, self.roots = np.array(bits), np.array(self.roots, self.table.dtype) * n

    def _step_rare(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, phrases ended) by letters without a column."""
        def find(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            key = at // self.columns * self.kinds + symbol[:, None]
            k = np.searchsorted(self.rare[:-1], key)
            return self.rare[k] == key, self.after[k]

        state = state.astype(np.int64)
        roots = np.broadcast_to(self.roots.astype(np.int64), state.shape)
        on, forward = find(state)
        anew, begun = find(roots)
        ended = np.where(on, 0, np.where(anew, 1, 2) - (state == roots) * 1)
        return np.where(on, forward, np.where(anew, begun, roots)), ended

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases of each text against each language, symbols of each text)."""
        flat, offsets = _symbols(texts, self.classes)
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        at, ordered = offsets[:-1][order], size[order]
        state = np.tile(self.roots, (len(texts), 1))
        count = np.zeros((len(texts), len(self.langs)), np.int64)
        up, longest = -ordered, int(ordered[0]) if len(texts) else 0
        m, table, kind = len(texts), self.table, self.table.dtype
        uncommon = flat >= self.columns
        any_rare = bool(uncommon.any())
        active = np.searchsorted(up, -np.arange(longest), side="left")  # texts longer than t
        for t in range(longest):
            m = active[t]
            symbol = flat[at[:m] + t]
            if any_rare and len(x := np.flatnonzero(uncommon[at[:m] + t])):
                moved, ended = self._step_rare(state[x], symbol[x])
                symbol[x] = 1
            else:
                x = None
            got = table[state[:m] + symbol.astype(kind)[:, None]]
            count_now, state_now = got & 3, got >> 2
            if x is not None:
                count_now[x], state_now[x] = ended, moved
            count[:m] += count_now
            state[:m] = state_now
        count += state != self.roots
        out = np.empty_like(count)
        out[order] = count
        return out, size

    def foreign(self, texts: list[str]) -> np.ndarray:
        """Symbols of each text that a language's sample lacks: each is a phrase of its own there."""
        flat, offsets = _symbols(texts, self.classes)
        sums = np.zeros((flat.size + 1, len(self.langs)), np.int64)
        np.cumsum(self.lacks[flat], axis=0, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ties go to the language that sorts first."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        count, size = self.phrases(texts)
        foreign = self.foreign(texts)
        entropy = ((count - foreign) * self.bits + foreign * LETTER_BITS) / np.maximum(size, 1)[:, None]
        best = entropy.argmin(1)
        rank = np.sort(entropy, 1)
        score = 1 - rank[:, 0] / np.maximum(rank[:, 1], 1e-12) if len(self.langs) > 1 else np.ones(len(texts))
        none = size == 0
        return [UNKNOWN if e else self.langs[b] for b, e in zip(best, none)], np.where(none, 0.0, np.clip(score, 0, 1))


_parsers: dict[str, Parser] = {}


@holds("langid")
def forget() -> None:
    _parsers.clear()


def _parser(key: str, sample: dict[str, list[str]]) -> Parser:
    """One per worker: the automata are built from the small broadcast sample."""
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(sample)
    return _parsers[key]


def identify(df: DataFrame, sample: dict[str, list[str]], text: str = "text", returned: tuple[str, ...] | None = None) -> DataFrame:
    """(row, lang_pred, score) for each row of ``df``: ``row`` is a struct of its columns (or those of ``returned``), so that no name can clash.

    Null text, empty text or text without a letter: ``und``, score 0. The score is the share by which the second-best
    language's entropy exceeds the best one's (1 with a single learned language). Without any labelled text all is ``und``.
    Equal texts get equal answers; texts are parsed whole, however long."""
    key = hashlib.sha1(repr(sample).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(sample)

    columns = list(returned or df.columns)
    at = columns.index(text) if text in columns else None

    def run(batches):
        claim("langid")
        for batch in slices(text_beside(batches, at), limit=4 << 20):
            lang, score = _parser(key, shared.value).predict(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"])

    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    rows = small_batches(df).select(row, *[F.col(f"`{text}`").cast("string").alias("text")] * (at is None))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"row {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """The contract's test rows: crc32 of the id as text leaves 2 when divided by 4 (a null id is not held out)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def train_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows that the contract leaves for training."""
    return docs.filter(~held_out(F.col("doc_id"))).select("text", "lang")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    got = identify(docs.select("doc_id", "text"), training_sample(train_rows(docs)), returned=("doc_id",))
    return got.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
