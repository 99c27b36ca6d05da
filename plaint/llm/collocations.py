"""Phrase collocation mining by best-first branch and bound over phrase prefixes.

A phrase scores, at each cut into a first part and a rest, 1000 * f(phrase) * n / (f(first part) * f(rest)); the least
cut counts. f(phrase) <= f(rest), so no phrase that begins with a prefix can score more than 1000 * n / f(first word
of the prefix). The frontier holds counted prefixes that are not expanded yet. Each round takes those with the best
bounds, of any length, counts their extensions by one word in one pass over the coded corpus, scores what is settled,
and raises each language's threshold to its best ``top``-th surviving score. It ends when no prefix is left whose bound
reaches the threshold of its language, so ties at the threshold are expanded as well.

All counts are aggregated by Spark over all documents and written in the shared folder. Workers learn which prefixes to
extend from a Bloom bitmap of bounded size: what passes it by chance is counted as well, rightly, and is of no harm.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import slices, small_batches, table, texts_of, written

#: Fixed by the contract.
MAX_WORDS, MIN_COUNT, TOP, BREAKS = 5, 100, 2000, ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
#: Rounds widen by this factor in the first word's count, beginning at the least count.
WIDEN = 16
#: No count is larger, and no bound beyond it is a long.
MAX_COUNT = 2**63 - 1
#: Bounds of a Bloom bitmap in bits (16 MB at most), and bits for each entry below the greater one.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 12, 1 << 27, 16
#: Words of a coded row, about; it ends at a break behind them.
ROW_WORDS = 8192

_TABLE = bytes(0xFF if chr(b) in BREAKS else 0x20 if b in (0x20, 0x09) else b + 32 if 65 <= b <= 90 else b for b in range(256))
KEY = ["lang", *(f"w{i}" for i in range(MAX_WORDS))]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _start(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1))


def _extend(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are one word longer; a language's hash begins them."""
    return _mix(key * np.uint64(0x9E3779B97F4A7C15) + word)


class Bitmap:
    """A Bloom bitmap of phrases with two probes; an empty one holds nothing."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(max(64 * words.size, 1) - 1)

    @staticmethod
    def probes(key: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return key & mask, (key >> np.uint64(37)) & mask

    def has(self, key: np.ndarray) -> np.ndarray:
        if not self.words.size:
            return np.zeros(key.size, np.bool_)
        out = np.ones(key.size, np.bool_)
        for p in self.probes(key, self.mask):
            out &= ((self.words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(np.bool_)
        return out


def bitmap_of(phrases: DataFrame) -> Bitmap:
    """The bitmap of phrases (KEY, 0 for no word): ORed together by Spark, at most MOST_BITS / 64 rows come to the driver."""
    entries = phrases.count()
    if not entries:
        return Bitmap(np.zeros(0, np.uint64))
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_EACH * entries - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, of = np.unique(np.array(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True) if batch.num_rows else ([], None)
            if not batch.num_rows:
                continue
            key = np.array([_start(x) for x in langs], np.uint64)[of.ravel()]
            for i in range(MAX_WORDS):
                w = batch.column(1 + i).to_numpy(zero_copy_only=False).view(np.uint64)
                key = np.where(w != 0, _extend(key, w), key)
            p = np.unique(np.concatenate(Bitmap.probes(key, np.uint64(bits - 1))))
            slot, first = np.unique(p >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (p & np.uint64(63)), first)
            yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64)), pa.array(value.view(np.int64))], names=["slot", "bits"])

    made = phrases.select(*KEY).mapInArrow(run, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[made.column(0).to_numpy()] = made.column(1).to_numpy().view(np.uint64)
    return Bitmap(words)


def _numbered(data: bytes) -> tuple[list[bytes], np.ndarray]:
    """(distinct words of the translated ``data``, the words' numbers in text order; -1 for a break)."""
    a = np.frombuffer(data, np.uint8)
    word, cut = a != 0x20, a == 0xFF
    head = word.copy()
    head[1:] &= ~word[:-1] | cut[:-1] | cut[1:]
    starts = (np.cumsum(word, dtype=np.int32) - 1)[head]
    kept = a[word]
    ends = np.append(starts, np.int32(kept.size)).astype(np.int32)
    made = pa.Array.from_buffers(pa.binary(), starts.size, [None, pa.py_buffer(ends), pa.py_buffer(kept)]).dictionary_encode()
    words, ids = made.dictionary.to_pylist(), made.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if b"\xff" in words:
        at = words.index(b"\xff")
        ids = np.where(ids == at, -1, ids - (ids > at))
        del words[at]
    return words, ids


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, distinct words, the words' numbers in text order; -1 for a break) of bounded slices of texts."""
    for batch in slices(batches, "text", 4 << 20):
        groups = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            groups[lang].append(text.encode("utf-8", "surrogatepass"))
        for lang, texts in groups.items():
            yield lang, *_numbered(b"\n".join(texts).translate(_TABLE))


def _hashes(words: list[bytes], seed: int) -> np.ndarray:
    out = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    out[out == 0] = 1  # 0 means no word
    return out


def _texts(docs: DataFrame) -> DataFrame:
    return small_batches(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, w0, word, f) of every word: w0 is its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _by_language(batches):
            n = np.bincount(ids[ids >= 0], minlength=len(words)) if words else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(_hashes(words, seed).view(np.int64)), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                names=["lang", "w0", "word", "n"])

    made = _texts(docs).mapInArrow(run, "lang string, w0 long, word string, n long")
    # sums alone are kept for a word, so both steps aggregate by hash
    got = made.groupBy("lang", "word").agg(F.sum("n").alias("f"), F.max("w0").alias("w0"))
    return got.select("lang", "w0", "word", "f")


def clashes(words: DataFrame) -> bool:
    """Whether two words of a language share a hash."""
    return not words.groupBy("lang", "w0").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def coded(docs: DataFrame, frequent: Bitmap, seed: int) -> DataFrame:
    """(lang, codes): the texts as 64-bit word hashes, 0 where a piece ends or a word is rare. Lone words are left out."""
    frequent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _by_language(batches):
            hashes = _hashes(words, seed)
            hashes[~frequent.value.has(_extend(np.full(hashes.size, _start(lang)), hashes))] = 0
            w = np.append(np.append(hashes, np.uint64(0))[ids], np.uint64(0))  # -1 picks the 0 at the end
            some = w != 0
            before, after = np.append(False, some[:-1]), np.append(some[1:], False)
            some &= before | after
            w = w[some | np.append(False, some[:-1])]  # runs of words, each with the 0 behind it
            ends = np.flatnonzero(w == 0)
            if not ends.size:
                continue
            cuts = ends[np.unique(np.searchsorted(ends, np.arange(ROW_WORDS, w.size + ROW_WORDS, ROW_WORDS)).clip(0, ends.size - 1))] + 1
            rows = [w[a:b].tobytes() for a, b in zip([0, *cuts.tolist()], cuts.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), pa.array(rows, pa.binary())], names=["lang", "codes"])

    return _texts(docs).mapInArrow(run, "lang string, codes binary")


def _groups(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts of groups of equal columns in it): sorted by the hash, and by the columns where a hash is ambiguous."""
    order = np.argsort(key)
    head = np.append(True, key[order][1:] != key[order][:-1])
    differs = np.append(True, reduce(np.logical_or, (c[order][1:] != c[order][:-1] for c in columns)))
    if not np.array_equal(head, differs):
        order = np.lexsort(columns)
        differs = np.append(True, reduce(np.logical_or, (c[order][1:] != c[order][:-1] for c in columns)))
    return order, np.flatnonzero(differs)


def count_phrases(corpus: DataFrame, prefixes: Bitmap, wanted: Bitmap, min_count: int = MIN_COUNT) -> DataFrame:
    """(KEY, f, only_left, only_right) of the phrases that extend a prefix by one word, and of the wanted ones.

    only_left: every occurrence has the same frequent word before it (so a longer phrase has the same count)."""
    ctx = corpus.sparkSession.sparkContext
    prefixes, wanted = ctx.broadcast(prefixes), ctx.broadcast(wanted)
    names = [*KEY, "n", "l0", "l1", "r0", "r1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "codes", 8 << 20):
            groups = defaultdict(list)
            for lang, codes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                groups[lang].append(codes)
            for lang, parts in groups.items():
                w = np.concatenate((np.zeros(1, np.uint64), np.frombuffer(b"".join(parts), np.uint64), np.zeros(MAX_WORDS + 1, np.uint64)))
                at = np.flatnonzero(w)
                key = _extend(np.full(at.size, _start(lang)), w[at])
                for length in range(2, MAX_WORDS + 1):
                    more = w[at + length - 1] != 0
                    at, key = at[more], key[more]
                    longer = _extend(key, w[at + length - 1])
                    picked = np.flatnonzero(prefixes.value.has(key) | wanted.value.has(longer))
                    key = longer
                    if not picked.size:
                        continue
                    p = at[picked]
                    words = [w[p + i] for i in range(length)]
                    order, starts = _groups(key[picked], words)
                    left, right, heads = w[p - 1][order].view(np.int64), w[p + length][order].view(np.int64), order[starts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * starts.size, pa.string()), *(pa.array(words[i][heads].view(np.int64) if i < length else np.zeros(starts.size, np.int64)) for i in range(MAX_WORDS)),
                         pa.array(np.diff(np.append(starts, p.size))), *(pa.array(f.reduceat(x, starts)) for x in (left, right) for f in (np.minimum, np.maximum))], names=names)

    made = small_batches(corpus).mapInArrow(run, "lang string, " + ", ".join(f"{x} long" for x in names[1:]))
    got = made.groupBy(*KEY).agg(F.sum("n").alias("f"), F.min("l0").alias("l0"), F.max("l1").alias("l1"), F.min("r0").alias("r0"), F.max("r1").alias("r1"))
    only = [((F.col(f"{s}0") == F.col(f"{s}1")) & (F.col(f"{s}0") != 0)).alias(name) for s, name in (("l", "only_left"), ("r", "only_right"))]
    return got.filter(F.col("f") >= min_count).select(*KEY, "f", *only)


def _length() -> Column:
    return sum((F.col(f"w{i}") != 0).cast("int") for i in range(1, MAX_WORDS)) + 1


def _cuts(phrases: DataFrame) -> DataFrame:
    """A row for each cut of each phrase: k, and the keys l0.. of the first part and r0.. of the rest."""
    w = [F.col(f"w{i}") for i in range(MAX_WORDS)]
    zero = F.lit(0).cast("long")
    cuts = []
    for k in range(1, MAX_WORDS):
        first = [w[i] if i < k else zero for i in range(MAX_WORDS)]
        rest = [w[i + k] if i + k < MAX_WORDS else zero for i in range(MAX_WORDS)]
        cut = F.struct(F.lit(k).alias("k"), *[c.alias(f"l{i}") for i, c in enumerate(first)], *[c.alias(f"r{i}") for i, c in enumerate(rest)])
        cuts.append(F.when(w[k] != 0, cut))
    return phrases.select("*", F.explode(F.filter(F.array(*cuts), lambda c: c.isNotNull())).alias("cut")).select("*", "cut.*").drop("cut")


def _score(a: str, n: str, left: str, right: str) -> Column:
    """floor(1000 a n / (l r)), exactly: products have 38 digits."""
    return F.expr(f"(cast({a} as decimal(19,0)) * cast(1000 * {n} as decimal(19,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def _settle(pending: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pending phrases with ``score``, ``k``, ``l``, ``r`` of the least known cut and ``open``: cuts lacking a count; the lacking rests)."""
    part = [F.col("f"), F.col("lang").alias("part_lang")]
    left = known.select(*part, *[F.col(f"w{i}").alias(f"l{i}") for i in range(MAX_WORDS)]).withColumnsRenamed({"f": "l", "part_lang": "left_lang"})
    right = known.select(*part, *[F.col(f"w{i}").alias(f"r{i}") for i in range(MAX_WORDS)]).withColumnsRenamed({"f": "r", "part_lang": "right_lang"})
    rows = _cuts(pending)
    rows = rows.join(left, [rows["lang"] == left["left_lang"], *(rows[f"l{i}"] == left[f"l{i}"] for i in range(MAX_WORDS))], "left").select(rows["*"], "l")
    rows = rows.join(right, [rows["lang"] == right["right_lang"], *(rows[f"r{i}"] == right[f"r{i}"] for i in range(MAX_WORDS))], "left").select(rows["*"], "r")
    rows = rows.withColumn("cut_score", _score("f", "n", "l", "r"))
    best = F.min(F.when(F.col("cut_score").isNotNull(), F.struct("cut_score", "k", "l", "r")))
    lack = F.collect_list(F.when(F.col("r").isNull(), F.struct(*[F.col(f"r{i}") for i in range(MAX_WORDS)])))
    out = rows.groupBy(*KEY, "f", "n", "f1").agg(best.alias("best"), F.count_if(F.col("cut_score").isNull()).alias("open"), lack.alias("lack"))
    return out.select(*KEY, "f", "n", "f1", F.col("best.cut_score").alias("score"), "best.l", "best.r", "open", "lack")


def _thresholds(scored: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """(lang, n, tau): the ``top``-th best score so far, 0 while there are fewer."""
    ranked = scored.select("lang", "score").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("score").desc()))).filter(F.col("rank") <= top)
    tau = ranked.filter(F.col("rank") == top).select("lang", F.col("score").alias("tau"))
    return totals.join(tau, "lang", "left").select("lang", "n", F.coalesce("tau", F.lit(0).cast("long")).alias("tau"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's best phrases of 2 to 5 words.

    ``docs`` needs ``lang`` and ``text``; further columns are ignored. Null lang counts as ``und``, null text as empty;
    repeated rows count as often as they occur; an empty table or one without frequent phrases gives no row. A phrase
    goes if a longer one that holds it has the same count. Equal scores are ranked by count, then by the phrase's bytes.
    """
    spark = docs.sparkSession
    seed = 0
    while True:
        every = written(word_counts(docs, seed), "words")
        if not clashes(every):
            break
        seed += 1  # two words of a language share a hash: count with another one
    totals = written(every.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    zero = F.lit(0).cast("long")
    words = written(every.filter(F.col("f") >= min_count).select("lang", "w0", *[zero.alias(f"w{i}") for i in range(1, MAX_WORDS)], "f", "word"), "frequent")
    corpus = written(coded(docs, bitmap_of(words), seed), "coded")
    first = words.join(totals, "lang").select("lang", "w0", F.col("f").alias("f1"), "n")
    nodes = words.select(*KEY, "f", F.col("f").alias("f1")).join(totals, "lang")
    limits = totals.withColumn("tau", zero)
    phrases: list[DataFrame] = []
    scored: list[DataFrame] = []
    pending = lacking = None
    reach = min_count
    while True:
        # the frontier: counted prefixes, not expanded, whose bound reaches the threshold; the best bounds go first
        live = written(nodes.join(limits.select("lang", "tau"), "lang").filter(F.expr("(1000 * n) div f1 >= tau")).drop("tau"), "frontier")
        least = live.agg(F.min("f1")).first()[0]
        if least is None and lacking is None:
            break
        if least is not None:
            while reach <= least:
                reach = min(reach * WIDEN, MAX_COUNT)
        chosen, rest = live.filter(F.col("f1") < reach), live.filter(F.col("f1") >= reach)
        reach = min(reach * WIDEN, MAX_COUNT)
        wanted = bitmap_of(lacking) if lacking is not None else Bitmap(np.zeros(0, np.uint64))
        found = count_phrases(corpus, bitmap_of(chosen), wanted, min_count)
        found = found.join(first, ["lang", "w0"]).select(*KEY, "f", "f1", "n", "only_left", "only_right")
        if phrases:  # those that were wanted before
            found = found.join(reduce(DataFrame.unionByName, phrases).select(*KEY), KEY, "left_anti")
        found = written(found, "phrases")
        phrases.append(found)
        more = _length() < MAX_WORDS
        nodes = rest.unionByName(found.filter(more).select(*rest.columns))
        fresh = found.filter(~more | ~(F.col("only_left") | F.col("only_right"))).select(*KEY, "f", "n", "f1")
        pending = fresh if pending is None else pending.select(*fresh.columns).unionByName(fresh)
        known = reduce(DataFrame.unionByName, [p.select(*KEY, "f") for p in phrases], words.select(*KEY, "f"))
        held = pending.join(limits.select("lang", "tau"), "lang").filter(F.expr("(1000 * n) div f1 >= tau")).drop("tau")
        settled = written(_settle(held, known), "settled")
        scored.append(settled.filter(F.col("open") == 0).select(*KEY, "f", "n", "l", "r", "score"))
        limits = written(_thresholds(reduce(DataFrame.unionByName, scored), totals, top), "limits")
        pending = settled.filter(F.col("open") > 0).join(limits.select("lang", "tau"), "lang").filter(F.coalesce(F.col("score") >= F.col("tau"), F.lit(True)))
        lacking = written(pending.select("lang", F.explode("lack").alias("x")).select("lang", *[F.col(f"x.r{i}").alias(f"w{i}") for i in range(MAX_WORDS)]).distinct(), "lacking")
        lacking = None if lacking.isEmpty() else lacking
    columns = [*KEY, "f", "n", "l", "r", "score"]
    best = reduce(DataFrame.unionByName, scored).select(*columns) if scored else None
    if best is None:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    best = best.join(limits.select("lang", "tau"), "lang").filter(F.col("score") >= F.col("tau")).drop("tau")
    named = best.select("*", F.posexplode(F.array(*[F.col(f"w{i}") for i in range(MAX_WORDS)])).alias("at", "h")).filter(F.col("h") != 0)
    named = named.join(words.select(F.col("lang"), F.col("w0").alias("h"), "word"), ["lang", "h"])
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    rows = named.groupBy(*columns).agg(phrase.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), "phrase")
    rows = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 best phrases over all documents."""
    return collocations(table(spark, sf_dir, "documents"))


_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS m, unnest([array_to_string(w[i:i+{k - 1}], ' ') for i in generate_series(1, len(w) - {k - 1})]) AS phrase FROM pieces WHERE len(w) >= {k}" for k in range(1, MAX_WORDS + 1))
_CUTS = " UNION ALL ".join(f"SELECT lang, phrase, m, a, {k} AS k, array_to_string(w[1:{k}], ' ') AS first, array_to_string(w[{k + 1}:], ' ') AS rest FROM split WHERE m > {k}" for k in range(1, MAX_WORDS))
#: Every phrase counted, every candidate compared with its one-word extensions (a longer phrase with the same count has one between).
OP13_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM texts),
counts AS (SELECT lang, m, phrase, count(*) AS a FROM ({_GRAMS}) GROUP BY ALL),
frequent AS (SELECT * FROM counts WHERE a >= {MIN_COUNT}),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM frequent WHERE m >= 2),
gone AS (SELECT DISTINCT s.lang, s.phrase FROM (
    SELECT lang, m, a, array_to_string(w[1:m-1], ' ') AS part FROM split UNION ALL SELECT lang, m, a, array_to_string(w[2:], ' ') FROM split) x
  JOIN frequent s ON s.lang = x.lang AND s.phrase = x.part AND s.m = x.m - 1 AND 100 * x.a::HUGEINT >= 100 * s.a::HUGEINT),
cuts AS ({_CUTS}),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.a AS l, q.a AS r, t.n, (1000::HUGEINT * c.a * t.n) // (p.a::HUGEINT * q.a) AS score
  FROM cuts c JOIN frequent p ON p.lang = c.lang AND p.phrase = c.first AND p.m = c.k
  JOIN frequent q ON q.lang = c.lang AND q.phrase = c.rest AND q.m = c.m - c.k JOIN totals t ON t.lang = c.lang
  WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.lang = c.lang AND g.phrase = c.phrase)),
least AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM least)
WHERE rank <= {TOP}"""
