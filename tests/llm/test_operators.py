"""The training-data operators against brute-force versions, round trips and edge rows."""
import base64
import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plaint.llm import bpe, chunks, html_text, langid, packing, quality, records, simhash, substrings, syncmers, warc
from plaint.llm.common import fresh_folder, table, written

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Null id, null text, empty text, white space, one character, a long text, ties and repeated rows.
EDGES = [
    (None, "a text without an id that is a little longer than the others are"), (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "y " * 30_000),
    (6, "Same words here, again."), (6, "Same words here, again."), (7, "Same words here, again."), (8, "naïve ΑΣ  été 日本語 'll don't 123"), (9, "\x00 odd \x85 text"),
]
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def edges(spark):
    """Rows with other columns named like those that operators make."""
    df = spark.createDataFrame(EDGES, DOCS)
    for name in ("row", "score", "lang_pred", "h", "fp", "key", "part", "n_words", "spans", "kept", "_t", "_w", "anchor", "length"):
        df = df.withColumn(name, F.lit("clash"))
    return df.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS + ", lang string, source string, n_chars long")


# language ID

def test_cross_parsing_counts_longest_matches():
    sample = {"a": ["abab abab cd"], "b": ["xyz xyz"]}
    parser = langid.Parser(sample)

    def brute(text, train):
        text, train, i, n = " ".join(re.findall(r"\w+", text)), " ".join(re.findall(r"\w+", train)) + " ", 0, 0
        while i < len(text):
            k = 0
            while i + k < len(text) and text[i: i + k + 1] in train:
                k += 1
            i, n = i + max(1, k), n + 1
        return n

    texts = ["abab cd", "cdcd xy", "zzq ab", "q", "abc"]
    got, _ = parser.phrases(texts)
    assert got.tolist() == [[brute(t, "abab abab cd"), brute(t, "xyz xyz")] for t in texts]


def test_letters_without_a_column_walk_alike(monkeypatch):
    rng = random.Random(8)
    alphabet = [chr(0x4E00 + k) for k in range(400)]
    sample = {k: ["".join(rng.choice(part) for _ in range(300)) for _ in range(4)] for k, part in (("a", alphabet[:250]), ("b", alphabet[150:]), ("c", list("abcdef ")))}
    texts = ["".join(rng.choice(alphabet + list("abc z")) for _ in range(rng.randint(0, 80))) for _ in range(60)] + [sample["a"][0][20:90]]
    wide = langid.Parser(sample).phrases(texts)[0]
    for name in ("MIN_COLUMNS", "MAX_COLUMNS"):
        monkeypatch.setattr(langid, name, 5)
    narrow = langid.Parser(sample)
    assert narrow.columns == 5 and np.array_equal(narrow.phrases(texts)[0], wide)


def test_two_languages_in_one_large_script(spark):
    rng = random.Random(2)
    letters = [chr(0x4E00 + k) for k in range(4000)]

    def text(lang, n):
        part = letters[:2200] if lang == "x" else letters[1800:]
        return "".join(part[int(rng.betavariate(1, 3) * len(part))] for _ in range(n))

    rows = [(k, text(k, 400)) for k in ("x", "y") for _ in range(60)] + [("en", "the words of an english text are here again and again")] * 3
    sample = langid.training_sample(spark.createDataFrame(rows, "lang string, text string"))
    asked = [(k, text(k, 120)) for k in ("x", "y") for _ in range(100)]
    got = langid.Parser(sample).predict([t for _, t in asked])[0]
    assert np.mean([a == k for a, (k, _) in zip(got, asked)]) >= 0.95


def test_language_of_held_out_documents(spark):
    got = langid.op1_langid(spark, "/root/testdata/sf0.01").filter("held_out").join(table(spark, "/root/testdata/sf0.01", "documents"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98


def test_language_edges(spark, edges, nothing):
    sample = {"en": ["the words here are the same again"], "fr": ["les mots sont encore ici"]}
    got = langid.identify(edges, sample)
    rows = got.select("row.doc_id", "lang_pred", "score", "row.score").toDF("doc_id", "lang", "score", "kept").collect()
    assert len(rows) == len(EDGES) and all(r.kept == "clash" and 0 <= r.score <= 1 for r in rows)
    assert all(r.lang == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert len({(r.lang, r.score) for r in rows if r.doc_id in (6, 7)}) == 1
    assert langid.identify(nothing, sample).count() == 0
    assert langid.training_sample(nothing) == {}
    assert {r.lang_pred for r in langid.identify(edges, {}).collect()} == {"und"}
    bounded = langid.training_sample(table(spark, SF, "documents").unionByName(edges.select("doc_id", "text", "lang", "source", "n_chars")), docs=3, chars=50)
    assert all(len(x) <= 3 and max(map(len, x)) <= 50 for x in bounded.values())


# quality rules

def brute_stats(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    inside = {j for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_statistics_equal_brute_force(spark, docs, edges, nothing):
    rows = [(i, " ".join(random.Random(i).choices("abcd\n", k=i * 3))) for i in range(60)]
    for df in (docs.select("doc_id", "text"), edges, spark.createDataFrame(rows, DOCS)):
        got = quality.with_stats(df).select("row.text", *quality.BASE).collect()
        assert len(got) == df.count()
        assert all(tuple(r)[1:] == brute_stats(r.text) for r in got)
    assert quality.with_stats(nothing).count() == 0


def test_decision_list_is_learned_and_becomes_an_expression(spark, docs, nothing):
    rng = random.Random(5)
    rows = []
    for i in range(600):
        x = {f: rng.random() for f in quality.FEATURES}
        rows.append(x | {"bad": x["symbol_share"] > 0.7 or (x["mark_share"] > 0.5 and x["upper_share"] > 0.5)})
    rules = quality.learn_rules(rows)
    said = [any(r.matches(x) for r in rules) for x in rows]
    assert sum(s == x["bad"] for s, x in zip(said, rows)) >= 0.97 * len(rows)
    assert sum(s and not x["bad"] for s, x in zip(said, rows)) <= 0.02 * len(rows)
    assert quality.learn_rules([]) == [] and quality.learn_rules([x for x in rows if x["bad"]]) == []
    stats = quality.with_stats(docs.select("doc_id", "text"))
    rule = quality.Rule((("symbol_share", ">", 0.05), ("n_words", "<=", 100.0)))
    rows = stats.select("n_words", "n_symbols", "word_chars", quality.verdict([rule]).alias("ok")).collect()
    assert all(r.ok == (not (r.word_chars and r.n_symbols / r.word_chars > 0.05 and r.n_words <= 100)) for r in rows)
    assert quality.fit(nothing, spark.createDataFrame([], "doc_id long, quality int")) == []
    nodes = quality.op9_quality(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", nodes)


# SimHash

def test_golay_keys_meet_within_two_bits_and_links_within_four():
    rng = random.Random(1)
    words = [rng.getrandbits(23) for _ in range(3000)]
    near = [w ^ sum(1 << b for b in rng.sample(range(23), rng.randint(0, 2))) for w in words]
    a, b = simhash.segment_keys(np.array(words)), simhash.segment_keys(np.array(near))
    assert all({*x} & {*y} - {-1} for x, y in zip(a.tolist(), b.tolist()))
    fp = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    moved = fp.copy()
    for i in range(fp.size):
        for bit in rng.sample(range(64), 4):
            moved[i] ^= np.uint64(1 << bit)
    (ka, oa), (kb, ob) = simhash.fuzzy_keys(fp), simhash.fuzzy_keys(moved)
    assert {o for _, o in set(zip(ka.tolist(), oa.tolist())) & set(zip(kb.tolist(), ob.tolist()))} == set(range(fp.size))


def brute_components(pairs):
    ids = sorted(pairs)
    least = {i: i for i in ids}

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if (pairs[i] ^ pairs[j]).bit_count() <= 4 and find(i) != find(j):
                least[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}


def test_components_equal_brute_force(spark, docs):
    import xxhash

    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.op4_simhash(spark, SF).collect()}

    def fingerprint(text):
        w = [x.encode().lower().decode() for x in WORD.findall(text or "")]
        grams = [" ".join(w[i: i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = {r.doc_id: fingerprint(r.text) for r in docs.collect()}
    assert {k: f for k, (f, _) in got.items()} == want
    assert {k: c for k, (_, c) in got.items()} == brute_components(want)


def test_links_hold_in_small_buckets_and_blocks(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    comp = simhash.components(simhash.links(df, bucket_rows=20))
    roots = {r.node: r.root for r in comp.collect()}
    want = brute_components(dict(enumerate(fps)))
    groups = {}
    for i, c in want.items():
        groups.setdefault(c, set()).add(signed[i])
    got = {}
    for f in signed:
        got.setdefault(roots.get(f, f), set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_simhash_edges(edges, nothing):
    rows = simhash.near_duplicates(edges).collect()
    assert len(rows) == len(EDGES)
    by = {r.doc_id: r for r in rows}
    assert by[1].fp == by[2].fp == by[3].fp == 0 and by[3].component_id == 1
    assert by[6].component_id == by[7].component_id == 6
    assert simhash.near_duplicates(nothing).count() == 0


# substring dedup

def brute_removal(docs):
    first = {}
    for k, t in sorted(docs):
        for i in range(len(t) - 12):
            first.setdefault(tuple(t[i: i + 13]), k)
    out = {}
    for k, t in docs:
        gone = {j for i in range(len(t) - 12) if first[tuple(t[i: i + 13])] < k for j in range(i, i + 13)}
        out[k] = (len(t), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(t) if i not in gone).encode()).hexdigest())
    return out


@pytest.mark.parametrize("batch", [5, 10_000])
def test_removed_words_equal_brute_force(spark, batch):
    rng = random.Random(batch)
    words = [f"w{i}" for i in range(40)]
    passages = [[rng.choice(words) for _ in range(rng.randint(10, 40))] for _ in range(6)]
    rows = []
    for i in range(120):
        t = [w for _ in range(rng.randint(0, 4)) for w in (rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randint(1, 25))])]
        if rows and rng.random() < 0.2:
            t = list(rng.choice(rows)[1])
        if t and rng.random() < 0.2:
            t[rng.randrange(len(t))] = "X"
        rows.append((i * 3, t))
    df = spark.createDataFrame([(k, " \n".join(t)) for k, t in rows], DOCS).repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = substrings.remove_repeats(df).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_removal(rows)
    assert {r.doc_id: tuple(r)[1:] for r in got} == want and sum(v[1] for v in want.values())


def test_common_passage_inside_unique_texts(spark, monkeypatch):
    """The runs at a passage's edges reach into each document's own words and share an anchor: they may not all meet in one automaton."""
    n, passage = 100_000, " ".join(f"p{i}" for i in range(30))
    own = [F.concat_ws("x", F.lit(side), F.col("doc_id"), F.lit(i)) for side in "ab" for i in range(15)]
    df = spark.range(n, numPartitions=8).withColumnRenamed("id", "doc_id").withColumn("text", F.concat_ws(" ", *own[:15], F.lit(passage), *own[15:]))
    seen, search = [], substrings.search
    monkeypatch.setattr(substrings, "search", lambda pieces, *a: search(seen.append(written(pieces, "pieces")) or seen[-1], *a))
    got = substrings.remove_repeats(df).groupBy("n_removed", "n_words").agg(F.count("*").alias("n"), F.min("row.doc_id").alias("least")).collect()
    assert sorted(map(tuple, got)) == [(0, 60, 1, 0), (30, 60, n - 1, 1)]
    assert seen[0].groupBy("anchor").count().agg(F.max("count")).first()[0] <= 1000


@pytest.mark.parametrize("many", [0, 3])
def test_windows_of_crowded_anchors_equal_brute_force(spark, monkeypatch, many):
    monkeypatch.setattr(substrings, "MANY_RUNS", many, raising=False)
    monkeypatch.setattr(substrings, "SEEN_WINDOWS", 50, raising=False)
    test_removed_words_equal_brute_force(spark, 5 + many)


def test_substring_edges(spark, edges, nothing):
    rows = substrings.remove_repeats(edges).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    assert len(rows) == len(EDGES) and all(r.n_removed == 0 for r in rows)
    assert {r.doc_id: r.n_words for r in rows}[5] == 30_000
    assert substrings.remove_repeats(nothing).count() == 0
    text = " ".join(f"u{i}" for i in range(20))
    copies = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], DOCS)
    assert sorted((r.doc_id or 0, r.n_removed) for r in substrings.remove_repeats(copies).select("row.doc_id", "n_removed").collect()) == [(0, 0), (1, 0), (1, 0), (2, 20)]


def test_automaton_finds_just_the_windows_that_occur():
    rng = random.Random(2)
    for _ in range(30):
        seqs = [[rng.choice("ab") for _ in range(rng.randint(0, 30))] for _ in range(4)]
        query = [rng.choice("ab") for _ in range(40)]
        a = substrings.Automaton()
        for s in seqs:
            a.add(s)
        texts = ["".join(s) for s in seqs]
        assert a.matches(query, 5) == [i for i in range(len(query) - 4) if any("".join(query[i: i + 5]) in t for t in texts)]


# packing

def test_packing_equals_sequential_best_fit_decreasing():
    rng = random.Random(3)
    for _ in range(30):
        capacity = rng.choice([10, 50, 200])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 400))]
        counts = Counter(items)
        steps, n = packing.best_fit_decreasing(counts, capacity)
        bins = []
        for x in sorted(items, reverse=True):
            r, i = min((r, i) for i, r in enumerate([*bins, 10**9]) if r >= x)
            if i == len(bins):
                bins.append(capacity - x)
            else:
                bins[i] -= x
        left = [capacity] * n
        rows = sorted(map(tuple, steps.tolist()), key=lambda s: (-s[0], s[1]))
        for j, (length, rank, per, first, used) in enumerate(rows):
            end = rows[j + 1][1] if j + 1 < len(rows) and rows[j + 1][0] == length else counts[length]
            for k in range(end - rank):
                b = first + k // per
                assert left[b] == capacity - used - k % per * length
                left[b] -= length
        assert sorted(left) == sorted(bins)


def test_packed_pieces(spark, edges, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    cut = written(packing.pieces(edges, public_tokenizers.path("word_bpe_49k.json"), with_ids=True), "pieces")
    got = packing.pack(cut).cache()
    want = []
    for k, text in EDGES:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        want += [(k, p, a, len(ids[a: a + 4096]), zlib.crc32(np.array(ids[a: a + 4096], "<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 4096))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in got.collect())
    places = {}
    for r in got.collect():
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(p[-1]) <= 4096
    whole = packing.sequences(got).collect()
    assert sorted(len(r.input_ids) for r in whole) == sorted(sum(n for _, n in p) for p in places.values())
    assert packing.packed_documents(nothing).count() == 0


# records and BPE

def test_chunks_give_the_ids_of_whole_texts(spark, docs):
    from tokenizers import Tokenizer

    texts = [t or "" for _, t in EDGES] + [r.text for r in docs.limit(50).collect()] + ["  a  b ", "a\n \nb c's it's", "a \n  b", "<|endoftext|> a<|endoftext|>", "<|startoftext|>", "a\x1cb c\x1d", "\x1f", "x\x1e \x1f y", "w" * 5000, "q" * 300 + " r", "é ́x", "DON'T. x,' 1.5%"]
    for name, mode in (("word_bpe_49k.json", "white"), ("byte_bpe_50k.json", "space")):
        t = Tokenizer.from_file(public_tokenizers.path(name))
        encoder, _ = chunks.library_encoder(public_tokenizers.path(name), mode)
        got = encoder.encode(texts)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_checksums_and_damage(tmp_path):
    def slow(data):
        c = 0xFFFFFFFF
        for x in data:
            c ^= x
            for _ in range(8):
                c = c >> 1 ^ (records.POLYNOMIAL if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    assert slow(b"123456789") == 0xE3069283
    rng = random.Random(4)
    parts = [rng.randbytes(n) for n in (4, 5, 255, 256, 257, 1000, 3000, 8)]
    assert records.crc32c(parts).tolist() == [slow(p) for p in parts]
    framed = records.frame(parts)
    assert records.unframe(framed) == parts
    for at in (0, 9, 14, -1):
        bad = bytearray(framed[3])
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe([bytes(bad)])


def test_record_files_round_trip(spark, edges, nothing):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    shards = records.write_records(edges, public_tokenizers.path("byte_bpe_50k.json"), 2, fresh_folder(spark, "records"))
    got = sorted(records.read_records(shards).collect(), key=lambda r: r.start)
    want = [(k, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for k, x in EDGES]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.ids)) for r in got)
    assert [r.doc_id for r in got] == sorted((k for k, _ in EDGES), key=lambda k: (k is not None, k))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    shard = max(shards.collect(), key=lambda r: r.records)
    order = list(range(shard.records))[::-1]
    picked = [i[0].tolist() for i, _ in records.read_some(shard.data_path, shard.index_path, order)]
    every = [x for i, _ in records.read_some(shard.data_path, shard.index_path) for x in i.tolist()]
    assert picked == every[::-1]
    assert records.read_records(records.write_records(nothing, public_tokenizers.path("byte_bpe_50k.json"), 2, fresh_folder(spark, "records"))).count() == 0


def test_byte_pairs_equal_tiktoken(spark, edges, docs, nothing):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pairs = bpe.byte_pairs(path, public_tokenizers.PATTERN)
    assert all(pairs.whole(x) == i for x, i in ranks.items()) and pairs.whole(b"no such token") is None
    texts = [t or "" for _, t in EDGES] + [r.text for r in docs.limit(100).collect()] + ["a" * 300, "  a \n  b ", "a\r\n\r\n x", " ", "<|endoftext|>"]
    for ids, t in zip(pairs.encode(texts), texts):
        assert list(ids) == library.encode_ordinary(t) and pairs.decode(ids) == t.encode()
    rows = bpe.encode(edges, path, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(EDGES) and sorted(r.decoded_sha256 for r in rows) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in EDGES)
    assert bpe.encode(nothing, path, public_tokenizers.PATTERN).count() == 0


# fingerprints

def test_closed_syncmers_depend_on_the_k_mer_alone():
    rng = random.Random(6)
    codes = np.array([rng.randrange(97, 103) for _ in range(500)], np.uint64)
    h = syncmers._grams(codes, syncmers.S)
    w = syncmers.K - syncmers.S + 1
    assert syncmers.closed_syncmers(codes).tolist() == [i for i in range(codes.size - syncmers.K + 1) if min(h[i: i + w]) in (h[i], h[i + w - 1])]


def test_edited_texts_follow_the_order_of_ids(spark, docs):
    got = {r.doc_id: r for r in syncmers.op5_syncmers(spark, SF).collect()}
    rows = sorted(docs.collect(), key=lambda r: -r.doc_id)
    for a, b in zip(rows, rows[1:] + rows[:1]):
        n = len(a.text)
        edited = a.text[: n - n // 2] + b.text[: n // 2]
        own, new, nxt = syncmers.fingerprint_many([a.text, edited, b.text])
        r = got[a.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (syncmers.encode_fingerprint(own), syncmers.encode_fingerprint(new))
        assert r.near_edited == syncmers.likeness(own, new) and r.near_next == syncmers.likeness(own, nxt)
    assert np.mean([r.near_edited for r in got.values()]) > 0.25 > 0.05 > np.median([r.near_next for r in got.values()])


def test_fingerprint_edges(spark, edges, nothing):
    rows = syncmers.edited_pairs(edges).collect()
    assert len(rows) == len(EDGES) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert len({r.fingerprint for r in rows if r.doc_id in (6, 7)}) == 1
    assert {r.n_chars for r in rows if r.doc_id in (1, 2)} == {0}
    assert syncmers.edited_pairs(nothing).count() == 0
    one = syncmers.edited_pairs(spark.createDataFrame([(1, "abcdef" * 10)], DOCS)).first()
    assert one.edited_sha256 == hashlib.sha256(("abcdef" * 10)[:30].encode() + ("abcdef" * 10)[:30].encode()).hexdigest() and one.near_next == 1.0
    fp = syncmers.fingerprint_many(["abc def ghi jkl mno pqr"])[0]
    back = syncmers.decode_fingerprint(syncmers.encode_fingerprint(fp))
    assert all((a == b).all() for a, b in zip(fp, back)) and syncmers.likeness(fp, fp) == 1.0


# WARC

def page_rows(pages):
    payload = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    least = {}
    for k, p in payload:
        if k is not None:
            least[p] = min(least.get(p, k), k)
    return sorted(str((k, len(p), warc.digest(p), "response" if least.get(p, k) == k else "revisit", None if least.get(p, k) == k else least[p])) for k, p in payload)


def settled_rows(rows):
    size = F.when(F.col("record_type") == "revisit", F.col("http_length")).otherwise(F.length("payload"))
    return sorted(str(tuple(r)) for r in rows.select("page_id", size.alias("n"), "payload_digest", "record_type", "refers_to").collect())


def test_archives_round_trip_in_small_ranges(spark):
    odd = [(900_001, "u", ""), (900_002, None, None), (7, "x", "same"), (5, "x\r\ny: z", "same"), (9, "y", "same"), (9, "y", "same"), (None, "z", "same"), (None, None, "alone")]
    pages = table(spark, SF, "pages").select("page_id", "url", "html").union(spark.createDataFrame(odd, "page_id long, url string, html string"))
    archives = warc.write_archives(pages, fresh_folder(spark, "warc"))
    found = written(warc.scan_archives(archives, range_bytes=5000), "found")
    rows, gaps = warc.settle(found, archives)
    assert settled_rows(rows) == page_rows(pages) and gaps.count() == 0
    assert warc.write_archives(pages.limit(0), fresh_folder(spark, "warc")).count() == 0


def test_salvage_recovers_records_behind_damage(spark, tmp_path):
    data = [b"payload %d " % i * 50 for i in range(12)]
    plain = [warc.record(i, f"u{i}", warc.digest(p), len(p), p) for i, p in enumerate(data)]
    for name, parts in (("a.warc.gz", [warc.gzip_member(x) for x in plain]), ("b.warc", plain)):
        hurt = list(parts)
        hurt[3] = hurt[3][:-40] + bytes(x ^ 0x55 for x in hurt[3][-40:-30]) + hurt[3][-30:]
        hurt[6] = b"junk WARC/1. \x1f\x8b\x08 junk" + hurt[6]
        hurt[11] = hurt[11][:-9]
        (tmp_path / name).write_bytes(b"".join(hurt))
        archives = warc.archives_in(spark, str(tmp_path / name))
        for size in (100, 1 << 20):
            rows, gaps = warc.settle(written(warc.scan_archives(archives, range_bytes=size), "found"), archives)
            assert sorted(r.page_id for r in rows.collect()) == [i for i in range(12) if i not in (3, 11)]
            starts = np.cumsum([0, *map(len, hurt)])
            want = [(starts[3], starts[4]), (starts[6], starts[6] + len(hurt[6]) - len(parts[6])), (starts[11], starts[12])]
            assert sorted((r.start, r.end) for r in gaps.collect()) == want
    assert list(warc.salvage(pa.BufferReader(b""), 0, 0, 0)) == []


# HTML

def test_article_text_of_the_test_pages(spark):
    rows = html_text.op10_html(spark, SF).join(table(spark, SF, "pages").select("page_id", "html"), "page_id").collect()
    for r in rows:
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text)


def test_boilerplate_of_other_pages():
    page = """<html><head><title>x</title><style>p{}</style></head><body><header><h1>Site</h1></header><div id="cookie-notice">We use cookies.</div>
    <ul class="menu"><li><a href="/">Home</a></ul><div class="content"><h2>Head &amp; more</h2><p>One para,  with&nbsp;text.<p>Two<br>lines <a href="x">link</a>.
    <ul><li>item one</li><li>item two</ul><form>Name <input></form><div class="ad-slot">Buy now, cheap.</div></div><section id="comments"><p>Great, thanks!</p></section>
    <aside>side</aside><footer>foot</footer><script>if(a<b){"</p>"}</script></body>"""
    assert html_text.main_text(page) == "Head & more\nOne para, with text.\nTwo lines link.\nitem one\nitem two"
    for none in (None, "", "<html>", "<script>x</script>", "<!-- only -->", "<nav>menu</nav>"):
        assert html_text.main_text(none) == ""
    assert html_text.main_text("plain < text") == "plain < text"
    assert html_text.main_text("<p>open <b>x <i a='>' b") == "open x"


PROSE = [f"Paragraph {i} of the text says a few things, at some length, and then it stops; the next one goes on about it all." for i in range(6)]


def test_tag_paths_choose_the_container():
    """Text beside teasers in article elements, and boilerplate of no known name within main."""
    text = "".join(f"<p>{x}</p>" for x in PROSE)
    cards = "".join(f"<article class='card'><h3>Teaser {i}</h3><p>Read on here.</p></article>" for i in range(8))
    for page in (f"<div class='post'><h1>Head</h1>{text}</div><div class='more'>{cards}</div>", f"<div class='more'>{cards}</div><div class='post'><h1>Head</h1>{text}</div>"):
        assert html_text.main_text(f"<body><ul><li><a href='/'>Home</a></li></ul>{page}</body>") == "\n".join(["Head", *PROSE])
    page = f"<main><h1>Head</h1><div class='x1'><p>Sign up today</p></div><div class='text'><h2>Part</h2>{text}<ul><li>item</li></ul></div><div class='x2'>Tell a friend</div></main>"
    assert html_text.main_text(page) == "\n".join(["Head", "Part", *PROSE, "item"])
    page = f"<main><article><h1>Head</h1>{text}<div>A short note.</div></article><div class='more'>{cards}</div></main>"
    assert html_text.main_text(page) == "\n".join(["Head", *PROSE, "A short note."])


def test_names_and_links_that_are_text():
    """Names that only contain a listed word, attributes that only end like class or id, and links that are the article's."""
    text, want = "".join(f"<p>{x}</p>" for x in PROSE), "\n".join(PROSE)
    for a in ("class='content has-sidebar'", "id='page' class='no-header'", "class='social-policy'", "data-id='widget'", "data-role='navigation'", "data-class='nav'", "class='widget'"):
        assert html_text.main_text(f"<body><div {a}>{text}</div><div class='sidebar'><p>Buy this, and that.</p></div></body>") == want
        assert html_text.main_text(f"<article>{text}<section {a}><p>More of it.</p></section></article>") == want + ("" if a == "class='widget'" else "\nMore of it.")
    for a in ("class='main-nav'", "id='cookie-notice'", "class='ad-slot'", "id='siteFooter'", "class='x related-posts'", "class='comments'"):
        assert html_text.main_text(f"<body><article>{text}<div {a}><p>Buy this, and that.</p></div></article></body>") == want
    assert html_text.main_text(f"<body><div class='post'>{text}</div><div id='comments'>{text * 5}</div></body>") == want
    links = "<ul><li><a href='a'>First source</a></li><li><a href='b'>Second source</a></li></ul><table><tr><td><a href='c'>Cell</a></td></tr></table>"
    assert html_text.main_text(f"<article>{text}{links}</article><ul><li><a href='/'>Home</a></li></ul>") == want + "\nFirst source\nSecond source\nCell"
    items = "<ul><li><a href='a'>One source</a></li><li>An item without any link, of some length</li></ul>"
    assert html_text.main_text(f"<body><div class='post'>{text}{items}</div></body>") == want + "\nOne source\nAn item without any link, of some length"


def test_page_edges(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "v", "<p>" + "long text. " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("page", F.lit(1))
    got = html_text.extract(df).select("row.page_id", "text", "n_chars", "row.text").toDF("id", "text", "n", "kept").collect()
    assert len(got) == 4 and {r.kept for r in got} == {"clash"} and max(r.n for r in got) == len(("long text. " * 50_000).strip())
    assert html_text.extract(df.limit(0)).count() == 0


COLLIDING = ["a596241 b596241 c596241 x1 a1038393 b1038393 c1038393 x2 a596241 b596241 c596241"]


@pytest.mark.parametrize("bits", [27, 59, 3])
def test_repeats_survive_equal_hash_bits(spark, monkeypatch, bits):
    """With all but a few hash bits gone (59), and with positions beyond their bits (3), counts stay exact."""
    monkeypatch.setattr(quality, "POSITION_BITS", bits)
    rng = random.Random(bits)
    texts = COLLIDING + [" ".join(f"w{rng.randrange(k)}" for _ in range(rng.randint(0, 60))) for k in (2, 4, 8, 16) for _ in range(12)]

    def brute(text):
        w = text.split()
        seen = Counter(tuple(w[i: i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i: i + 3])] > 1 for k in range(3)})

    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.row.doc_id: r.n_repeat_words for r in quality.with_stats(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
