"""Phrase collocations against brute force and SQL."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaint.llm import collocations as C

SF = "/root/testdata/sf0.01"


def brute(rows, least, top):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                counts.setdefault(lang, Counter()).update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = total[lang], []
        often = {p: a for p, a in f.items() if a >= least}
        gone = {p[i: i + k] for p, a in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 100 * f[p[i: i + k]]}
        for p, a in often.items():
            if len(p) > 1 and p not in gone:
                s, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, r, n, -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus(seed, docs=120):
    rnd = random.Random(seed)
    names = [f"N{i} of THE m{i}" for i in range(6)] + ["alpha beta gamma delta epsilon zeta", "É É É", "one\ttwo"]
    rows = []
    for _ in range(docs):
        words = []
        for _ in range(rnd.randint(0, 60)):
            words.append(rnd.choice(names) if rnd.random() < 0.3 else f"w{int(rnd.expovariate(0.2))}" + rnd.choice(["", "", "", ",", ".\n", " ;\x0b"]))
        rows.append((rnd.choice(["a", "b", None, "und"]), " ".join(words)))
    return rows


@pytest.mark.parametrize("least, top, widen, clash", [(5, 7, 2, False), (20, 2000, 10**6, True)])
def test_equals_brute_force(spark, monkeypatch, least, top, widen, clash):
    """With small steps and ties at the threshold; and where two words share a hash, so that all is counted with another one."""
    monkeypatch.setattr(C, "WIDEN", widen)
    if clash:
        inner = C._hashes
        monkeypatch.setattr(C, "_hashes", lambda words, seed: inner(words, seed) if seed else np.full(len(words), 7, np.uint64))
    rows = corpus(least * 7 + top)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in C.collocations(df, least, top).collect()) == brute(rows, least, top)


def test_bounds_prune_the_frontier(spark, monkeypatch):
    """With a small ``top`` fewer prefixes are expanded, and the answer is the head of the whole one."""
    rows = corpus(3, 300)
    df = spark.createDataFrame(rows, "lang string, text string").cache()
    seen = []
    inner = C.written

    def watched(frame, name):
        got = inner(frame, name)
        if name == "phrases":
            seen.append(got.count())
        return got

    monkeypatch.setattr(C, "written", watched)
    monkeypatch.setattr(C, "WIDEN", 2)
    whole = {tuple(r) for r in C.collocations(df, 5, 10_000).collect()}
    all_counted, _ = sum(seen), seen.clear()
    few = {tuple(r) for r in C.collocations(df, 5, 3).collect()}
    assert few == {r for r in whole if r[1] <= 3} and sum(seen) < all_counted


def test_hash_ties_are_told_apart():
    words = [np.array([1, 1, 2, 1, 2], np.uint64), np.array([5, 5, 5, 6, 5], np.uint64)]
    order, starts = C._groups(np.zeros(5, np.uint64), words)
    groups = {tuple(sorted(g)) for g in np.split(order, starts[1:])}
    assert groups == {(0, 1), (3,), (2, 4)}


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(4 * 10**12, 9 * 10**12, 5 * 10**12, 4 * 10**12)], "f long, n long, l long, r long")
    assert df.select(C._score("f", "n", "l", "r")).first()[0] == 1000 * 4 * 10**12 * 9 * 10**12 // (5 * 10**12 * 4 * 10**12)


def test_edge_rows(spark):
    rows = [(None, None), ("a", ""), ("a", " .\n,"), ("", "x y " * 30), ("", "x y " * 30), ("a", "Q" * 20_000), ("b", "p q r " * 9_000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    for name in ("w0", "f", "n", "codes", "phrase", "score", "doc_id"):
        df = df.withColumn(name, F.lit("clash"))
    assert sorted(tuple(r) for r in C.collocations(df, 10, 5).collect()) == brute(rows, 10, 5)
    assert C.collocations(df.limit(0)).count() == 0


def test_query_equals_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cursor = con.execute(C.OP13_SQL)
    names = [c[0] for c in cursor.description]
    assert {tuple(r) for r in C.op13_collocations(spark, SF).select(*names).collect()} == set(cursor.fetchall())


@pytest.mark.parametrize("text", ["", " ", "a b  a\tb.c..d", ".a", "a.", "é ß!é\n\n ß", "..", "x" * 300 + " y"])
def test_words_are_numbered_as_split(text):
    """Each word once, breaks as -1, all in text order."""
    data = text.encode().translate(C._TABLE)
    words, ids = C._numbered(data)
    assert len(set(words)) == len(words)
    assert [words[i] if i >= 0 else b"\xff" for i in ids.tolist()] == data.replace(b"\xff", b" \xff ").split()


def test_words_are_counted_by_hash_aggregates(spark):
    """No sort of all words: what is kept for a word is a sum."""
    df = spark.createDataFrame([("en", "a b a."), ("en", "b"), (None, "a")], "lang string, text string")
    got = C.word_counts(df, 0)
    assert sorted((r["lang"], r["word"], r["f"]) for r in got.collect()) == [("en", "a", 2), ("en", "b", 2), ("und", "a", 1)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
