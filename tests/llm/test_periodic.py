"""Periodic runs against brute force: the tree part, the cutting into stretches, and the whole query."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaint.llm import periodic

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least):
    """Every maximal stretch with a smallest period, by comparing words."""
    out = []
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            n = j - i + p
            if n >= max(least, 2 * p) and not any(w[i: i + n - q] == w[i + q: i + n] for q in range(1, p)):
                out.append((i, n, p))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def answer(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def cases():
    rnd = random.Random(11)
    for _ in range(400):
        n, k = rnd.randint(0, 60), rnd.choice([1, 2, 3, 5, 12])
        w = [rnd.randrange(k) for _ in range(n)]
        if n > 5 and rnd.random() < 0.5:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        yield w
    yield [0] * 40
    a, b = [0], [0, 1]  # a Fibonacci word has nearly as many runs as any text
    while len(b) < 80:
        a, b = b, b + a
    yield b


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    for w in cases():
        codes = np.array(w, np.int64)
        want = brute(w, least)
        assert [tuple(r) for r in periodic.runs_of(codes, least).tolist()] == want
        cut = []
        for a, b in periodic.segments(codes, np.zeros(len(w), np.int64), least):
            cut += [(s + a, n, p) for s, n, p in periodic.runs_of(codes[a:b], least).tolist()]
        assert cut == want  # no run is lost by cutting


def test_common_extensions_equal_comparison():
    rnd = random.Random(3)
    w = [rnd.randrange(1, 3) for _ in range(120)]
    tree = periodic.SuffixTree(w, 3)
    pairs = [(i, j) for i in range(120) for j in range(120) if i != j]
    got = tree.lce(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    for (i, j), k in zip(pairs, got.tolist()):
        want = 0
        while max(i, j) + want < 120 and w[i + want] == w[j + want]:
            want += 1
        assert k == want
    assert [tree.ranks()[i] for i in sorted(range(120), key=lambda i: w[i:])] == list(range(120))
    assert [tree.ranks(True)[i] for i in sorted(range(120), key=lambda i: [-x for x in w[i:]])] == list(range(120))


def test_neighbouring_texts_share_no_run():
    codes = np.array([1] * 6 + [1] * 6 + [2] * 12, np.int64)
    assert periodic.segments(codes, np.array([0] * 6 + [1] * 6 + [2] * 12), 12) == [(12, 24)]


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in periodic.op11_periodic(spark, SF).collect()}
    assert got == {answer(d, t) for d, t in docs if len(t or "") < 20_000} | {g for g in got if g[0] in {d for d, t in docs if len(t or "") >= 20_000}}
    assert len(got) == len(docs) and sum(g[1] > 0 for g in got) > len(docs) // 20


EDGES = [(None, "a b c " * 9), (1, None), (2, ""), (3, " \n\t "), (4, "x"), (5, "y " * 30_000), (6, "p q " * 8), (6, "p q " * 8), (7, "p q " * 8),
         (8, "naïve\x1cword \x85 " * 7), (9, "u v w x y z u v w x y z"), (10, "u v w x y u v w x y")]


def test_edge_rows(spark):
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    for name in ("row", "runs", "collapsed", "n_words", "_text", "start"):
        df = df.withColumn(name, F.lit("clash"))
    rows = periodic.collapse(df).collect()
    got = sorted(((r.row.doc_id, r.row.text, r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.row.runs) for r in rows), key=str)
    want = []
    for d, t in EDGES:
        w = WORD.findall(t or "")
        runs = brute(w, 12) if len(w) < 1000 else [(0, 30_000, 1)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        want.append((d, t, len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone), "clash"))
    assert got == sorted(want, key=str)
    assert periodic.collapse(df.limit(0)).count() == 0


def test_planted_texts(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 10 == 0][:20]
    rows = [(i, " ".join(f"w{k}" for k in range(i % 7 * 9))) for i in ids] + [(i, None) for i in ids[:3]] + [(None, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = periodic.collapse(df.select("doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text")))
    got = sorted(((r.row.doc_id, len(r.runs), hashlib.sha256(r.collapsed.encode()).hexdigest()) for r in made.collect()), key=str)
    assert got == sorted(((a[0], a[1], a[-1]) for a in (answer(*r) for r in rows)), key=str)
