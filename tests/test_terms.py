"""Vocabularies by hash buckets against plain counts, the split by digests, and what training leaves behind."""
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from plaint.operators import metrics as M
from plaint.operators import models as ML
from plaint.operators import terms as G
from plaint.operators import text as T
from plaint.session import ensure_checkpoint_dir

WORDS = ["card", "late", "the", "fée", "日本語", "refund", "of", "a1", "x", "bank", "new"]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(11)
    rows = [(i // 2 if i < 60 else None if i < 64 else i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 15))) if i % 8 else None) for i in range(120)]
    return spark.createDataFrame(rows, "id long, text string").repartition(3)


def plain(rows, key):
    """{term: (documents, occurrences)}"""
    total, docs = Counter(), {}
    for i, r in enumerate(rows):
        w = [x for x in (r.text or "").split() if len(x) > 1 and x not in T.STOP_WORDS]
        for g in w + [f"{a} {b}" for a, b in zip(w, w[1:])]:
            total[g] += 1
            docs.setdefault(g, set()).add(r.id if key else i)
    return {g: (len(docs[g]), n) for g, n in total.items()}


@pytest.mark.parametrize("key", [None, "id"])
@pytest.mark.parametrize("buckets, least, most", [(1 << 20, 3, 9), (16, 3, 9), (64, 20, 500), (1 << 20, 1, 500), (16, 1, 40)])
def test_top_terms_equal_plain_counts(spark, texts, monkeypatch, key, buckets, least, most):
    """However few the buckets are, and wherever the bound lies at first."""
    monkeypatch.setattr(G, "BUCKETS", buckets)
    monkeypatch.setattr(G, "MORE", 0)
    monkeypatch.setattr(G, "SLICE_WORDS", 20)
    counts = plain(texts.collect(), key)
    want = sorted(((t, d, n) for t, (d, n) in counts.items() if d >= least), key=lambda x: (-x[2], x[0]))[:most]
    docs = texts.select("id", G.words("text", T.UNICODE_TERMS).alias("w"))
    assert [tuple(r) for r in G.top_terms(docs, "w", least, most, key)] == want


def test_few_terms_are_shuffled(spark):
    """A vocabulary of a few terms is found without sending every term of the corpus."""
    docs = spark.range(400).select(F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.when(i < 9, F.concat(F.lit("often"), i.cast("string"))).otherwise(F.md5(F.concat_ws("-", i, "id")))).alias("w"))
    buckets = G.bucket_counts(docs, "w")
    assert buckets.sum() == 400 * (41 + 40)
    bound = sorted(buckets)[-17]  # nine words and their eight pairs are in all rows
    sent = G.term_totals(docs, "w", buckets >= bound).count()
    assert len(G.top_terms(docs, "w", 5, 10)) == 10 and sent < 400


@pytest.mark.parametrize("rows", [[(i, i % 2) for i in range(97)], [(i if i % 7 else None, i % 3 if i % 5 else None) for i in range(97)], [(7, 0)] * 31, [(i // 3, 1) for i in range(40)], [(1, 0)], []])
def test_split_equals_the_global_rank(spark, monkeypatch, rows):
    monkeypatch.setattr(M, "CUT_ROWS", 2)
    df = spark.createDataFrame([(*r, f"t{i}") for i, r in enumerate(rows)], "id long, y int, narrative string")
    got, want = M.stratified_split(df, "id", "y"), M._ranked_split(df, "id", "y", 0.2)
    assert got.columns == want.columns
    if len({r[0] for r in rows}) >= len(rows) - 20:  # else which of an id's rows are told from one another is open
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.groupBy("y", "split").count().exceptAll(want.groupBy("y", "split").count()).isEmpty()


def test_split_moves_no_rows(spark, tmp_path):
    spark.range(50).select("id", (F.col("id") % 2).alias("y"), F.lit("a text").alias("narrative")).write.parquet(str(tmp_path / "t"))
    plan = M.stratified_split(spark.read.parquet(str(tmp_path / "t")), "id", "y")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "Exchange" not in plan


def test_training_leaves_no_tables(spark):
    """Written rows and features go with the training that needs them."""
    df = spark.createDataFrame([("card late" if i % 3 else "refund card", i % 2) for i in range(60)], "narrative string, is_escalated int")
    folder = ensure_checkpoint_dir(spark)

    def tables():
        return {x for x in os.listdir(folder) if x.startswith(("train_", "features_"))}

    before = tables()
    ML.train_text_model(df, max_iter=5)
    assert tables() == before


@pytest.mark.parametrize("repeated", [False, True])
def test_weights_of_documents_need_no_count_of_all_terms(spark, tmp_path, monkeypatch, repeated):
    """Equal to plain weights, whether keys have one row or more (their rows are one document); one row a key is weighed in place."""
    import math

    from plaint.plans import q_text as Q
    monkeypatch.setattr(G, "MORE", 0)
    rnd = random.Random(2)
    rows = [(i // 2 if repeated and i < 30 else None if i == 59 or repeated and i > 56 else i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 9)))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    weights, vocab = Q._weights(spark, str(tmp_path))
    idf = {r.term: r.idf for r in vocab.collect()}
    tf = {}
    for key, text in rows:
        w = [x for x in text.split() if len(x) > 1 and x not in T.STOP_WORDS and x.isascii()]  # the pattern cuts words at other letters
        if "fée" in text or "日本語" in text:
            w = spark.createDataFrame([(0, text)], "k long, t string").select(F.filter(G.words("t", T.ASCII_TERMS), lambda x: ~x.isin(*T.STOP_WORDS))).first()[0]
        tf.setdefault(key, Counter()).update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df = Counter(t for c in tf.values() for t in c)
    assert idf == {t: pytest.approx(math.log(61 / (1 + n)) + 1) for t, n in df.items() if n >= 5}
    want = {}
    for key, c in tf.items():
        made = {t: (1 + math.log(n)) * idf[t] for t, n in c.items() if t in idf}
        want |= {(key, t): v / math.sqrt(sum(x * x for x in made.values())) for t, v in made.items()}
    assert {(r.doc_id, r.term): r.weight for r in weights.collect()} == {k: pytest.approx(v, abs=1e-12) for k, v in want.items()}
    assert repeated or "Exchange" not in weights._jdf.queryExecution().executedPlan().toString()
