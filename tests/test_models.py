"""Own feature stages and histogram boosting against plain Python, and saved models."""
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from plaint.operators import boosting as B
from plaint.operators import models as ML
from plaint.operators import stages as S
from plaint.operators import text as T
from plaint.operators.stages import LevelIndex, TfidfTerms

WORDS = ["card", "charge", "late", "fée", "größe", "the", "and", "refund", "x", "bank2", "日本語"]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 12))) if i % 9 else None) for i in range(80)]
    return spark.createDataFrame(rows, "id long, text string")


def plain_tfidf(rows, least, most):
    grams = {}
    for r in rows:
        w = [x for x in (r.text or "").lower().split() if len(x) > 1 and x not in T.STOP_WORDS]
        grams[r.id] = w + [f"{a} {b}" for a, b in zip(w, w[1:])]
    total, df = Counter(g for x in grams.values() for g in x), Counter(g for x in grams.values() for g in set(x))
    kept = sorted(sorted((t for t in total if df[t] >= least), key=lambda t: (-total[t], t))[:most])
    idf = {t: math.log((1 + len(grams)) / (1 + df[t])) + 1 for t in kept}
    out = {}
    for k, x in grams.items():
        w = {t: (1 + math.log(n)) * idf[t] for t, n in Counter(x).items() if t in idf}
        norm = math.sqrt(sum(v * v for v in w.values()))
        out[k] = {t: v / norm for t, v in w.items()}
    return kept, out


def test_tfidf_stage_equals_plain_and_relational(spark, texts, tmp_path):
    model = TfidfTerms(inputCol="text", outputCol="v", maxFeatures=20, minDF=3).fit(texts)
    kept, want = plain_tfidf(texts.collect(), 3, 20)
    assert model.terms == kept
    model.save(str(tmp_path / "m"))
    for m in (model, type(model).load(str(tmp_path / "m"))):
        for r in m.transform(texts).collect():
            got = {m.terms[i]: v for i, v in zip(r.v.indices, r.v.values)}
            assert got == pytest.approx(want[r.id], abs=1e-9)
    counts = T.term_counts(T.tokenize_terms(texts, "id", "text", pattern=T.UNICODE_TERMS), "id")
    weights = T.tfidf(counts, T.with_idf(T.vocabulary(counts, "id", 3, 20), F.lit(texts.count())), "id")
    for r in weights.collect():
        assert r.weight == pytest.approx(want[r.id][r.term], abs=1e-9)


def test_rare_levels_pool_and_unseen_are_zeros(spark, tmp_path):
    rows = [("a",)] * 30 + [("b",)] * 26 + [(None,)] * 25 + [("r1",)] * 3 + [("r2",)]
    train = spark.createDataFrame(rows, "level string")
    stages, outs = ML.categorical_stages(["level"])
    model = Pipeline(stages=stages).fit(train)
    model.save(str(tmp_path / "p"))
    asked = spark.createDataFrame([("a",), ("b",), (None,), ("r1",), ("r2",), ("new",)], "level string")
    for m in (model, PipelineModel.load(str(tmp_path / "p"))):
        got = {r.level: r.level_v.toArray().tolist() for r in m.transform(asked).collect()}
        assert got[None] == [1, 0, 0, 0] and got["a"] == [0, 1, 0, 0] and got["b"] == [0, 0, 1, 0]
        assert got["r1"] == got["r2"] == [0, 0, 0, 1] and got["new"] == [0, 0, 0, 0]
        assert m.stages[0].names() == ["Unknown", "a", "b", "infrequent"]
    codes = LevelIndex(inputCol="level", outputCol="i", unseen="minus").fit(train).transform(asked)
    assert {r.level: r.i for r in codes.collect()} == {None: 0, "a": 1, "b": 2, "r1": 3, "r2": 4, "new": -1}


def test_few_levels_are_joined_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Whatever the size of the fitted table; beyond MAX_LEVELS the codes are the same."""
    rows = [(x,) for x in ["é", "z", "Z", "日本", None, "", "a b", "a"] for _ in range(3)] + [("rare",), ("😀",)]
    train = spark.createDataFrame(rows, "level string")
    stage = LevelIndex(inputCol="level", outputCol="i", minFrequency=2)

    def codes(model):
        return {r.level: r.i for r in model.transform(train).collect()}

    monkeypatch.setattr(S, "MAX_LEVELS", 3)
    shuffled = stage.fit(train)
    want = codes(shuffled)
    monkeypatch.undo()
    model = stage.fit(train)
    model.save(str(tmp_path / "m"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for m in (model, S.LevelIndexModel.load(str(tmp_path / "m"))):
            coded = m.transform(train)
            assert "SortMergeJoin" not in coded._jdf.queryExecution().executedPlan().toString()
            assert codes(m) == want and m.names() == shuffled.names()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    none = stage.fit(train.limit(0))
    assert {r.i for r in none.transform(train).collect()} == {1.0}


def plain_tree(bins, g, h, depth, leaves, l2, least):
    """Leaf-wise growth by trying every split of every leaf: {row: value} as an array."""
    parts = [(np.arange(len(g)), 0)]

    def best(rows):
        top = (1e-12, None)
        for f in range(bins.shape[1]):
            for c in np.unique(bins[rows, f]):
                x = bins[rows, f] <= c
                a, b = rows[x], rows[~x]
                if len(a) >= least and len(b) >= least:
                    gain = g[a].sum() ** 2 / (h[a].sum() + l2) + g[b].sum() ** 2 / (h[b].sum() + l2) - g[rows].sum() ** 2 / (h[rows].sum() + l2)
                    if gain > top[0] + 1e-9:
                        top = (gain, (a, b))
        return top

    while len(parts) < leaves:
        options = [(*best(rows), i) for i, (rows, d) in enumerate(parts) if d < depth]
        options = [o for o in options if o[1]]
        if not options:
            break
        gain, (a, b), i = max(options, key=lambda o: o[0])
        d = parts.pop(i)[1]
        parts += [(a, d + 1), (b, d + 1)]
    out = np.zeros(len(g))
    for rows, _ in parts:
        out[rows] = -0.08 * g[rows].sum() / (h[rows].sum() + l2)
    return out


@pytest.fixture(scope="module")
def cases(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(700, 4)), 2)
    x[:, 3] = rng.integers(0, 5, 700)
    y = (rng.random(700) < 1 / (1 + np.exp(-(2 * x[:, 0] * (x[:, 1] > 0) - x[:, 3] + 1.5)))).astype(float)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double").repartition(4), x, y


@pytest.mark.parametrize("depth, leaves", [(3, 31), (6, 9)])
def test_trees_equal_leaf_wise_growth(spark, cases, depth, leaves):
    df, x, y = cases
    boost = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y", maxIter=2, maxDepth=depth, maxLeaves=leaves)
    model = boost.fit(df)
    bins = B.binned(list(x.T), model.cuts)
    margin = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        step = plain_tree(bins.astype(int), p - y, p * (1 - p), depth, leaves, 1.0, 20)
        assert np.allclose(tree.values(bins), step, atol=1e-9)
        assert sum(1 for left in tree.left if not left) <= leaves
        margin = margin + step


def test_boosted_model_saved_and_scored(spark, cases, tmp_path, monkeypatch):
    df, x, y = cases
    monkeypatch.setattr(B, "KEEP_TREES", 3)
    model = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y", maxIter=8).fit(df)
    model.save(str(tmp_path / "m"))
    same = B.HistBoostModel.load(str(tmp_path / "m"))
    got = {tuple(r)[:5]: r.p for r in model.transform(df).collect()}
    assert got == {tuple(r)[:5]: r.p for r in same.transform(df).collect()}
    p = np.array([got[(*map(float, r), float(v))] for r, v in zip(x, y)])
    assert p[y == 1].mean() > p[y == 0].mean() + 0.1 and len(model.trees) == 8


def test_labels_of_one_kind(spark, cases):
    df, _, _ = cases
    for wanted, low, high in ((0.0, 0.0, 0.01), (1.0, 0.99, 1.0)):
        model = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y").fit(df.filter(F.col("y") == wanted))
        assert all(low <= r.p <= high for r in model.transform(df).limit(5).collect())


def test_early_stopping_holds_rows_back(spark, cases, monkeypatch):
    df, _, _ = cases
    monkeypatch.setattr(B, "EARLY_ROWS", 100)
    noise = df.withColumn("y", (F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0).cast("double"))
    model = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y", maxIter=60, maxDepth=3).fit(noise)
    assert len(model.trees) < 60


def test_rows_are_read_once_a_level_however_small_the_blocks(spark, cases, monkeypatch):
    df, _, _ = cases
    whole = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y", maxIter=4).fit(df)
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "KEEP_TREES", 2)
    cut = B.HistBoost(inputCols=list("abcd"), outputCol="p", labelCol="y", maxIter=4).fit(df)
    assert [(t.feature, t.cut, t.left) for t in cut.trees] == [(t.feature, t.cut, t.left) for t in whole.trees]
    assert all(a.value == pytest.approx(b.value, abs=1e-9) for a, b in zip(cut.trees, whole.trees))


def test_small_sums_need_no_shuffle(spark, monkeypatch):
    """A level is one stage while its sums are small; by a shuffle they are the same."""
    data, sizes = spark.sparkContext.parallelize(range(4), 4).map(lambda i: (np.full((1, 5), i % 3, np.uint8), np.ones(5), np.zeros(5, bool), np.zeros(5))), [3]
    direct, _ = B._histograms(data, sizes, B.Tree(), [0], True)
    calls = []
    monkeypatch.setattr(type(data), "reduceByKey", lambda self, *a, **k: calls.append(1) or self)
    B._histograms(data, sizes, B.Tree(), [0], True)
    assert not calls
    monkeypatch.undo()
    monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    shuffled, _ = B._histograms(data, sizes, B.Tree(), [0], True)
    assert (direct[0] == shuffled[0]).all() and direct[0][2, 0, :3].tolist() == [10, 5, 5]


@pytest.mark.parametrize("rows, cores, tasks", [(0, 12, 1), (720_000, 12, 12), (7_200_000, 12, 24), (100_000, 12, 2), (43_200_000, 12, 96)])
def test_a_level_keeps_all_cores_busy(rows, cores, tasks):
    assert B.task_count(rows, cores) == tasks


def test_training_works_its_rows_out_once(spark, tmp_path):
    """Every pass of the stages and of the regression reads written rows, not the input's plan."""
    rows = [("card late" if i % 3 else "refund card", i % 2) for i in range(60)]
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "narrative string, is_escalated int").mapInArrow(count, "narrative string, is_escalated int")
    model = ML.train_text_model(df, max_iter=20)
    assert len(model.stages) == 2 and seen.value == 60


def test_a_split_is_worked_out_once(spark, monkeypatch):
    """Training and test rows of a model are read from one written split."""
    from plaint.plans import q_ml as Q

    fact = spark.createDataFrame([(i if i % 7 else None, i % 2, f"t{i}") for i in range(40)], "complaint_id long, is_escalated int, narrative string")
    calls, inner = [], Q.M.stratified_split
    monkeypatch.setattr(Q, "_fact", lambda spark, sf: fact)
    monkeypatch.setattr(Q.M, "stratified_split", lambda *a: calls.append(1) or inner(*a))
    monkeypatch.setattr(Q, "_SPLITS", {})
    for _ in range(2):
        train, test = Q._split(spark, "made", "is_escalated", ["narrative"])
    assert len(calls) == 1 and train.columns == test.columns and set(train.columns) == set(fact.columns)
    assert (train.count(), test.count()) == (32, 8) and train.unionByName(test).exceptAll(fact.select(*train.columns)).isEmpty()
