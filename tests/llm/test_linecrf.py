"""The line CRF: inference and gradient by enumeration, features by plain Python, held-out accuracy, edge rows."""
import itertools
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plaint.llm import linecrf
from plaint.llm.common import table

SF = "/root/testdata/sf0.01"


def enumerate_labels(unary, steps):
    """(P(good) of each line, log Z, expected steps) by summing over all labellings."""
    z, good, pair = 0.0, np.zeros(len(unary)), np.zeros((2, 2))
    for y in itertools.product((0, 1), repeat=len(unary)):
        p = math.exp(sum(u * v for u, v in zip(unary, y)) + sum(steps[a, b] for a, b in zip(y, y[1:])))
        z += p
        good += p * np.array(y)
        for a, b in zip(y, y[1:]):
            pair[a, b] += p
    return good / z, math.log(z), pair / z


def test_forward_backward_equals_enumeration():
    rnd = np.random.default_rng(4)
    sizes = [3, 1, 7, 1, 5, 2]
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    unary, steps = rnd.normal(0, 3, offsets[-1]), rnd.normal(0, 2, (2, 2))
    good, log_z, pair = linecrf.forward_backward(unary, offsets, steps)
    want = [enumerate_labels(unary[a:b], steps) for a, b in zip(offsets, offsets[1:])]
    assert np.allclose(good, np.concatenate([w[0] for w in want]))
    assert np.allclose(log_z, [w[1] for w in want])
    assert np.allclose(pair, sum(w[2] for w in want))


def test_extreme_potentials_and_long_texts_stay_finite():
    n = 50_000
    unary = np.where(np.arange(n) % 3 == 0, 800.0, -800.0)
    good, log_z, _ = linecrf.forward_backward(unary, np.array([0, n]), np.array([[5.0, -5.0], [-5.0, 5.0]]))
    assert np.isfinite(good).all() and np.isfinite(log_z).all() and good.min() >= 0 and good.max() <= 1


def test_fitting_raises_the_likelihood():
    rnd = np.random.default_rng(1)
    sizes = rnd.integers(1, 6, 120)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    label = rnd.integers(0, 2, 120)
    features = rnd.random((offsets[-1], len(linecrf.FEATURES)))
    features[:, 2] += np.repeat(label, sizes) * 0.4

    def likelihood(model):
        theta = np.concatenate((model.own.ravel(), model.around.ravel()))
        unary = theta[linecrf._columns(model.classes(features), offsets)].sum(1)
        _, log_z, _ = linecrf.forward_backward(unary, offsets, model.steps)
        same = model.steps[label, label] * (sizes - 1) + np.add.reduceat(unary, offsets[:-1]) * label
        return float((same - log_z).mean())

    model = linecrf.fit(features, offsets, label)
    flat = linecrf.Model(model.cuts, np.zeros_like(model.own), np.zeros_like(model.around), np.zeros((2, 2)))
    assert likelihood(model) > likelihood(flat) + 0.3


def test_features_equal_plain_counts():
    texts = ["", "One two.\nONE, TWO!\n\nOne two.", "a  b\tc | | déjà\x1cvu 12", "x x x\nx x y"]
    features, weights, offsets = linecrf.line_features(texts)
    assert offsets.tolist() == [0, 1, 5, 6, 8]
    lines = [x for t in texts for x in t.split("\n")]
    col = {name: features[:, i] for i, name in enumerate(linecrf.FEATURES)}
    assert weights.tolist() == [max(1, len(x)) for x in lines]
    for i, x in enumerate(lines):
        words = x.encode().split()
        letters = sum(c.isalpha() for c in x)
        assert col["length"][i] == pytest.approx(math.log2(len(x) + 1))
        assert col["upper"][i] == pytest.approx(sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in x) / max(1, letters))
        assert col["short_words"][i] == pytest.approx(sum(len(w) <= 3 for w in words) / max(1, len(words)))
        assert col["lone"][i] == pytest.approx(sum(w in (b"|",) for w in words) / max(1, len(words)))
    assert col["again"].tolist() == [0, 1, 0, 0, 1, 0, 0, 0]
    assert [round(x, 3) for x in col["stutter"].tolist()] == [0, 0, 0, 0, 0, round(1 / 7, 3), round(2 / 3, 3), round(2 / 3, 3)]


def test_neighbours_do_not_cross_texts():
    classes = np.arange(6)[:, None] % 4 + np.zeros((6, len(linecrf.FEATURES)), np.int64)
    alone = linecrf._columns(classes[2:4], np.array([0, 2]))
    assert np.array_equal(linecrf._columns(classes, np.array([0, 2, 4, 6]))[2:4], alone)


def test_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = linecrf.op12_crf(spark, SF).join(labels, "doc_id").collect()
    assert {r.held_out for r in got} == {True, False}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.93
    # lang, source and doc_id are no inputs, labels of held-out rows neither
    assert linecrf.op12_crf(spark, SF).count() == docs.count()


EDGES = [(None, "A line.\nAnother line of the text."), (1, None), (2, ""), (3, " \n\t \n"), (4, "x"), (5, "y " * 30_000), (6, "l\n" * 20_000), (7, "Same."), (7, "Same."), (8, "\x00 \x85 日本語")]


def test_edge_rows(spark):
    learned = spark.createDataFrame([(i, ("Good words stand here.\n" * 3) if i % 2 else "%% && !! XX %%\n" * 3) for i in range(80)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (3, None), (500, 0), (4, 7)], "doc_id long, quality int")
    model = linecrf.learn(learned, marks)
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    for name in ("row", "score", "_text", "lines", "quality"):
        df = df.withColumn(name, F.lit("clash"))
    got = linecrf.score(df, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 and r.row.score == "clash" for r in got)
    by = {r.row.doc_id: r.score for r in got}
    assert by[1] == by[2] and len({r.score for r in got if r.row.doc_id == 7}) == 1
    assert linecrf.score(df.limit(0), model).count() == 0
    assert linecrf.learn(learned.limit(0), marks) is None and linecrf.learn(learned, marks.filter("quality = 1")) is None
    assert {r.score for r in linecrf.score(df, None).collect()} == {0.5}
