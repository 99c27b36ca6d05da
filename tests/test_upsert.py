"""The scored table under duplicates, crashes, replays and a model change."""
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaint.operators import refresh as RF
from plaint.streaming import upsert as U

SCHEMA = T.StructType([T.StructField("complaint_id", T.LongType()), T.StructField("narrative", T.StringType()),
                       *[T.StructField(c, T.DoubleType()) for c in RF.SENT_COLS[:4]], *[T.StructField(c, T.StringType()) for c in RF.SENT_COLS[4:6]],
                       T.StructField("is_negative", T.IntegerType()), T.StructField("p", T.DoubleType())])
CALLS = []


def enrich(df):
    CALLS.append(sorted((r.complaint_id for r in df.select("complaint_id").collect()), key=str))
    fixed = {c: F.lit(0.0) for c in RF.SENT_COLS[:3]} | {"sentiment_label": F.lit("n"), "sentiment_band": F.lit("m"), "is_negative": F.lit(0)}
    return df.withColumns(fixed).withColumn("sent_compound", F.length("narrative").cast("double"))


def train(df):
    """A model that scores with the number of rows it was trained on."""
    return Pipeline(stages=[SQLTransformer(statement=f"SELECT *, CAST({df.count()} AS DOUBLE) AS p FROM __THIS__")]).fit(df)


def score(df, model):
    return model.transform(df)


def step(table, rows, batch_id, retrain=False, **kw):
    batch = table.spark.createDataFrame(rows, "complaint_id long, narrative string")
    U.upsert_step(table, batch, batch_id, enrich, kw.get("train", train), score, SCHEMA, lambda b: retrain)


def state(table):
    return {r.complaint_id: (r.narrative, r.sent_compound, r.p) for r in table.read(SCHEMA).collect()}


@pytest.fixture
def table(spark, tmp_path):
    CALLS.clear()
    return U.ScoredTable(spark, str(tmp_path / "t"), buckets=8)


def test_duplicates_cached_sentiment_and_untouched_buckets(table):
    step(table, [(i, "a") for i in range(20)] + [(3, "a"), (3, "a")], 0)
    assert state(table) == {i: ("a", 1.0, 20.0) for i in range(20)}
    before = table.paths()
    step(table, [(3, "longer"), (3, "longer"), (99, "bb")], 1)
    want = {i: ("a", 1.0, 20.0) for i in range(20)} | {3: ("longer", 1.0, 20.0), 99: ("bb", 2.0, 20.0)}
    assert state(table) == want and CALLS[1] == [99]  # a known id keeps its sentiment, all else is fresh
    changed = {b for b, p in table.paths().items() if before.get(b) != p}
    assert 1 <= len(changed) <= 2 and table.read(SCHEMA).count() == 21


def test_scores_change_exactly_where_a_batch_retrains(table):
    step(table, [(1, "a"), (2, "b")], 0)
    step(table, [(3, "c")], 1)
    assert {p for _, _, p in state(table).values()} == {2.0}
    step(table, [(4, "d")], 2, retrain=True)
    assert {p for _, _, p in state(table).values()} == {4.0}
    stamps = sorted((r.batch_id, r.rows, r.new_rows, r.retrained) for r in U.progress(table).collect())
    assert stamps == [(0, 2, 2, True), (1, 3, 1, False), (2, 4, 1, True)]


@pytest.mark.parametrize("where", ["rewrite", "_commit", "pointer", "log"])
def test_crash_and_replay(table, monkeypatch, where):
    step(table, [(1, "a"), (2, "b")], 0)

    def fails(*args, **kw):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        if where == "rewrite":
            m.setattr(U.ScoredTable, "rewrite", fails)
        elif where == "_commit":
            m.setattr(U, "_commit", fails)
        elif where == "pointer":
            inner = U._commit
            m.setattr(U, "_commit", lambda rows, folder, v: fails() if folder.endswith("pointer") else inner(rows, folder, v))
        else:
            m.setattr(U.RF, "refresh_log", fails)
        with pytest.raises(RuntimeError):
            step(table, [(2, "bb"), (3, "c")], 1, retrain=True)
        if where in ("rewrite", "_commit"):
            assert state(table) == {1: ("a", 1.0, 2.0), 2: ("b", 1.0, 2.0)}  # nothing of a broken batch is seen
    for _ in range(2):  # the retry, and a replay of a finished batch
        step(table, [(2, "bb"), (3, "c")], 1, retrain=True)
        assert state(table) == {1: ("a", 1.0, 3.0), 2: ("bb", 1.0, 3.0), 3: ("c", 1.0, 3.0)}
    assert sorted((r.batch_id, r.rows, r.new_rows) for r in U.progress(table).collect()) == [(0, 2, 2), (1, 3, 1)]


def test_empty_batch_and_null_id(table):
    step(table, [(None, "x"), (None, "x"), (1, "y")], 0)
    step(table, [], 1)
    step(table, [(None, "zz")], 2)
    assert state(table) == {None: ("zz", 1.0, 2.0), 1: ("y", 1.0, 2.0)}


def test_query_works_its_cases_out_once(spark, monkeypatch):
    """The union of all cases and those that come again, whose ranges are sampled besides, reads written cases."""
    from plaint.plans import q_stream as Q

    class Seen(Exception):
        pass

    def land(spark, df, *_):
        raise Seen(df.inputFiles())

    monkeypatch.setattr(Q, "_land_batches", land)
    with pytest.raises(Seen) as got:
        Q.q_stream_upsert(spark, "/root/testdata/sf0.001")
    assert got.value.args[0] and all("/cases_" in f for f in got.value.args[0])
