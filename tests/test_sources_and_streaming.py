"""Readers and streaming refresh on small rows: date forms, header order, corrupt records, retries, duplicate ids."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaint.operators import refresh as RF
from plaint.operators import text as T
from plaint.schemas import BULK_COLUMN_MAP
from plaint.sources import files
from plaint.streaming import jobs


def test_date_forms(spark):
    day = dt.datetime(2024, 3, 1)
    forms = ["2024-03-01T00:00:00.000Z", "2024-03-01T00:00:00.000000+00:00", "2024-03-01 00:00:00.000", "20240301", "03/01/24", "3/1/2024", " 2024-03-01 "]
    df = spark.createDataFrame([(f,) for f in [*forms, "soon", "", None]], "d string")
    got = [r.d for r in df.select(files.safe_timestamp(F.col("d")).alias("d")).collect()]
    assert got == [day] * len(forms) + [None] * 3
    assert tuple(files.unparsed_dates(df, "d").first()) == (len(forms) + 1, 1)
    typed = spark.createDataFrame([(dt.datetime(2024, 3, 1, 1, 2, 3, 456),)], "date_received timestamp")
    assert files.coerce_types(typed).first().date_received == dt.datetime(2024, 3, 1, 1, 2, 3, 456)


def test_company_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("A", 1), ("B", 2)], "company string, n int").write.parquet(str(tmp_path / "t"))
    df = files.source_company_filter(spark.read.parquet(str(tmp_path / "t")), "A")
    assert "EqualTo(company,A)" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in df.collect()] == [1]


def test_csv_header_order_and_malformed_lines(spark, tmp_path):
    head = list(BULK_COLUMN_MAP)
    row = {h: f"v{i}" for i, h in enumerate(head)} | {"Date received": "2024-03-01"}
    line = ",".join(row[h] for h in head)
    (tmp_path / "a.csv").write_text(",".join(head) + "\n" + line + "\n" + line + ",one too many\n")
    got = files.read_bulk_csv(spark, str(tmp_path / "a.csv"), multiline=False).collect()
    assert len(got) == 1 and got[0].company == row["Company"] and got[0].date_received == dt.datetime(2024, 3, 1)
    assert tuple(files.count_corrupt_csv(spark, str(tmp_path / "a.csv"), multiline=False).first()) == (2, 1)
    (tmp_path / "b.csv").write_text(",".join(head[::-1]) + "\n" + ",".join(row[h] for h in head[::-1]) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_bulk_csv(spark, str(tmp_path), multiline=False).collect()


def test_corrupt_json_is_counted_and_left_out(spark, tmp_path):
    (tmp_path / "h.json").write_text('{"_id": "1", "_source": {"complaint_id": "1", "company": "A"}}\n{"_id": \n')
    assert [r.complaint_id for r in files.read_cases_json(spark, str(tmp_path / "h.json"), multiline=False).collect()] == [1]
    assert tuple(files.count_corrupt_json(spark, str(tmp_path / "h.json"), multiline=False).first()) == (2, 1)


def _score(df):
    neutral = {c: F.lit(0.0) for c in RF.SENT_COLS[:4]} | {"sentiment_label": F.lit("neutral"), "sentiment_band": F.lit("mid"), "is_negative": F.lit(0)}
    return df.withColumns(neutral).withColumn("sent_compound", F.length("narrative").cast("double"))


def test_refresh_step_survives_duplicates_crash_and_replay(spark, tmp_path):
    cache, log = str(tmp_path / "cache"), str(tmp_path / "log")
    schema = "complaint_id long, narrative string"
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, "bb")], schema)
    second = spark.createDataFrame([(2, "bb"), (3, "ccc")], schema)
    jobs.refresh_step(spark, first, 0, cache, log, _score)

    def fails(batch_id):
        raise RuntimeError("between the two writes")
    with pytest.raises(RuntimeError):
        jobs.refresh_step(spark, second, 1, cache, log, _score, retrain=fails)
    for _ in range(2):  # the retry, and a replay of a finished batch
        jobs.refresh_step(spark, second, 1, cache, log, _score, retrain=lambda b: True)
    rows = spark.read.parquet(cache)
    assert sorted((r.complaint_id, r.sent_compound) for r in rows.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    stamps = sorted((r.batch_id, r.rows, r.new_rows, r.retrained) for r in spark.read.parquet(log).collect())
    assert stamps == [(0, 2, 2, False), (1, 3, 1, True)]


def test_text_terms_and_scores(spark):
    df = spark.createDataFrame([(1, "Müller straße, the bank bank"), (2, "the of"), (3, None)], "k int, t string")
    ascii_terms = {r.term for r in T.tokenize_terms(df, "k", "t", 1).collect()}
    assert {"bank", "ller"} <= ascii_terms and "the" not in ascii_terms
    terms = {r.term for r in T.tokenize_terms(df, "k", "t", 2, T.UNICODE_TERMS).collect()}
    assert terms == {"müller", "straße", "bank", "müller straße", "straße bank", "bank bank"}
    weights = spark.createDataFrame([(1, "bank", 1.0)], "k int, term string, weight double")
    coef = spark.createDataFrame([("bank", 2.0)], "term string, coef double")
    got = {r.k: (r.matched, round(r.prob, 6)) for r in T.score_linear_terms(weights, coef, "k", -2.0, df).collect()}
    assert got == {1: (1, 0.5), 2: (0, 0.119203), 3: (0, 0.119203)}


def test_unseen_and_rare_levels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    levels = T.ordinal_levels(df, "c")
    new = spark.createDataFrame([("a",), ("b",), ("z",), (None,)], "c string")
    assert {r.c: r.c_code for r in T.ordinal_encode(new, "c", levels=levels).collect()} == {"a": 0, "b": 1, "z": -1, None: -1}
    assert sorted(r.c for r in T.rare_pool(df, "c", 2).collect()) == ["__rare__", "__rare__", "b", "b"]


@pytest.mark.parametrize("rows,distinct,files", [(5000, 5000, 48), (40, 3, 3)])
def test_landed_batches_are_written_by_many_tasks(spark, rows, distinct, files):
    """Three micro-batches, whatever the number of landed files; no file holds a third of a table with many ids."""
    import math

    from plaint.plans import q_stream as Q
    df = spark.range(rows).selectExpr(f"id % {distinct} AS complaint_id", "id AS n")
    _, src, _, per_trigger = Q._land_batches(spark, df, 3, "complaint_id")
    got = spark.read.parquet(src)
    landed = len(got.inputFiles())
    assert math.ceil(landed / per_trigger) == 3 and got.count() == rows and landed >= 0.9 * files
    if distinct == rows:
        assert got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] < rows / 10
