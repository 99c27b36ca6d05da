"""Robust/trailing z edge cases and the distributed global rank."""
from pyspark.sql import functions as F

from plaint.operators import alerts, dashboard, refresh
from plaint.operators.alerts import robust_z, trailing_z
from plaint.operators.metrics import pr_auc, roc_auc
from plaint.operators.ranking import global_cumsum, global_row_number, ntile_from_rank
from plaint.operators.text import explain_terms


def test_robust_z_constant_series(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(10)], "i int, x double")
    zs = [r.z for r in robust_z(df, "x").collect()]
    assert zs == [0.0] * 10


def test_trailing_z_needs_history(spark):
    vals = [10.0, 11.0, 9.0, 10.0, 12.0, 10.0, 11.0, 40.0]
    df = spark.createDataFrame(list(enumerate(vals)), "i int, x double")
    out = {r.i: r for r in trailing_z(df, "x", "i").collect()}
    assert out[3].z == 0.0 and out[3].baseline == 10.0       # < 6 previous rows
    assert out[7].z > 3.5                                   # spike vs trailing median
    assert out[7].baseline == 10.0


def test_global_row_number_is_a_permutation(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 37).alias("score"))
    r = global_row_number(df, [F.col("score").desc(), F.col("id").asc()], "rn", partitions=7, total_name="n")
    rows = r.collect()
    assert sorted(x.rn for x in rows) == list(range(1, 5001))
    by_rn = sorted(rows, key=lambda x: x.rn)
    keys = [(-x.score, x.id) for x in by_rn]
    assert keys == sorted(keys)
    d = r.withColumn("d", ntile_from_rank(F.col("rn"), F.col("n"), 10)).groupBy("d").count().collect()
    assert sorted(x["count"] for x in d) == [500] * 10


def test_global_cumsum_sums_several_columns_in_one_pass(spark):
    rows = [(i, None if i % 11 == 0 else i * 7 % 5, (i % 3) / 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "i int, a long, x double").repartition(5)
    got = sorted(global_cumsum(df, [F.col("i").desc()], {"ca": "a", "cx": "x"}, partitions=6).collect(), key=lambda r: -r.i)
    a, x = 0, 0.0
    for r, (i, va, vx) in zip(got, sorted(rows, reverse=True)):
        a, x = a + (va or 0), x + vx
        assert (r.i, r.ca, r.cx) == (i, a, x)
    assert len(got) == 3000
    assert global_cumsum(df.filter("i < 0"), [F.col("i").asc()], {"ca": "a"}).count() == 0


def test_curves_equal_brute_force_with_ties(spark):
    rows = [((i * 37 % 50) / 50, int(i * 13 % 7 < 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = sum(sum(p == t for p in pos) / len(pos) * sum(p >= t for p in pos) / sum(s >= t for s, _ in rows) for t in {s for s, _ in rows})
    assert roc_auc(df, "s", "y").first().roc_auc == round(auc, 6)
    assert abs(pr_auc(df, "s", "y").first().pr_auc - ap) < 2e-6
    assert pr_auc(df.filter("s < 0"), "s", "y").first().pr_auc is None


def _fact(spark):
    rows = [(2020 if i % 17 else None, f"2020-{1 + i % 9:02d}", None if i % 5 == 0 else f"p{i % 5}", f"i{i % 3}",
             int(i % 4 == 0), int(i % 6 == 0), int(i % 5 == 1), (i % 7) / 7) for i in range(900)]
    return spark.createDataFrame(rows, "year int, year_month string, product string, issue string, is_escalated int, "
                                       "is_negative int, churn_high_risk int, sent_compound double")


def test_alert_base_holds_months_and_categories_of_one_scan(spark):
    fact = _fact(spark)
    base = alerts.alert_base(fact)
    assert base._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    want = dashboard.monthly_trend(fact)
    assert {tuple(r) for r in alerts.monthly_of(base).select(*want.columns).collect()} == {tuple(r) for r in want.collect()}
    dated = [r for r in fact.collect() if r.year is not None]
    for kind in ("product", "issue"):
        got = {r.name: (r.n, r.is_escalated_sum, r.churn_high_risk_sum) for r in base.filter(F.col("kind") == kind).collect()}
        assert got == {v: (sum(r[kind] == v for r in dated), sum(r.is_escalated for r in dated if r[kind] == v),
                           sum(r.churn_high_risk for r in dated if r[kind] == v)) for v in {r[kind] for r in dated}}


def test_hotspots_compare_with_all_rows_of_their_kind(spark):
    fact = _fact(spark)
    dated = [r for r in fact.collect() if r.year is not None]
    base_rate = sum(r.churn_high_risk for r in dated) / len(dated)
    got = alerts.alerts_hotspots(fact, min_n=100, min_lift=1.4, min_rate=0.15).collect()
    hot = [r for r in got if r.metric == "churn-risk"]
    assert [r.name for r in hot] == ["p1"]  # every row of p1 is at risk; null products count in the base, never as a spot
    assert hot[0].baseline == round(base_rate, 4) and hot[0].lift == round(1 / base_rate, 2)
    assert alerts.alerts_hotspots(fact.filter("year < 0")).count() == 0


def test_explain_terms_ranks_both_directions_in_one_window(spark):
    w = spark.createDataFrame([(d, f"t{i}", (i + d) / 10) for d in range(3) for i in range(9)], "doc int, term string, weight double")
    coef = spark.createDataFrame([(f"t{i}", float((-1) ** i * (i % 4))) for i in range(9)], "term string, coef double")
    got = {(r.doc, r.direction, r["rank"]): (r.term, r.contribution) for r in explain_terms(w, coef, "doc", 2).collect()}
    value = {r.term: r.coef for r in coef.collect()}
    want = {}
    for d in range(3):
        for direction, sign in (("up", 1), ("down", -1)):
            best = sorted((-abs(r.weight * value[r.term]), r.term) for r in w.collect() if r.doc == d and r.weight * value[r.term] * sign > 0)
            want |= {(d, direction, k + 1): (t, -v * sign) for k, (v, t) in enumerate(best[:2])}
    assert got == want


def test_refresh_merge_scores_unknown_rows_once(spark):
    cols = ", ".join(f"{c} {'string' if c.endswith(('label', 'band')) else 'int' if c == 'is_negative' else 'double'}" for c in refresh.SENT_COLS)
    fresh = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "complaint_id long, narrative string")
    cache = spark.createDataFrame([(1, .1, .2, .3, .5, "pos", "x", 0), (1, .1, .2, .3, .5, "pos", "x", 0), (2, None, None, None, None, None, None, None),
                                   (9, .1, .2, .3, .4, "pos", "x", 0)], f"complaint_id long, {cols}")
    seen = spark.sparkContext.accumulator(0)

    def score(df):
        def count(rows):
            for r in rows:
                seen.add(1)
                yield r
        df = spark.createDataFrame(df.rdd.mapPartitions(count), df.schema)
        return df.select("*", *[F.lit(-1.0).cast(cache.schema[c].dataType).alias(c) for c in refresh.SENT_COLS])

    got = refresh.refresh_merge(fresh, cache, score).collect()
    assert sorted((r.complaint_id or 0, r.narrative, r.sent_compound) for r in got) == [(0, "c", -1.0), (1, "a", .5), (2, "b", -1.0), (4, "d", -1.0)]
    assert seen.value == 3
    assert refresh.refresh_merge(fresh.limit(0), cache, score).count() == 0
