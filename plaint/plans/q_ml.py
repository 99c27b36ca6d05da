"""Model queries: exact metrics, split and feature helpers (with oracles), and
training / scoring (rows-only: fitted models are not SQL-expressible).

Metric queries evaluate the scored fact's escalation score against the
escalation label; the model queries train on the stratified split of it."""
from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import metrics as M
from ..operators import models as ML
from ..operators import selection as S
from ..operators import text as T
from ..schemas import CHURN_CATEGORICAL, CHURN_NUMERIC, ESCALATION_CATEGORICAL, ESCALATION_NUMERIC
from ..session import scratch_path
from ..sources import fixtures as fx
from .registry import query
from .sql_views import R, scored, with_

LEX = (fx.FIXTURE_LEXICON, fx.FIXTURE_BOOSTERS, fx.FIXTURE_NEGATIONS, fx.FIXTURE_IDIOMS)
_S = with_(*scored(LEX), """g AS (SELECT escalation_score AS s, sum(CASE WHEN is_escalated = 1 THEN 1 ELSE 0 END) AS pos,
  sum(CASE WHEN is_escalated = 1 THEN 0 ELSE 1 END) AS neg FROM scored WHERE escalation_score IS NOT NULL GROUP BY 1)""")


def _fact(spark, sf):
    return fx.scored_fact(spark, sf)


@query("roc_auc", _S + f"""SELECT {R('sum(pos * ((cneg - neg) + 0.5 * neg)) / (sum(pos) * sum(neg))', 6)} AS roc_auc
FROM (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cneg FROM g) c""")
def q_roc_auc(spark, sf):
    """Exact rank-based AUC, ties averaged."""
    return M.roc_auc(_fact(spark, sf), "escalation_score", "is_escalated")


@query("pr_auc", _S + f"""SELECT {R('sum(pos * tp * 1.0 / (tp + fp)) / sum(pos)', 6)} AS pr_auc
FROM (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp FROM g) c""")
def q_pr_auc(spark, sf):
    """Average precision over distinct thresholds."""
    return M.pr_auc(_fact(spark, sf), "escalation_score", "is_escalated")


def _prf(tp, fp, fn):
    p = f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fp}, 0), 0.0)"
    r = f"coalesce(CAST({tp} AS DOUBLE) / nullif({tp} + {fn}, 0), 0.0)"
    f = f"coalesce(2 * ({p}) * ({r}) / nullif(({p}) + ({r}), 0), 0.0)"
    return p, r, f


_P1, _R1, _F1 = _prf("tp", "fp", "fn")
_P0, _R0, _F0 = _prf("tn", "fn", "fp")


@query("classification_report", _S + f""", cm AS (
  SELECT count(*) FILTER (WHERE is_escalated = 1 AND escalation_score >= 0.5) AS tp,
         count(*) FILTER (WHERE is_escalated = 0 AND escalation_score >= 0.5) AS fp,
         count(*) FILTER (WHERE is_escalated = 1 AND NOT coalesce(escalation_score >= 0.5, false)) AS fn,
         count(*) FILTER (WHERE is_escalated = 0 AND NOT coalesce(escalation_score >= 0.5, false)) AS tn FROM scored)
SELECT '0' AS class, {R(_P0, 6)} AS precision, {R(_R0, 6)} AS recall, {R(_F0, 6)} AS f1, tn + fp AS support FROM cm
UNION ALL SELECT '1', {R(_P1, 6)}, {R(_R1, 6)}, {R(_F1, 6)}, tp + fn FROM cm
UNION ALL SELECT 'macro avg', {R(f'(({_P0}) + ({_P1})) / 2', 6)}, {R(f'(({_R0}) + ({_R1})) / 2', 6)},
                 {R(f'(({_F0}) + ({_F1})) / 2', 6)}, tp + fn + tn + fp FROM cm
UNION ALL SELECT 'weighted avg', {R(f'(({_P0}) * (tn + fp) + ({_P1}) * (tp + fn)) / (tp + fn + tn + fp)', 6)},
                 {R(f'(({_R0}) * (tn + fp) + ({_R1}) * (tp + fn)) / (tp + fn + tn + fp)', 6)},
                 {R(f'(({_F0}) * (tn + fp) + ({_F1}) * (tp + fn)) / (tp + fn + tn + fp)', 6)}, tp + fn + tn + fp FROM cm
UNION ALL SELECT 'accuracy', {R('(tp + tn) * 1.0 / (tp + fn + tn + fp)', 6)}, {R('(tp + tn) * 1.0 / (tp + fn + tn + fp)', 6)},
                 {R('(tp + tn) * 1.0 / (tp + fn + tn + fp)', 6)}, tp + fn + tn + fp FROM cm""".replace("\n, cm AS", ",\ncm AS"))
def q_classification_report(spark, sf):
    """Precision / recall / F1 / support per class, accuracy, macro and weighted."""
    return M.classification_report(_fact(spark, sf), "escalation_score", "is_escalated")


@query("stratified_split", with_(*scored(LEX)) + """
SELECT complaint_id, is_escalated, CASE WHEN row_number() OVER (PARTITION BY is_escalated ORDER BY md5(CAST(complaint_id AS VARCHAR)), complaint_id)
                      <= round(0.2 * count(*) OVER (PARTITION BY is_escalated)) THEN 'test' ELSE 'train' END AS split
FROM scored""")
def q_stratified_split(spark, sf):
    """Deterministic 80/20 split stratified on the label (md5 order), per id."""
    return M.stratified_split(_fact(spark, sf), "complaint_id", "is_escalated").select("complaint_id", "is_escalated", "split")


@query("class_weights", with_(*scored(LEX)) + f"""
SELECT is_escalated, count(*) AS n, {R('sum(count(*)) OVER () / (2.0 * count(*))', 6)} AS weight FROM scored GROUP BY 1""")
def q_class_weights(spark, sf):
    """Balanced class weights n / (2 n_class)."""
    w = M.class_weights(_fact(spark, sf), "is_escalated")
    return w.groupBy("is_escalated").agg(F.count(F.lit(1)).alias("n"), rnd(F.max("weight"), 6).alias("weight"))


@query("impute_scale", with_(*scored(LEX)) + " UNION ALL ".join(
    f"SELECT '{c}' AS column, {R(f'median(CAST({c} AS DOUBLE))', 6)} AS median, {R(f'avg({c})', 6)} AS mean, "
    f"{R(f'stddev_pop({c})', 6)} AS std FROM scored" for c in ("handling_days", "narrative_length", "sent_compound")))
def q_impute_scale(spark, sf):
    """Exact median (imputation), mean and population std of numeric features."""
    return M.impute_scale_stats(_fact(spark, sf), ["handling_days", "narrative_length", "sent_compound"])


_NUMBERS = ("handling_days", "narrative_length", "sent_compound")


@query("impute_scale_rows", with_(*scored(LEX), "m AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS m{i}" for i, c in enumerate(_NUMBERS)) + " FROM scored)",
       "filled AS (SELECT complaint_id, " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), m{i}) AS f{i}" for i, c in enumerate(_NUMBERS)) + " FROM scored, m)",
       "t AS (SELECT " + ", ".join(f"avg(f{i}) AS a{i}, stddev_pop(f{i}) AS s{i}" for i in range(3)) + " FROM filled)")
       + "SELECT complaint_id, " + ", ".join(f"{R(f'(f{i} - a{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END', 4)} AS {c}_scaled" for i, c in enumerate(_NUMBERS)) + " FROM filled, t")
def q_impute_scale_rows(spark, sf):
    """Numeric features with nulls as the exact median, standardised by mean and population deviation."""
    f = _fact(spark, sf).select("complaint_id", *_NUMBERS)
    got = S.impute_scale(f, S.fit_impute_scale(f, list(_NUMBERS)))
    return got.select("complaint_id", *[rnd(F.col(f"{c}_scaled"), 4).alias(f"{c}_scaled") for c in _NUMBERS])


@query("ordinal_encode", with_(*scored(LEX)) + """
SELECT issue, CAST(dense_rank() OVER (ORDER BY issue) - 1 AS INTEGER) AS issue_code FROM (SELECT DISTINCT issue FROM scored) d""")
def q_ordinal_encode(spark, sf):
    """Alphabetical 0-based codes of a categorical feature."""
    e = T.ordinal_encode(_fact(spark, sf).select("issue"), "issue")
    return e.select("issue", F.col("issue_code").cast("int")).distinct()


@query("onehot_rare", with_(*scored(LEX)) + """
SELECT CASE WHEN cnt >= 25 THEN state ELSE '__rare__' END AS state, sum(cnt) AS n FROM (
  SELECT state, count(*) AS cnt FROM scored GROUP BY 1) g GROUP BY 1""")
def q_onehot_rare(spark, sf):
    """Categories under a row threshold pooled into one level before encoding."""
    p = T.rare_pool(_fact(spark, sf).select("state"), "state", 25)
    return p.groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("score_parity", with_(*scored(LEX)) + f"""
SELECT {R('max(abs(escalation_score - greatest(escalation_score, churn_risk_score)))', 6)} AS max_abs_diff FROM scored""")
def q_score_parity(spark, sf):
    """Max absolute difference between two score columns."""
    f = _fact(spark, sf).withColumn("risk", F.greatest("escalation_score", "churn_risk_score"))
    return M.score_parity(f, "escalation_score", "risk")


# ---- fitted models: rows-only checks ------------------------------------------

def _split(spark, sf, label, features):
    """(train, test) rows: the cuts are found once per application, input folder, label and features."""
    key = (spark.sparkContext.applicationId, sf, ",".join([label, *features]))
    if key not in _SPLITS:
        _SPLITS[key] = M.stratified_split(_fact(spark, sf).select("complaint_id", label, *features), "complaint_id", label)
    return tuple(_SPLITS[key].filter(F.col("split") == part).drop("split") for part in ("train", "test"))


_FITTED: dict[tuple[str, str, str], tuple[str, int]] = {}
_SPLITS: dict[tuple[str, str, str], DataFrame] = {}
_FEATURES = {"escalation": ["narrative", *ESCALATION_CATEGORICAL, *ESCALATION_NUMERIC], "churn": [*CHURN_CATEGORICAL, *CHURN_NUMERIC],
             "text": ["narrative", "has_narrative"]}
_KINDS = {"escalation": ("is_escalated", ML.train_escalation), "churn": ("churn_risk_label", ML.train_churn), "text": ("is_escalated", ML.train_text_model)}


def _parts(spark, sf, kind):
    """(train, test) rows of a model; the text model knows narrated rows only."""
    label = _KINDS[kind][0]
    return tuple(x.filter(F.col("has_narrative") == 1) if kind == "text" else x for x in _split(spark, sf, label, _FEATURES[kind]))


def _fitted(spark, sf, kind):
    """(the model, training rows): fitted with the reference settings once per application and input folder, saved and loaded."""
    key = (spark.sparkContext.applicationId, sf, kind)
    if key not in _FITTED:
        path = scratch_path(spark, f"model_{kind}_{uuid.uuid4().hex}")
        train = _parts(spark, sf, kind)[0]
        _KINDS[kind][1](train).write().save(path)
        _FITTED[key] = (path, train.count())
    path, n = _FITTED[key]
    return PipelineModel.load(path), n


def _report(spark, sf, kind):
    model, n = _fitted(spark, sf, kind)
    return ML.evaluate(ML.score(_parts(spark, sf, kind)[1], model, "p"), "p", _KINDS[kind][0], n)


@query("train_escalation")
def q_train_escalation(spark, sf):
    """TF-IDF + one-hot + numeric -> weighted logistic regression; test metrics."""
    return _report(spark, sf, "escalation")


@query("train_churn")
def q_train_churn(spark, sf):
    """Intake-only features -> histogram gradient boosting (300 trees at most, depth 6, l2 1.0) on the churn proxy label."""
    return _report(spark, sf, "churn")


@query("train_text_model")
def q_train_text_model(spark, sf):
    """Text-only escalation model on narrated rows."""
    return _report(spark, sf, "text")


@query("score_model")
def q_score_model(spark, sf):
    """P(class 1) for every row from the fitted churn model, flagged at 0.5."""
    s = ML.score(_fact(spark, sf), _fitted(spark, sf, "churn")[0], "churn_score")
    return s.select("complaint_id", "churn_score", (F.col("churn_score") >= 0.5).cast("int").alias("flag"))


@query("top_terms")
def q_top_terms(spark, sf):
    """The 15 largest coefficients of the escalation model over all its features."""
    return spark.createDataFrame(ML.top_terms(_fitted(spark, sf, "escalation")[0], 15), "feature string, weight double")


@query("model_export_fitted")
def q_model_export_fitted(spark, sf):
    """(term, idf, coef) of the fitted text model, and its intercept, at 5 dp."""
    return spark.createDataFrame(ML.export_text_model(_fitted(spark, sf, "text")[0]), "term string, idf double, coef double")


@query("model_parity", "SELECT 'text' AS model, true AS within_limit")
def q_model_parity(spark, sf):
    """The relational scorer on the exported table against the fitted pipeline: the greatest difference stays below 0.02."""
    model, _ = _fitted(spark, sf, "text")
    head, *rows = ML.export_text_model(model)
    exported = spark.createDataFrame(rows, "term string, idf double, coef double")
    fact = _fact(spark, sf).filter(F.col("has_narrative") == 1).select("complaint_id", "narrative")
    terms = T.tokenize_terms(fact, "complaint_id", "narrative", pattern=T.UNICODE_TERMS)
    known = terms.join(F.broadcast(exported.select("term")), "term", "left_semi")  # the weights are those of exported terms
    # dealt by case, which counts, lengths and scores all group by
    counts = T.term_counts(known.select("complaint_id", "term").repartition("complaint_id"), "complaint_id")
    mine = T.score_linear_terms(T.tfidf(counts, exported, "complaint_id"), exported, "complaint_id", head[2], fact)
    both = mine.join(ML.score(fact, model, "p"), "complaint_id")
    return both.agg(F.lit("text").alias("model"), (F.max(F.abs(F.col("prob") - F.col("p"))) < 0.02).alias("within_limit"))


@query("leakage_guard")
def q_leakage_guard(spark, sf):
    """Intake features pass the label-leakage check; the churn fact is read."""
    ML.leakage_guard(CHURN_CATEGORICAL + CHURN_NUMERIC)
    f = _fact(spark, sf).select(*CHURN_CATEGORICAL, *CHURN_NUMERIC)
    return f.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(f.columns)).alias("features"))


@query("model_report_card")
def q_model_report_card(spark, sf):
    """Escalation and churn AUCs and split sizes, one row per model, with the escalation model's top 15 terms."""
    top = [name for name, _ in ML.top_terms(_fitted(spark, sf, "escalation")[0], 15)]
    e = _report(spark, sf, "escalation").withColumn("model", F.lit("escalation")).withColumn("top_terms", F.array(*map(F.lit, top)))
    c = _report(spark, sf, "churn").withColumn("model", F.lit("churn")).withColumn("top_terms", F.lit(None).cast("array<string>"))
    return e.unionByName(c)
