"""Models: escalation (text + categorical + numeric -> logistic regression) and
churn risk (intake-only features -> histogram gradient boosting).

Features come from the own stages of stages.py, the linear models from MLlib,
the trees from boosting.py; evaluation uses the exact relational metrics of
metrics.py on the held-out split."""
from __future__ import annotations

from contextlib import ExitStack

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import (CHURN_CATEGORICAL, CHURN_LEAKY, CHURN_NUMERIC,
                       ESCALATION_CATEGORICAL, ESCALATION_NUMERIC)
from ..session import ensure_checkpoint_dir, held
from . import metrics as M
from .boosting import HistBoost
from .stages import FillScale, FillScaleModel, LevelIndex, LevelIndexModel, TfidfTerms, TfidfTermsModel


def leakage_guard(features: list[str], leaky=CHURN_LEAKY) -> None:
    """Refuse features that define the label."""
    bad = set(features) & set(leaky)
    if bad:
        raise ValueError(f"label-defining columns used as features: {sorted(bad)}")


def text_stages(text: str, max_features: int = 5000, min_df: int = 5) -> list:
    """Sublinear smoothed L2 TF-IDF of Unicode uni- and bigrams."""
    return [TfidfTerms(inputCol=text, outputCol="_text", maxFeatures=max_features, minDF=min_df)]


def categorical_stages(cols: list[str], one_hot: bool = True, min_frequency: int = 25) -> tuple[list, list[str]]:
    """One-hot with rare levels pooled and unseen ones all zeros; or alphabetical numbers with -1 for unseen ones. Null is 'Unknown'."""
    if not one_hot:
        return [LevelIndex(inputCol=c, outputCol=f"{c}_i", unseen="minus") for c in cols], [f"{c}_i" for c in cols]
    index = [LevelIndex(inputCol=c, outputCol=f"{c}_i", minFrequency=min_frequency) for c in cols]
    # the number of unseen levels lies beyond the fitted ones; 'keep' gives it a place of its own, which dropLast drops
    hot = OneHotEncoder(inputCols=[f"{c}_i" for c in cols], outputCols=[f"{c}_v" for c in cols], handleInvalid="keep", dropLast=True)
    return [*index, hot], [f"{c}_v" for c in cols]


def numeric_stages(cols: list[str], scale: bool = True) -> tuple[list, list[str]]:
    outs = [f"{c}_n" for c in cols]
    return [FillScale(inputCols=cols, outputCols=outs, scale=scale)], outs


def train_escalation(train: DataFrame, label: str = "is_escalated", text: str = "narrative",
                     max_features: int = 5000, max_iter: int = 2000) -> PipelineModel:
    """TF-IDF + one-hot + scaled numeric -> class-weighted L2 logistic regression."""
    cats, cat_out = categorical_stages(ESCALATION_CATEGORICAL)
    nums, num_out = numeric_stages(ESCALATION_NUMERIC)
    features = [*text_stages(text, max_features), *cats, *nums, VectorAssembler(inputCols=["_text", *cat_out, *num_out], outputCol="features")]
    return _fit_linear(train.select(text, *ESCALATION_CATEGORICAL, *ESCALATION_NUMERIC, label), features, "features", label, max_iter)


def train_text_model(train: DataFrame, label: str = "is_escalated", text: str = "narrative",
                     max_features: int = 3000, max_iter: int = 2000) -> PipelineModel:
    """Text-only escalation model on narrated rows."""
    return _fit_linear(train.select(text, label), text_stages(text, max_features), "_text", label, max_iter)


def _fit_linear(train: DataFrame, stages: list, features: str, label: str, max_iter: int) -> PipelineModel:
    """The feature stages and a class-weighted L2 logistic regression. The rows are worked out once, as each stage is fitted
    in passes of its own, and so are the features; read back, they come in as few partitions as their size asks for, and each
    of the regression's many passes sends a sum for each. Neither table outlives the pass that needs it."""
    with ExitStack() as features_stay:
        with held(train, "train") as train:
            n, made = train.count(), Pipeline(stages=stages).fit(train)
            rows = features_stay.enter_context(held(M.class_weights(made.transform(train).select(features, label), label), "features"))
        linear = LogisticRegression(featuresCol=features, labelCol=label, weightCol="weight", regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                                    maxIter=max_iter, standardization=False)
        return PipelineModel([*made.stages, linear.fit(rows)])


def train_churn(train: DataFrame, label: str = "churn_risk_label", max_iter: int = 300,
                max_depth: int = 6, step: float = 0.08) -> PipelineModel:
    """Intake-only features -> histogram gradient boosting (l2 1.0, at most 31 leaves a tree)."""
    leakage_guard(CHURN_CATEGORICAL + CHURN_NUMERIC)
    cats, cat_out = categorical_stages(CHURN_CATEGORICAL, one_hot=False)
    nums, num_out = numeric_stages(CHURN_NUMERIC, scale=False)
    boost = HistBoost(inputCols=[*cat_out, *num_out], outputCol="_p", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step)
    with held(train.select(*CHURN_CATEGORICAL, *CHURN_NUMERIC, label), "train") as train:  # each stage is fitted in passes of its own
        return Pipeline(stages=[*cats, *nums, boost]).fit(train)


def score(df: DataFrame, model: PipelineModel, out: str) -> DataFrame:
    """P(class 1) for every row."""
    cols = df.columns
    p = model.transform(df)
    return p.select(*cols, (vector_to_array("probability")[1] if "probability" in p.columns else F.col("_p")).alias(out))


def evaluate(scored: DataFrame, score_col: str, label: str, n_train: int) -> DataFrame:
    """n_train, n_test, base rate, ROC-AUC, PR-AUC as one row (union + max)."""
    ensure_checkpoint_dir(scored.sparkSession)
    scored = scored.select(score_col, label).checkpoint()  # three passes, scored once
    auc = M.roc_auc(scored, score_col, label)
    ap = M.pr_auc(scored, score_col, label)
    base = scored.agg(F.count(F.lit(1)).alias("n_test"), F.avg(label).alias("base_rate"))
    parts = [auc.select("roc_auc", F.lit(None).cast("double").alias("pr_auc"),
                        F.lit(None).cast("long").alias("n_test"), F.lit(None).cast("double").alias("base_rate")),
             ap.select(F.lit(None).cast("double").alias("roc_auc"), "pr_auc",
                       F.lit(None).cast("long").alias("n_test"), F.lit(None).cast("double").alias("base_rate")),
             base.select(F.lit(None).cast("double").alias("roc_auc"), F.lit(None).cast("double").alias("pr_auc"),
                         "n_test", "base_rate")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.agg(F.lit(n_train).alias("n_train"), *[F.max(c).alias(c) for c in
                                                    ("n_test", "base_rate", "roc_auc", "pr_auc")])


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the linear model's features, in the order of its coefficients."""
    stages = {c: s for s in model.stages for c in ([s.getOutputCol()] if isinstance(s, (TfidfTermsModel, LevelIndexModel)) else [])}
    names = [f"text__{t}" for t in stages["_text"].terms] or ["text__"]
    for s in model.stages:
        if isinstance(s, LevelIndexModel):
            names += [f"cat__{s.getInputCol()}_{level}" for level in s.names()]
    for s in model.stages:
        if isinstance(s, FillScaleModel):
            names += [f"num__{c}" for c in s.getInputCols()]
    return names


def top_terms(model: PipelineModel, k: int = 20) -> list[tuple[str, float]]:
    """k largest coefficients over all features, with the features' names (the model's weights live
    on the driver already; this reads them, it does not move data)."""
    names, coefs = feature_names(model), model.stages[-1].coefficients.toArray()
    order = sorted(range(len(coefs)), key=lambda i: (-coefs[i], names[i]))[:k]
    return [(names[i], float(coefs[i])) for i in order]


def export_text_model(model: PipelineModel) -> list[tuple[str, float | None, float]]:
    """(term, idf, coef) of a fitted text model, 5 decimals; the row without idf holds the intercept."""
    terms, linear = model.stages[0], model.stages[-1]
    rows = [(t, round(float(i), 5), round(float(c), 5)) for t, i, c in zip(terms.terms, terms.idf, linear.coefficients.toArray())]
    return [("(intercept)", None, round(float(linear.intercept), 5)), *rows]
