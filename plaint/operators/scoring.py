"""Attach model scores, flags and the churn-proxy label; closed projection."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..schemas import SCORED_COLUMNS


def attach_scores(df: DataFrame, escalation_score: Column, churn_risk_score: Column) -> DataFrame:
    """escalation_score/flag, churn_risk_label (proxy), churn_risk_score/high-risk."""
    return df.withColumns({
        "escalation_score": escalation_score.cast("double"),
        "churn_risk_label": labels.label_churn_proxy("sent_compound", "timely_flag",
                                                     "relief_flag", "company_response"),
        "churn_risk_score": churn_risk_score.cast("double"),
    }).withColumns({
        "escalation_flag": labels.escalation_flag("escalation_score"),
        "churn_high_risk": labels.churn_high_risk("churn_risk_score"),
    })


def select_scored(df: DataFrame) -> DataFrame:
    """The closed 33-column projection of the scored fact table."""
    return df.select(*SCORED_COLUMNS)


def repair_score_types(df: DataFrame) -> DataFrame:
    """After a cache join: scores -> double (bad -> null), is_negative null -> 0."""
    out = {c: F.col(c).cast("string").try_cast("double")
           for c in ("sent_neg", "sent_neu", "sent_pos", "sent_compound") if c in df.columns}
    if "is_negative" in df.columns:
        out["is_negative"] = F.coalesce(F.col("is_negative").cast("string").try_cast("int"), F.lit(0))
    return df.withColumns(out)
