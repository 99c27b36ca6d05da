"""Flags, labels and bands as column expressions (no Python UDFs)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (CHURN_HIGH_RISK_CUTOFF, ESCALATION_CUTOFF,
                       NEGATIVE_THRESHOLD, RELIEF_RESPONSES)
from .text import py_strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _norm(c) -> Column:
    return F.lower(py_strip(_c(c)))


def timely_yes(timely) -> Column:
    """'yes' in any case/padding -> true; null -> false."""
    return F.coalesce(_norm(timely) == "yes", F.lit(False))


def timely_no(timely) -> Column:
    """'no' in any case/padding -> true; null counts as neither yes nor no."""
    return F.coalesce(_norm(timely) == "no", F.lit(False))


def relief(response) -> Column:
    """Exactly the two relief responses (legacy 'Closed with relief' is not)."""
    return F.coalesce(_c(response).isin(*RELIEF_RESPONSES), F.lit(False))


def timely_flag(timely) -> Column:
    return timely_yes(timely).cast("int")


def relief_flag(response) -> Column:
    return relief(response).cast("int")


def label_escalated(response, timely) -> Column:
    """is_escalated = relief OR untimely."""
    return (relief(response) | timely_no(timely)).cast("int")


def is_negative(compound, threshold: float = NEGATIVE_THRESHOLD) -> Column:
    return F.coalesce(_c(compound) <= F.lit(threshold), F.lit(False)).cast("int")


def label_churn_proxy(compound, timely_flag_col, relief_flag_col, response,
                      threshold: float = NEGATIVE_THRESHOLD) -> Column:
    """Negative sentiment AND a service failure (untimely, no relief, or dispute)."""
    negative = F.coalesce(_c(compound) <= F.lit(threshold), F.lit(False))
    disputed = F.coalesce(F.lower(_c(response)).contains("dispute"), F.lit(False))
    failure = (F.coalesce(_c(timely_flag_col) == 0, F.lit(False))
               | F.coalesce(_c(relief_flag_col) == 0, F.lit(False))
               | disputed)
    return (negative & failure).cast("int")


def score_flag(score, cutoff: float) -> Column:
    return F.coalesce(_c(score) >= F.lit(cutoff), F.lit(False)).cast("int")


def escalation_flag(score, cutoff: float = ESCALATION_CUTOFF) -> Column:
    return score_flag(score, cutoff)


def churn_high_risk(score, cutoff: float = CHURN_HIGH_RISK_CUTOFF) -> Column:
    return score_flag(score, cutoff)


def sentiment_label(compound) -> Column:
    c = _c(compound)
    return (F.when(c >= 0.05, "Positive").when(c <= -0.05, "Negative").otherwise("Neutral"))


def sentiment_band(compound) -> Column:
    c = _c(compound)
    return (F.when(c <= -0.6, "Very Negative").when(c <= -0.05, "Negative")
            .when(c < 0.05, "Neutral").when(c < 0.6, "Positive").otherwise("Very Positive"))


def status_band(rate, critical: float = 0.35, warning: float = 0.25) -> Column:
    """KPI status colour helper: critical / warning / good."""
    r = _c(rate)
    return F.when(r >= critical, "critical").when(r >= warning, "warning").otherwise("good")


def severity_band(absz) -> Column:
    """|z| >= 4.5 critical, >= 3.5 serious, else warning."""
    z = _c(absz)
    return F.when(z >= 4.5, "critical").when(z >= 3.5, "serious").otherwise("warning")


def lift_severity(lift) -> Column:
    x = _c(lift)
    return F.when(x >= 2.0, "critical").when(x >= 1.7, "serious").otherwise("warning")


def safe_rate(num, den) -> Column:
    """DIVIDE(): null when the denominator is zero or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def row_risk(*cols) -> Column:
    """Max of the given scores, ignoring nulls."""
    return F.greatest(*[_c(c) for c in cols])
