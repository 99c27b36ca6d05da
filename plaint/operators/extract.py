"""The dashboard extract: its eleven sections as tables, one row per record of a section."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from . import alerts as A
from . import dashboard as D
from . import mis

# --- fixed values: heads of the breakdown and risk tables (None: all rows), months of the industry benchmark ---
BREAKDOWNS = (("product", "product", 8), ("issue", "issue", 10), ("state", "state", 12), ("channel", "submitted_via", None),
              ("company_response", "company_response", None), ("sentiment_band", "sentiment_band", None))
RISKS = (("escalation_by_issue", "issue", "is_escalated", 10), ("escalation_by_product", "product", "is_escalated", 8),
         ("churn_by_issue", "issue", "churn_high_risk", 10))
BENCHMARK_SINCE = "2019-01"
TOP_TERMS = 15


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def breakdowns(fact: DataFrame) -> DataFrame:
    return _stack([D.value_counts(fact, c, top).select(F.lit(name).alias("chart"), "label", "value") for name, c, top in BREAKDOWNS])


def risk(fact: DataFrame) -> DataFrame:
    rates = [D.rate_by(fact, by, c, top).select(F.lit(name).alias("lens"), "label", "n", "rate") for name, by, c, top in RISKS]
    return _stack([*rates, D.sentiment_by_product(fact).select(F.lit("sentiment_by_product").alias("lens"), "label", "avg_sentiment")])


def models(cards: DataFrame, top_terms: DataFrame | None) -> DataFrame:
    """Report cards (model, roc_auc, pr_auc, n_train, n_test) and the first escalation terms (feature, weight)."""
    cards = cards.select(F.lit("card").alias("item"), "*")
    if top_terms is None:
        return cards
    terms = top_terms.orderBy(F.col("weight").desc(), "feature").limit(TOP_TERMS)
    return _stack([cards, terms.select(F.lit("term").alias("item"), F.col("feature").alias("term"), rnd("weight", 3).alias("weight"))])


def industry(monthly: DataFrame, league: DataFrame, since: str = BENCHMARK_SINCE) -> DataFrame:
    top = mis.industry_context(league).select(F.lit("company").alias("item"), "*")
    return _stack([top, mis.industry_benchmark(monthly, since).select(F.lit("month").alias("item"), "*")])


def alert_lists(fact: DataFrame, monthly_trend: DataFrame, limits: dict | None = None) -> DataFrame:
    """Attention, anomalies, hotspots, their counts by severity and the timeline. ``limits`` may hold other
    thresholds than the defaults: keyword arguments under attention, anomalies, hotspots and timeline."""
    limits = limits or {}
    att = A.alerts_attention(monthly_trend, **limits.get("attention", {}))
    ano = A.alerts_anomalies(monthly_trend, **limits.get("anomalies", {}))
    hot = A.alerts_hotspots(fact, **limits.get("hotspots", {}))
    line = A.alerts_timeline(monthly_trend, ano, **limits.get("timeline", {}))
    return _stack([A.stack_alerts(att, ano, hot), A.alerts_counts(att, hot).select(F.lit("counts").alias("lens"), "severity", "n"),
                   line.select(F.lit("timeline").alias("lens"), "metric", F.col("ym").alias("where"), "value", "z", "flag")])


def extract_sections(fact: DataFrame, mis_monthly: DataFrame, league: DataFrame, model_cards: DataFrame, company: str,
                     source: str, top_terms: DataFrame | None = None, since: str = BENCHMARK_SINCE,
                     alert_limits: dict | None = None, trend: DataFrame | None = None) -> dict[str, DataFrame]:
    """Section name -> table. ``trend`` is a landed ``monthly_trend`` of the fact, which the monthly section and
    all alert lists read; without it the fact is read for each."""
    one = fact.sparkSession.range(1)
    trend = D.monthly_trend(fact) if trend is None else trend
    return {
        "generated_from": one.select(F.lit(source).alias("value")),
        "company": one.select(F.lit(company).alias("value")),
        "kpis": D.kpis(fact),
        "states_metrics": D.states_metrics(fact),
        "monthly": trend,
        "breakdowns": breakdowns(fact),
        "risk": risk(fact),
        "models": models(model_cards, top_terms),
        "industry": industry(mis_monthly, league, since),
        "complaints": D.explorer_topk(fact),
        "alerts": alert_lists(fact, trend, alert_limits),
    }
