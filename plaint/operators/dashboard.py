"""Dashboard aggregates over the scored fact: KPIs, trends, breakdowns, risk
lenses, state metrics and the explorer slice. All are grouped aggregates
(partial + final) or top-k (TakeOrderedAndProject); no row reaches the driver."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.labels import row_risk, safe_rate
from ..functions.numeric import rnd


def drop_undated(df: DataFrame) -> DataFrame:
    return df.filter(F.col("year").isNotNull())


def filter_year_month(df: DataFrame, col: str = "year_month") -> DataFrame:
    return df.filter(F.col(col).rlike(r"^\d{4}-\d{2}"))


def filter_period(df: DataFrame, since: str, col: str = "year_month") -> DataFrame:
    return df.filter(F.col(col) >= since)


def kpis(df: DataFrame) -> DataFrame:
    """Headline KPIs over dated rows."""
    d = drop_undated(df)
    return d.agg(
        F.count(F.lit(1)).alias("total_complaints"),
        F.sum("has_narrative").cast("long").alias("with_narrative"),
        rnd(F.avg("is_escalated"), 4).alias("escalation_rate"),
        rnd(F.avg("is_negative"), 4).alias("negative_sentiment_rate"),
        rnd(F.avg("churn_high_risk"), 4).alias("high_churn_risk_rate"),
        rnd(F.avg("handling_days"), 2).alias("avg_handling_days"),
        F.min(F.to_date("date_received")).alias("date_min"),
        F.max(F.to_date("date_received")).alias("date_max"),
    )


def monthly_trend(df: DataFrame) -> DataFrame:
    """Per month: complaints and mean escalation / negative / churn / sentiment."""
    d = drop_undated(df)
    g = d.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("complaints"),
        rnd(F.avg("is_escalated"), 4).alias("escalation_rate"),
        rnd(F.avg("is_negative"), 4).alias("negative_rate"),
        rnd(F.avg("churn_high_risk"), 4).alias("churn_risk"),
        rnd(F.avg("sent_compound"), 4).alias("avg_sentiment"),
    )
    return filter_year_month(g).orderBy("year_month")


def value_counts(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Category counts incl. null, descending (ties by label), optional top n."""
    d = drop_undated(df)
    g = d.groupBy(F.col(col).alias("label")).agg(F.count(F.lit(1)).alias("value"))
    g = g.orderBy(F.col("value").desc(), F.col("label").asc_nulls_last())
    return g.limit(top) if top else g


def rate_by(df: DataFrame, by: str, col: str, top: int = 10, min_n: int = 50) -> DataFrame:
    """Per category: n and mean of a 0/1 column; n >= min_n; top by rate."""
    d = drop_undated(df)
    g = d.groupBy(F.col(by).alias("label")).agg(F.count(F.lit(1)).alias("n"),
                                                F.avg(col).alias("_rate"))
    g = g.filter(F.col("n") >= min_n).orderBy(F.col("_rate").desc(), F.col("label"))
    return g.limit(top).select("label", "n", rnd("_rate", 4).alias("rate"))


def report_slices(df: DataFrame) -> DataFrame:
    """(chart, label, value): what the report's breakdown page draws, the heads of its tables."""
    counts = [(c, value_counts(df, c, n)) for c, n in (("product", 7), ("issue", 8), ("state", 8), ("sentiment_band", 8))]
    rates = [(name, rate_by(df, "issue", c, 8)) for name, c in (("escalation_by_issue", "is_escalated"), ("churn_by_issue", "churn_high_risk"))]
    charts = [t.select(F.lit(name).alias("chart"), "label", F.col(t.columns[-1]).cast("double").alias("value")) for name, t in counts + rates]
    return reduce(DataFrame.unionByName, charts)


def sentiment_by_product(df: DataFrame, top: int = 8) -> DataFrame:
    d = drop_undated(df)
    g = d.groupBy(F.col("product").alias("label")).agg(F.avg("sent_compound").alias("_s"))
    return g.orderBy(F.col("_s").asc(), F.col("label")).limit(top) \
            .select("label", rnd("_s", 4).alias("avg_sentiment"))


def states_metrics(df: DataFrame) -> DataFrame:
    """Per normalized two-letter state: n, escalation, churn, sentiment, and the
    negative share among narrated rows (0 when none) -- one grouped pass with
    a conditional mean instead of a second group-by and a lookup join."""
    d = drop_undated(df).withColumn("state", text.state_code("state")).filter(F.col("state").isNotNull())
    g = d.groupBy("state").agg(
        F.count(F.lit(1)).alias("n"),
        rnd(F.avg("is_escalated"), 4).alias("escalation"),
        rnd(F.avg("churn_high_risk"), 4).alias("churn"),
        rnd(F.avg("sent_compound"), 4).alias("sentiment"),
        rnd(F.coalesce(F.avg(F.when(F.col("has_narrative") == 1, F.col("is_negative"))), F.lit(0.0)), 4)
        .alias("negative"),
    )
    return g


def top_states(states: DataFrame, metric: str = "n", n: int = 10) -> DataFrame:
    return states.orderBy(F.col(metric).desc(), F.col("state")).limit(n)


def scored_summary(df: DataFrame) -> DataFrame:
    """Rows and four rates of the scored table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        rnd(F.avg("is_escalated"), 4).alias("escalation_rate"),
        rnd(F.avg("escalation_flag"), 4).alias("pred_escalation_flag_rate"),
        rnd(F.avg("is_negative"), 4).alias("negative_sentiment_share"),
        rnd(F.avg("churn_high_risk"), 4).alias("high_churn_risk_share"),
    )


def sentiment_trend(df: DataFrame) -> DataFrame:
    """Per month and sentiment band: count and mean compound."""
    d = drop_undated(df)
    return d.groupBy("year_month", "sentiment_band").agg(
        F.count(F.lit(1)).alias("n"), rnd(F.avg("sent_compound"), 4).alias("avg_sentiment"))


def explorer_topk(df: DataFrame, k: int = 700, snippet_chars: int = 240) -> DataFrame:
    """Highest-risk narrated cases with display columns (top-k, ties by id)."""
    d = drop_undated(df).filter(F.col("has_narrative") == 1)
    d = d.withColumn("_risk", row_risk("escalation_score", "churn_risk_score"))
    top = d.orderBy(F.col("_risk").desc(), F.col("complaint_id")).limit(k)
    return top.select(
        F.col("complaint_id").alias("id"),
        F.date_format(F.to_date("date_received"), "yyyy-MM-dd").alias("date"),
        "product", "issue", "state",
        F.col("sentiment_label").alias("sentiment"),
        rnd("sent_compound", 3).alias("compound"),
        rnd("escalation_score", 3).alias("escalation"),
        rnd("churn_risk_score", 3).alias("churn"),
        F.col("is_escalated").alias("escalated"),
        text.snippet("narrative", snippet_chars).alias("snippet"),
    )


def explorer_search(df: DataFrame, q: str | None = None, state: str | None = None,
                    product: str | None = None, sort: str = "risk") -> DataFrame:
    """Text search + filters on the explorer slice; sort by risk or date."""
    d = df
    if q:
        d = d.filter(F.lower("snippet").contains(q.lower()))
    if state:
        d = d.filter(F.col("state") == state)
    if product:
        d = d.filter(F.col("product") == product)
    if sort == "date":
        return d.orderBy(F.col("date").desc(), F.col("id"))
    return d.orderBy(F.greatest("escalation", "churn").desc(), F.col("id"))


def top_open_cases(df: DataFrame, k: int = 20, open_response: str = "In progress") -> DataFrame:
    d = df.filter(F.col("company_response") == open_response)
    return d.orderBy(F.col("escalation_score").desc(), F.col("complaint_id")).limit(k) \
            .select("complaint_id", "product", "issue", rnd("escalation_score", 4).alias("escalation_score"))


def risk_deciles(df: DataFrame, score: str = "escalation_score") -> DataFrame:
    """Decile of every case by score (1 = highest risk), then per-decile stats.
    Exact NTILE(10) from a distributed global rank (see ranking.py)."""
    from .ranking import global_row_number, ntile_from_rank
    d = df.select("complaint_id", score, "is_escalated")
    ranked = global_row_number(d, [F.col(score).desc(), F.col("complaint_id").asc()], "_rn",
                               total_name="_n")
    ranked = ranked.withColumn("decile", ntile_from_rank(F.col("_rn"), F.col("_n"), 10))
    return ranked.groupBy("decile").agg(F.count(F.lit(1)).alias("cases"),
                                        rnd(F.min(score), 4).alias("min_score"),
                                        rnd(F.max(score), 4).alias("max_score"),
                                        rnd(F.avg("is_escalated"), 4).alias("escalation_rate"))


def score_distribution(df: DataFrame, score: str = "escalation_score", buckets: int = 10) -> DataFrame:
    """Histogram of a [0, 1] score in equal-width buckets."""
    b = F.least(F.floor(F.col(score) * buckets), F.lit(buckets - 1)).cast("int") + 1
    return df.filter(F.col(score).isNotNull()).groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def share_of_total(df: DataFrame, col: str) -> DataFrame:
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", rnd(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


def bi_measures(df: DataFrame, dims: list[str], totals: bool = False) -> DataFrame:
    """The BI measure set evaluated under a group-by context.

    With ``totals`` one scan also gives every subtotal from the right and the grand total, as a BI tool shows
    them; ``level`` counts the dims that a row sums over (0: none), since a dim may be null itself."""
    narrated = F.count_if(F.col("has_narrative") == 1)
    total = F.count(F.lit(1))
    g = df.rollup(*dims) if totals else df.groupBy(*dims)
    level = [F.bit_count(F.grouping_id()).cast("int").alias("level")] if totals else []
    return g.agg(
        *level,
        total.alias("total_complaints"),
        narrated.alias("with_narrative"),
        rnd(safe_rate(narrated, total), 4).alias("narrative_coverage"),
        F.count_if(F.col("is_escalated") == 1).alias("escalated"),
        rnd(safe_rate(F.count_if(F.col("is_escalated") == 1), total), 4).alias("escalation_rate"),
        F.count_if(F.col("escalation_flag") == 1).alias("predicted_escalations"),
        rnd(F.avg("escalation_score"), 4).alias("avg_escalation_score"),
        rnd(F.avg("sent_compound"), 4).alias("avg_sentiment"),
        F.count_if(F.col("is_negative") == 1).alias("negative_complaints"),
        rnd(safe_rate(F.count_if(F.col("is_negative") == 1), narrated), 4).alias("negative_sentiment_rate"),
        F.count_if(F.col("churn_high_risk") == 1).alias("high_churn_risk"),
        rnd(safe_rate(F.count_if(F.col("churn_high_risk") == 1), total), 4).alias("churn_risk_rate"),
        rnd(F.avg("churn_risk_score"), 4).alias("avg_churn_risk_score"),
        rnd(safe_rate(F.count_if(F.col("timely_flag") == 1), total), 4).alias("timely_response_rate"),
        rnd(safe_rate(F.count_if(F.col("relief_flag") == 1), total), 4).alias("relief_rate"),
        rnd(F.avg("handling_days"), 4).alias("avg_handling_days"),
    )


def industry_cards(monthly: DataFrame, league: DataFrame, segment_all: str) -> DataFrame:
    """One row: the target's rank among companies, industry complaints as the measure sums them (all rows of the
    monthly table, so the target's count in both segments) and of the whole-industry segment alone."""
    a = monthly.agg(F.sum("complaints").alias("industry_complaints"),
                    F.sum(F.when(F.col("segment") == segment_all, F.col("complaints"))).alias("industry_complaints_all"),
                    F.lit(None).cast("int").alias("industry_rank"))
    b = league.agg(F.lit(None).cast("long").alias("industry_complaints"), F.lit(None).cast("long").alias("industry_complaints_all"),
                   F.max(F.when(F.col("is_target"), F.col("rank"))).cast("int").alias("industry_rank"))
    return a.unionByName(b).agg(*[F.max(c).alias(c) for c in a.columns])


def with_cards(df: DataFrame, cards: DataFrame) -> DataFrame:
    """Report-level cards (one row) beside every row of an aggregated table."""
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(cards.withColumn("_one", F.lit(1))), "_one", "left").drop("_one")
