"""Dashboard extract sections over the scored fact (cases -> clean -> sentiment -> scores)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import labels
from ..functions.numeric import rnd
from ..operators import dashboard as D
from ..operators import mis, scoring, search
from ..operators.mis import SEGMENT_ALL
from ..operators.sentiment import sentiment_mix
from ..sources import fixtures as fx
from ..schemas import SCORED_COLUMNS
from ..session import scratch_path
from .registry import query
from .sql_views import BULK, MIS_COMPANY, MIS_MONTHLY, R, mis_flags, scored, with_

LEX = (fx.FIXTURE_LEXICON, fx.FIXTURE_BOOSTERS, fx.FIXTURE_NEGATIONS, fx.FIXTURE_IDIOMS)
_S = with_(*scored(LEX))
_DATED = with_(*scored(LEX), "dated AS (SELECT * FROM scored WHERE year IS NOT NULL)")


def _fact(spark, sf):
    return fx.scored_fact(spark, sf)


def q(name, sql):
    return query(name, sql)


@q("select_scored", _S + f"SELECT {', '.join(c for c in SCORED_COLUMNS if c != 'narrative')}, "
   "length(narrative) AS narrative_chars FROM scored")
def q_select_scored(spark, sf):
    """The closed 33-column scored projection (narrative checked by length)."""
    f = _fact(spark, sf)
    return f.select(*[c for c in SCORED_COLUMNS if c != "narrative"],
                    F.length("narrative").alias("narrative_chars"))


@q("kpis", _DATED + f"""
SELECT count(*) AS total_complaints, CAST(sum(has_narrative) AS BIGINT) AS with_narrative,
       {R('avg(is_escalated)')} AS escalation_rate, {R('avg(is_negative)')} AS negative_sentiment_rate,
       {R('avg(churn_high_risk)')} AS high_churn_risk_rate, {R('avg(handling_days)', 2)} AS avg_handling_days,
       min(CAST(date_received AS DATE)) AS date_min, max(CAST(date_received AS DATE)) AS date_max FROM dated""")
def q_kpis(spark, sf):
    """Headline KPIs."""
    return D.kpis(_fact(spark, sf))


_MONTHLY = f"""SELECT year_month, count(*) AS complaints, {R('avg(is_escalated)')} AS escalation_rate,
       {R('avg(is_negative)')} AS negative_rate, {R('avg(churn_high_risk)')} AS churn_risk,
       {R('avg(sent_compound)')} AS avg_sentiment
FROM dated GROUP BY year_month HAVING regexp_matches(year_month, '^\\d{{4}}-\\d{{2}}')"""


@q("monthly_trend", _DATED + _MONTHLY)
def q_monthly_trend(spark, sf):
    """Monthly volume, escalation, negative, churn and sentiment."""
    return D.monthly_trend(_fact(spark, sf))


def _vc_sql(col, top):
    lim = f" LIMIT {top}" if top else ""
    return _DATED + f"""SELECT {col} AS label, count(*) AS value FROM dated GROUP BY 1
ORDER BY value DESC, label ASC NULLS LAST{lim}"""


for _name, _col, _top in [("value_counts", "product", 8), ("value_counts_issue", "issue", 10),
                          ("value_counts_state", "state", 12), ("value_counts_channel", "submitted_via", None),
                          ("value_counts_response", "company_response", None),
                          ("value_counts_band", "sentiment_band", None)]:
    def _mk(col=_col, top=_top, name=_name):
        def fn(spark, sf):
            return D.value_counts(_fact(spark, sf), col, top)
        fn.__doc__ = f"Counts of {col} (incl. null), descending" + (f", top {top}." if top else ".")
        fn.__name__ = f"q_{name}"
        q(name, _vc_sql(col, top))(fn)
    _mk()


def _rate_sql(by, col, top):
    return _DATED + f"""SELECT label, n, {R('r')} AS rate FROM (
  SELECT {by} AS label, count(*) AS n, avg({col}) AS r FROM dated GROUP BY 1) g
WHERE n >= 50 ORDER BY r DESC, label LIMIT {top}"""


for _name, _by, _col, _top in [("rate_by", "issue", "is_escalated", 10),
                               ("rate_by_product", "product", "is_escalated", 8),
                               ("churn_by_issue", "issue", "churn_high_risk", 10)]:
    def _mk2(by=_by, col=_col, top=_top, name=_name):
        def fn(spark, sf):
            return D.rate_by(_fact(spark, sf), by, col, top)
        fn.__doc__ = f"Mean {col} per {by}, n >= 50, top {top}."
        fn.__name__ = f"q_{name}"
        q(name, _rate_sql(by, col, top))(fn)
    _mk2()


@q("sentiment_by_product", _DATED + f"""
SELECT label, {R('s')} AS avg_sentiment FROM (SELECT product AS label, avg(sent_compound) AS s FROM dated GROUP BY 1) g
ORDER BY s ASC, label LIMIT 8""")
def q_sentiment_by_product(spark, sf):
    """Eight products with the lowest mean sentiment."""
    return D.sentiment_by_product(_fact(spark, sf))


_STATES = f"""SELECT st AS state, count(*) AS n, {R('avg(is_escalated)')} AS escalation,
  {R('avg(churn_high_risk)')} AS churn, {R('avg(sent_compound)')} AS sentiment,
  {R('coalesce(avg(CASE WHEN has_narrative = 1 THEN is_negative END), 0.0)')} AS negative
FROM (SELECT *, CASE WHEN regexp_matches(upper(regexp_replace(state, '^\\s+|\\s+$', '', 'g')), '^[A-Z]{{2}}$')
                THEN upper(regexp_replace(state, '^\\s+|\\s+$', '', 'g')) END AS st FROM dated) x
WHERE st IS NOT NULL GROUP BY st"""


@q("states_metrics", _DATED + _STATES)
def q_states_metrics(spark, sf):
    """Per-state volume, escalation, churn, sentiment, negative share of narrated."""
    return D.states_metrics(_fact(spark, sf))


@q("join_state_negative", _DATED + f"""
SELECT st AS state, {R('coalesce(avg(CASE WHEN has_narrative = 1 THEN is_negative END), 0.0)')} AS negative
FROM (SELECT *, CASE WHEN regexp_matches(upper(regexp_replace(state, '^\\s+|\\s+$', '', 'g')), '^[A-Z]{{2}}$')
                THEN upper(regexp_replace(state, '^\\s+|\\s+$', '', 'g')) END AS st FROM dated) x
WHERE st IS NOT NULL GROUP BY st""")
def q_join_state_negative(spark, sf):
    """Negative share among narrated rows per state, default 0 (conditional mean)."""
    return D.states_metrics(_fact(spark, sf)).select("state", "negative")


@q("top_states", _DATED + "SELECT * FROM (" + _STATES + ") s ORDER BY escalation DESC, state LIMIT 10")
def q_top_states(spark, sf):
    """Ten states ranked by escalation rate."""
    return D.top_states(D.states_metrics(_fact(spark, sf)), "escalation", 10)


@q("scored_summary", _S + f"""
SELECT count(*) AS rows, {R('avg(is_escalated)')} AS escalation_rate, {R('avg(escalation_flag)')} AS pred_escalation_flag_rate,
       {R('avg(is_negative)')} AS negative_sentiment_share, {R('avg(churn_high_risk)')} AS high_churn_risk_share FROM scored""")
def q_scored_summary(spark, sf):
    """Rows and four rates of the scored table."""
    return D.scored_summary(_fact(spark, sf))


@q("base_rate", _DATED + f"""
SELECT {R('avg(is_escalated)')} AS escalation_base, {R('avg(churn_high_risk)')} AS churn_base FROM dated""")
def q_base_rate(spark, sf):
    """Global label means used as lift baselines."""
    d = D.drop_undated(_fact(spark, sf))
    return d.agg(rnd(F.avg("is_escalated"), 4).alias("escalation_base"),
                 rnd(F.avg("churn_high_risk"), 4).alias("churn_base"))


@q("sentiment_trend", _DATED + f"""
SELECT year_month, sentiment_band, count(*) AS n, {R('avg(sent_compound)')} AS avg_sentiment FROM dated GROUP BY 1, 2""")
def q_sentiment_trend(spark, sf):
    """Per month and band: count and mean sentiment."""
    return D.sentiment_trend(_fact(spark, sf))


@q("sentiment_mix", _S + f"""
SELECT sentiment_label, count(*) AS n, {R('count(*) * 1.0 / sum(count(*)) OVER ()')} AS share
FROM scored WHERE has_narrative = 1 GROUP BY 1""")
def q_sentiment_mix(spark, sf):
    """Share of each sentiment label among narrated rows."""
    return sentiment_mix(_fact(spark, sf))


_EXPLORER = f"""SELECT complaint_id AS id, strftime(CAST(date_received AS DATE), '%Y-%m-%d') AS date, product, issue, state,
  sentiment_label AS sentiment, {R('sent_compound', 3)} AS compound, {R('escalation_score', 3)} AS escalation,
  {R('churn_risk_score', 3)} AS churn, is_escalated AS escalated,
  CASE WHEN length(narrative) > 240 THEN substr(narrative, 1, 240) || '…' ELSE narrative END AS snippet
FROM dated WHERE has_narrative = 1
ORDER BY greatest(escalation_score, churn_risk_score) DESC, complaint_id LIMIT 700"""


@q("explorer_topk", _DATED + _EXPLORER)
def q_explorer_topk(spark, sf):
    """700 highest-risk narrated cases with display columns."""
    return D.explorer_topk(_fact(spark, sf))


@q("row_risk", _S + f"SELECT complaint_id, {R('greatest(escalation_score, churn_risk_score)')} AS risk FROM scored")
def q_row_risk(spark, sf):
    """Max of the two model scores per case."""
    f = _fact(spark, sf)
    return f.select("complaint_id", rnd(labels.row_risk("escalation_score", "churn_risk_score"), 4).alias("risk"))


@q("explorer_search", _DATED + "SELECT * FROM (" + _EXPLORER + ") e WHERE state = 'BA' AND lower(snippet) LIKE '%the%'")
def q_explorer_search(spark, sf):
    """Explorer slice filtered by a state click and a text search."""
    return D.explorer_search(D.explorer_topk(_fact(spark, sf)), q="the", state="BA")


@q("top_open_cases", _S + f"""
SELECT complaint_id, product, issue, {R('escalation_score')} AS escalation_score FROM scored
WHERE company_response = 'In progress' ORDER BY scored.escalation_score DESC, complaint_id LIMIT 20""")
def q_top_open_cases(spark, sf):
    """Highest-scored cases still open."""
    return D.top_open_cases(_fact(spark, sf))


@q("risk_deciles", _S + f"""
SELECT decile, count(*) AS cases, {R('min(escalation_score)')} AS min_score, {R('max(escalation_score)')} AS max_score,
       {R('avg(is_escalated)')} AS escalation_rate
FROM (SELECT *, CAST(ntile(10) OVER (ORDER BY escalation_score DESC, complaint_id) AS INTEGER) AS decile FROM scored) x
GROUP BY decile""")
def q_risk_deciles(spark, sf):
    """Decile table of cases by escalation score (exact NTILE, distributed rank)."""
    return D.risk_deciles(_fact(spark, sf))


@q("score_distribution", _S + """
SELECT CAST(least(floor(escalation_score * 10), 9) AS INTEGER) + 1 AS bucket, count(*) AS n
FROM scored WHERE escalation_score IS NOT NULL GROUP BY 1""")
def q_score_distribution(spark, sf):
    """Histogram of escalation scores in ten buckets."""
    return D.score_distribution(_fact(spark, sf))


@q("share_of_total", _S + f"""
SELECT submitted_via, count(*) AS n, {R('count(*) * 1.0 / sum(count(*)) OVER ()')} AS share FROM scored GROUP BY 1""")
def q_share_of_total(spark, sf):
    """Normalized counts per channel."""
    return D.share_of_total(_fact(spark, sf), "submitted_via")


@q("drop_undated", _DATED + "SELECT count(*) AS rows FROM dated")
def q_drop_undated(spark, sf):
    """Rows with a year."""
    return D.drop_undated(_fact(spark, sf)).agg(F.count(F.lit(1)).alias("rows"))


@q("filter_year_month", _S + """
SELECT count(*) AS rows FROM scored WHERE regexp_matches(year_month, '^\\d{4}-\\d{2}')""")
def q_filter_year_month(spark, sf):
    """Rows whose month key matches yyyy-MM."""
    return D.filter_year_month(_fact(spark, sf)).agg(F.count(F.lit(1)).alias("rows"))


@q("filter_period", _DATED + "SELECT * FROM (" + _MONTHLY + ") m WHERE year_month >= '1997-01'")
def q_filter_period(spark, sf):
    """Monthly trend from a start month on."""
    return D.filter_period(D.monthly_trend(_fact(spark, sf)), "1997-01")


@q("fact_lean", _S + f"SELECT {', '.join(c for c in SCORED_COLUMNS if c != 'narrative')} FROM scored")
def q_fact_lean(spark, sf):
    """The BI fact without the long text column: every case with its 32 other columns."""
    return _fact(spark, sf).drop("narrative")


@q("label_churn_proxy", _S + "SELECT complaint_id, churn_risk_label FROM scored")
def q_label_churn_proxy(spark, sf):
    """Negative sentiment AND (untimely OR no relief OR dispute)."""
    return _fact(spark, sf).select("complaint_id", "churn_risk_label")


@q("flag_thresholds", _S + """
SELECT escalation_flag, churn_high_risk, is_negative, count(*) AS n FROM scored GROUP BY ALL""")
def q_flag_thresholds(spark, sf):
    """Escalation / churn / negative threshold flags."""
    return _fact(spark, sf).groupBy("escalation_flag", "churn_high_risk", "is_negative") \
        .agg(F.count(F.lit(1)).alias("n"))


@q("status_band", _DATED + f"""
SELECT year_month, {R('avg(is_escalated)')} AS escalation_rate,
       CASE WHEN avg(is_escalated) >= 0.35 THEN 'critical' WHEN avg(is_escalated) >= 0.25 THEN 'warning' ELSE 'good' END AS status
FROM dated GROUP BY year_month""")
def q_status_band(spark, sf):
    """KPI status band of the monthly escalation rate."""
    d = D.drop_undated(_fact(spark, sf)).groupBy("year_month").agg(F.avg("is_escalated").alias("_r"))
    return d.select("year_month", rnd("_r", 4).alias("escalation_rate"), labels.status_band("_r").alias("status"))


@q("repair_score_types", _S + """
SELECT count(*) FILTER (WHERE sent_compound IS NULL) AS null_scores, sum(is_negative) AS negatives FROM scored""")
def q_repair_score_types(spark, sf):
    """Score columns re-typed after a cache join; null is_negative -> 0."""
    f = scoring.repair_score_types(_fact(spark, sf))
    return f.agg(F.count_if(F.col("sent_compound").isNull()).alias("null_scores"),
                 F.sum("is_negative").cast("long").alias("negatives"))


_MEASURES = f"""count(*) AS total_complaints, count(*) FILTER (WHERE has_narrative = 1) AS with_narrative,
  {R('count(*) FILTER (WHERE has_narrative = 1) * 1.0 / nullif(count(*), 0)')} AS narrative_coverage,
  count(*) FILTER (WHERE is_escalated = 1) AS escalated,
  {R('count(*) FILTER (WHERE is_escalated = 1) * 1.0 / nullif(count(*), 0)')} AS escalation_rate,
  count(*) FILTER (WHERE escalation_flag = 1) AS predicted_escalations,
  {R('avg(escalation_score)')} AS avg_escalation_score, {R('avg(sent_compound)')} AS avg_sentiment,
  count(*) FILTER (WHERE is_negative = 1) AS negative_complaints,
  {R('count(*) FILTER (WHERE is_negative = 1) * 1.0 / nullif(count(*) FILTER (WHERE has_narrative = 1), 0)')} AS negative_sentiment_rate,
  count(*) FILTER (WHERE churn_high_risk = 1) AS high_churn_risk,
  {R('count(*) FILTER (WHERE churn_high_risk = 1) * 1.0 / nullif(count(*), 0)')} AS churn_risk_rate,
  {R('avg(churn_risk_score)')} AS avg_churn_risk_score,
  {R('count(*) FILTER (WHERE timely_flag = 1) * 1.0 / nullif(count(*), 0)')} AS timely_response_rate,
  {R('count(*) FILTER (WHERE relief_flag = 1) * 1.0 / nullif(count(*), 0)')} AS relief_rate,
  {R('avg(handling_days)')} AS avg_handling_days"""


@q("bi_measures", _S + f"SELECT product, issue, {_MEASURES} FROM scored GROUP BY product, issue")
def q_bi_measures(spark, sf):
    """The BI measure set per product x issue."""
    return D.bi_measures(_fact(spark, sf), ["product", "issue"])


@q("bi_report", with_(*scored(LEX), BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY) + f"""
SELECT r.*, CAST((SELECT sum(complaints) FROM mis_monthly) AS BIGINT) AS industry_complaints,
       CAST((SELECT sum(complaints) FROM mis_monthly WHERE segment = '{SEGMENT_ALL}') AS BIGINT) AS industry_complaints_all,
       CAST((SELECT max(rank) FROM mis_company WHERE is_target) AS INTEGER) AS industry_rank
FROM (SELECT product, issue, CAST(grouping(product) + grouping(issue) AS INTEGER) AS level, {_MEASURES}
      FROM scored GROUP BY ROLLUP (product, issue)) r""")
def q_bi_report(spark, sf):
    """The BI measure set per product x issue with subtotals and the grand total, beside the industry cards."""
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    cards = D.industry_cards(mis.monthly_of(r), mis.league_of(r, fx.TARGET_COMPANY), SEGMENT_ALL)
    return D.with_cards(D.bi_measures(_fact(spark, sf), ["product", "issue"], totals=True), cards)


_SLICES = (("product", "product", 7), ("issue", "issue", 8), ("state", "state", 8), ("sentiment_band", "sentiment_band", 8))


@q("report_slices", _DATED.rstrip() + "".join(f""",
s{i} AS (SELECT '{name}' AS chart, label, value FROM (SELECT {col} AS label, CAST(count(*) AS DOUBLE) AS value FROM dated GROUP BY 1
         ORDER BY value DESC, label ASC NULLS LAST LIMIT {n}) x)""" for i, (name, col, n) in enumerate(_SLICES)) + "".join(f""",
s{i} AS (SELECT '{name}' AS chart, label, {R('r')} AS value FROM (SELECT issue AS label, count(*) AS n, avg({col}) AS r FROM dated GROUP BY 1) x
         WHERE n >= 50 ORDER BY r DESC, label LIMIT 8)""" for i, name, col in ((4, "escalation_by_issue", "is_escalated"), (5, "churn_by_issue", "churn_high_risk")))
   + "\n" + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(6)))
def q_report_slices(spark, sf):
    """The charts of the report's breakdown page: the head of each breakdown and risk table."""
    return D.report_slices(_fact(spark, sf))


SEARCH_TERMS = ("the orre", "Thatin", "ha", "charged", "e", "no such words", "rewh th")


@q("explorer_search_all", _S + f"""
SELECT t.term, s.complaint_id FROM scored s, (VALUES {', '.join(f"('{t}')" for t in SEARCH_TERMS)}) t(term)
WHERE s.has_narrative = 1 AND contains(lower(s.narrative), lower(t.term))""")
def q_explorer_search_all(spark, sf):
    """Text search over all narrated cases by a trigram index, several terms at once."""
    path = scratch_path(spark, f"search_{uuid.uuid4().hex}")
    search.write_index(_fact(spark, sf).filter(F.col("has_narrative") == 1), "complaint_id", "narrative", path)
    return search.search(spark, path, list(SEARCH_TERMS)).withColumnRenamed("key", "complaint_id")
