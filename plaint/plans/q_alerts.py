"""Alert queries over the scored fact's monthly trend and its product/issue groups.

The driver's data is near uniform, so the query thresholds below are lower
than the production defaults (z 3.5 / 2.0, lift 1.4) to exercise the logic;
the defaults are tested in pytest."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.labels import severity_band
from ..operators import alerts as A
from ..sources import fixtures as fx
from .q_dashboard import _DATED, _MONTHLY
from .registry import query
from .sql_views import R

MIN_N, MIN_MONTHS = 30, 8
ATTN_Z, SPIKE_Z, SINCE = 0.5, 1.0, "1995-01"
HOT_N, HOT_LIFT, HOT_RATE = 150, 1.01, 0.05


def _base(spark, sf):
    """What the alert lists read: months, products and issues from one scan of the fact, landed."""
    return A.alert_base(fx.scored_fact(spark, sf)).checkpoint()


def _monthly(spark, sf):
    return A.monthly_of(_base(spark, sf))


def _fmt(v: str, kind: str) -> str:
    return (f"CASE WHEN {kind} = 'count' THEN format('{{:,}}', CAST(round_even({v}, 0) AS BIGINT)) "
            f"ELSE printf('%.1f%%', {v} * 100) END")


def _sev(z: str) -> str:
    return f"CASE WHEN {z} >= 4.5 THEN 'critical' WHEN {z} >= 3.5 THEN 'serious' ELSE 'warning' END"


_SERIES = f""",
monthly AS ({_MONTHLY}),
qual0 AS (SELECT * FROM monthly WHERE complaints >= {MIN_N}),
qual AS (SELECT * FROM qual0 WHERE (SELECT count(*) FROM qual0) >= {MIN_MONTHS}),
ranked AS (SELECT year_month, complaints, row_number() OVER (ORDER BY year_month DESC) AS rn FROM qual),
cur AS (SELECT CASE WHEN coalesce(pm, 0) > 0 AND last_n < 0.5 * pm AND prev_ym IS NOT NULL THEN prev_ym ELSE last_ym END
               AS current_ym, pm AS prior_median
        FROM (SELECT max(CASE WHEN rn = 1 THEN year_month END) AS last_ym, max(CASE WHEN rn = 1 THEN complaints END) AS last_n,
                     max(CASE WHEN rn = 2 THEN year_month END) AS prev_ym,
                     median(CASE WHEN rn BETWEEN 2 AND 7 THEN complaints END) AS pm FROM ranked) x
        WHERE last_ym IS NOT NULL),
long AS (
  SELECT year_month, 'complaints' AS metric, 'Complaint volume' AS label, 'count' AS kind, 0 AS metric_order, CAST(complaints AS DOUBLE) AS value FROM qual
  UNION ALL SELECT year_month, 'escalation_rate', 'Escalation rate', 'rate', 1, escalation_rate FROM qual
  UNION ALL SELECT year_month, 'negative_rate', 'Negative sentiment', 'rate', 2, negative_rate FROM qual
  UNION ALL SELECT year_month, 'churn_risk', 'Churn-risk share', 'rate', 3, churn_risk FROM qual),
vol AS (SELECT *, list_sort(list(value) OVER w) AS hist, stddev_pop(value) OVER w AS sd FROM long
        WHERE metric = 'complaints' WINDOW w AS (ORDER BY year_month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
vol2 AS (SELECT *, list_aggregate(hist, 'median') AS med FROM vol),
vol3 AS (SELECT *, list_aggregate(list_transform(hist, lambda h: abs(h - med)), 'median') AS mad FROM vol2),
volz AS (SELECT year_month, metric, label, kind, metric_order, value,
   CASE WHEN coalesce(len(hist), 0) >= 6 THEN (value - med) / (CASE WHEN mad > 1e-9 THEN 1.4826 * mad
        ELSE (CASE WHEN coalesce(sd, 0) = 0 THEN 1.0 ELSE sd END) END) ELSE 0.0 END AS z,
   CASE WHEN coalesce(len(hist), 0) >= 6 THEN med ELSE value END AS baseline FROM vol3),
rz AS (SELECT *, median(value) OVER (PARTITION BY metric) AS baseline FROM long WHERE metric <> 'complaints'),
rz2 AS (SELECT *, median(abs(value - baseline)) OVER (PARTITION BY metric) AS mad,
               stddev_pop(value) OVER (PARTITION BY metric) AS sd FROM rz),
rzz AS (SELECT year_month, metric, label, kind, metric_order, value,
   CASE WHEN mad > 1e-9 THEN 0.6745 * (value - baseline) / mad
        ELSE (value - baseline) / (CASE WHEN coalesce(sd, 0) = 0 THEN 1.0 ELSE sd END) END AS z, baseline FROM rz2),
series AS (SELECT s.*, c.current_ym FROM (SELECT * FROM volz UNION ALL SELECT * FROM rzz) s JOIN cur c ON true),
anom0 AS (SELECT {_sev('abs(z)')} AS severity, label AS metric, metric_order, year_month AS ym, {R('value')} AS value,
                 {R('z', 2)} AS z,
                 label || ' hit ' || {_fmt('value', 'kind')} || ' in ' || year_month || ' (' || printf('%.1f', abs(z)) || 'σ).' AS detail
          FROM series WHERE year_month <> current_ym AND z >= {SPIKE_Z} AND year_month >= '{SINCE}'),
anom1 AS (SELECT * FROM anom0 QUALIFY row_number() OVER (PARTITION BY metric ORDER BY abs(z) DESC, ym) <= 3),
anomalies AS (SELECT * FROM anom1 ORDER BY abs(z) DESC, metric_order, ym LIMIT 8),
attention AS (SELECT CASE WHEN value >= baseline THEN {_sev('abs(z)')} ELSE 'good' END AS severity, label AS metric,
                     year_month AS ym, {R('value')} AS value, {R('baseline')} AS baseline, {R('z', 2)} AS z,
                     CASE WHEN value >= baseline THEN 'above' ELSE 'below' END AS direction,
                     label || ' was ' || {_fmt('value', 'kind')} || ' in ' || year_month || ', ' || printf('%.1f', abs(z))
                     || 'σ ' || (CASE WHEN value >= baseline THEN 'above' ELSE 'below' END) || ' the '
                     || {_fmt('baseline', 'kind')} || ' baseline.' AS detail
              FROM series WHERE year_month = current_ym AND metric <> 'negative_rate' AND abs(z) >= {ATTN_Z}),
hs AS (SELECT 'product' AS kind, 0 AS ko, product AS name, count(*) AS n, sum(is_escalated) AS esc,
              sum(churn_high_risk) AS chn FROM dated GROUP BY product
       UNION ALL SELECT 'issue', 1, issue, count(*), sum(is_escalated), sum(churn_high_risk) FROM dated GROUP BY issue),
hb AS (SELECT *, sum(esc) OVER (PARTITION BY kind) * 1.0 / sum(n) OVER (PARTITION BY kind) AS eb,
              sum(chn) OVER (PARTITION BY kind) * 1.0 / sum(n) OVER (PARTITION BY kind) AS cb FROM hs),
hl AS (SELECT kind, ko, name, n, 'escalation' AS metric, 0 AS mo, esc * 1.0 / n AS rate, eb AS baseline FROM hb
       WHERE n >= {HOT_N} AND name IS NOT NULL
       UNION ALL SELECT kind, ko, name, n, 'churn-risk', 1, chn * 1.0 / n, cb FROM hb WHERE n >= {HOT_N} AND name IS NOT NULL),
hl2 AS (SELECT *, CASE WHEN baseline <> 0 THEN rate / baseline ELSE 1.0 END AS lift FROM hl),
hotspots AS (SELECT CASE WHEN lift >= 2.0 THEN 'critical' WHEN lift >= 1.7 THEN 'serious' ELSE 'warning' END AS severity,
                    kind, name, metric, {R('rate')} AS rate, {R('baseline')} AS baseline, {R('lift', 2)} AS lift, n,
                    substr(name, 1, 44) || ' — ' || metric || ' ' || printf('%.0f', rate * 100) || '% ('
                    || printf('%.1f', lift) || '× the ' || printf('%.0f', baseline * 100) || '% average, n='
                    || format('{{:,}}', n) || ').' AS detail
             FROM hl2 WHERE lift >= {HOT_LIFT} AND rate >= {HOT_RATE}
             ORDER BY {R('lift', 2)} DESC, ko, name, mo LIMIT 8)
"""
_A = _DATED + _SERIES


def _qual(spark, sf):
    return A._enough(A.alerts_qualify(_monthly(spark, sf), MIN_N), MIN_MONTHS)


@query("alerts_qualify", _A + "SELECT year_month, complaints FROM qual")
def q_alerts_qualify(spark, sf):
    """Months with >= 30 complaints, the lens needing >= 8 of them."""
    return _qual(spark, sf).select("year_month", "complaints")


@query("current_month_pick", _A + "SELECT current_ym, prior_median FROM cur")
def q_current_month_pick(spark, sf):
    """Last qualifying month, stepped back when partial."""
    return A.current_month_pick(_qual(spark, sf))


@query("robust_z", _A + f"SELECT year_month, metric, {R('z')} AS z, {R('baseline')} AS median FROM rzz")
def q_robust_z(spark, sf):
    """Global median/MAD z of each monthly rate."""
    s = A.metric_series(_qual(spark, sf)).filter(F.col("kind") == "rate")
    from ..functions.numeric import rnd
    return s.select("year_month", "metric", rnd("z", 4).alias("z"), rnd("baseline", 4).alias("median"))


@query("trailing_z", _A + f"SELECT year_month, {R('z')} AS z, {R('baseline')} AS baseline FROM volz")
def q_trailing_z(spark, sf):
    """Volume z against the 12 previous qualifying months (>= 6 needed)."""
    from ..functions.numeric import rnd
    s = A.metric_series(_qual(spark, sf)).filter(F.col("metric") == "complaints")
    return s.select("year_month", rnd("z", 4).alias("z"), rnd("baseline", 4).alias("baseline"))


@query("alerts_attention", _A + "SELECT * FROM attention")
def q_alerts_attention(spark, sf):
    """Current-month status of volume, escalation and churn vs baseline."""
    return A.alerts_attention(_monthly(spark, sf), MIN_N, MIN_MONTHS, ATTN_Z)


@query("alerts_anomalies", _A + "SELECT severity, metric, ym, value, z, detail FROM anomalies")
def q_alerts_anomalies(spark, sf):
    """Historical upward spikes, capped 3 per metric, top 8."""
    return A.alerts_anomalies(_monthly(spark, sf), MIN_N, MIN_MONTHS, SPIKE_Z, SINCE)


@query("cap_per_metric", _A + "SELECT metric, count(*) AS n FROM anomalies GROUP BY metric")
def q_cap_per_metric(spark, sf):
    """Anomalies kept per metric after the cap."""
    a = A.alerts_anomalies(_monthly(spark, sf), MIN_N, MIN_MONTHS, SPIKE_Z, SINCE)
    return a.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query("alerts_timeline", _A + f""",
acnt AS (SELECT metric AS label, count(*) AS a FROM anomalies GROUP BY 1),
lab AS (SELECT DISTINCT label FROM series WHERE kind = 'rate'),
best AS (SELECT l.label FROM lab l LEFT JOIN acnt c ON c.label = l.label
         ORDER BY coalesce(c.a, 0) DESC, CASE l.label WHEN 'Escalation rate' THEN 2 WHEN 'Churn-risk share' THEN 1
                                          WHEN 'Negative sentiment' THEN 0 ELSE -1 END DESC LIMIT 1)
SELECT s.label AS metric, s.year_month AS ym, {R('s.value')} AS value, {R('s.z', 2)} AS z, abs(s.z) >= 3.5 AS flag
FROM series s JOIN best b ON s.label = b.label WHERE s.kind = 'rate'""".replace("\n,\nacnt", ",\nacnt"))
def q_alerts_timeline(spark, sf):
    """Rate series with the most anomalies, with z and spike flags."""
    m = _monthly(spark, sf)
    anomalies = A.alerts_anomalies(m, MIN_N, MIN_MONTHS, SPIKE_Z, SINCE)
    return A.alerts_timeline(m, anomalies, MIN_N, MIN_MONTHS)


@query("alerts_hotspots", _A + "SELECT * FROM hotspots")
def q_alerts_hotspots(spark, sf):
    """Products / issues with risk far above the base rate, top 8 by lift."""
    return A.alerts_hotspots(fx.scored_fact(spark, sf), HOT_N, HOT_LIFT, HOT_RATE)


@query("alerts_counts", _A + """
SELECT l.severity, coalesce(c.n, 0) AS n FROM (VALUES ('critical'), ('serious'), ('warning')) l(severity)
LEFT JOIN (SELECT severity, count(*) AS n FROM (SELECT severity FROM attention UNION ALL SELECT severity FROM hotspots) u
           GROUP BY severity) c ON c.severity = l.severity""")
def q_alerts_counts(spark, sf):
    """critical / serious / warning over attention + hotspots."""
    base = _base(spark, sf)
    att = A.alerts_attention(A.monthly_of(base), MIN_N, MIN_MONTHS, ATTN_Z)
    hot = A.hotspots_of(base, HOT_N, HOT_LIFT, HOT_RATE)
    return A.alerts_counts(att, hot)


@query("stack_alerts", _A + """
SELECT lens, count(*) AS n FROM (SELECT 'attention' AS lens FROM attention UNION ALL SELECT 'anomaly' FROM anomalies
                                 UNION ALL SELECT 'hotspot' FROM hotspots) u GROUP BY lens""")
def q_stack_alerts(spark, sf):
    """All alert lists stacked into one long table (counted per lens)."""
    base = _base(spark, sf)
    m = A.monthly_of(base)
    st = A.stack_alerts(A.alerts_attention(m, MIN_N, MIN_MONTHS, ATTN_Z),
                        A.alerts_anomalies(m, MIN_N, MIN_MONTHS, SPIKE_Z, SINCE),
                        A.hotspots_of(base, HOT_N, HOT_LIFT, HOT_RATE))
    return st.groupBy("lens").agg(F.count(F.lit(1)).alias("n"))


@query("severity_band", _A + f"""
SELECT year_month, metric, {_sev('abs(z)')} AS severity FROM series""")
def q_severity_band(spark, sf):
    """|z| >= 4.5 critical, >= 3.5 serious, else warning, for every series point."""
    s = A.metric_series(_qual(spark, sf))
    return s.select("year_month", "metric", severity_band(F.abs("z")).alias("severity"))


@query("alert_detail", _A + "SELECT ym, detail FROM attention UNION ALL SELECT ym, detail FROM anomalies")
def q_alert_detail(spark, sf):
    """Readable alert texts (thousands separators, one-decimal %, sigma)."""
    m = _monthly(spark, sf)
    a = A.alerts_attention(m, MIN_N, MIN_MONTHS, ATTN_Z).select("ym", "detail")
    b = A.alerts_anomalies(m, MIN_N, MIN_MONTHS, SPIKE_Z, SINCE).select("ym", "detail")
    return a.unionByName(b)
