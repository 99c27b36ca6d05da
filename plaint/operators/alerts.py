"""Anomaly alerts over monthly series and product/issue hotspots.

Inputs are aggregates (one row per month, or per category): the whole-series
windows below therefore run over bounded data (months x metrics), never over
fact rows. The fact itself is only touched through grouped aggregates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import lift_severity, severity_band
from ..functions.numeric import rnd
from .dashboard import drop_undated, filter_year_month

# --- fixed values: alert metrics (key, label, kind) ---------------------------
METRICS = [
    ("complaints", "Complaint volume", "count"),
    ("escalation_rate", "Escalation rate", "rate"),
    ("negative_rate", "Negative sentiment", "rate"),
    ("churn_risk", "Churn-risk share", "rate"),
]
# timeline tie preference among rate metrics
TIMELINE_PREF = {"Escalation rate": 2, "Churn-risk share": 1, "Negative sentiment": 0}
MAD_EPS = 1e-9


def _median_sorted(arr: Column) -> Column:
    """Median of an already sorted numeric array (null when empty)."""
    n = F.size(arr)
    mid = F.floor(n / 2).cast("int")
    return (F.when(n == 0, F.lit(None).cast("double"))
            .when(n % 2 == 1, F.get(arr, mid))
            .otherwise((F.get(arr, mid - 1) + F.get(arr, mid)) / 2.0))


def robust_z(df: DataFrame, value: str, by: list[str] | None = None, out: str = "z",
             median_out: str = "median") -> DataFrame:
    """Global robust z: 0.6745 (x - median) / MAD; MAD ~ 0 -> (x - median) / pop std (or 1)."""
    w = Window.partitionBy(*(by or []))
    d = df.withColumn(median_out, F.percentile(F.col(value), 0.5).over(w))
    d = d.withColumn("_dev", F.abs(F.col(value) - F.col(median_out)))
    d = d.withColumn("_mad", F.percentile(F.col("_dev"), 0.5).over(w)) \
         .withColumn("_sd", F.stddev_pop(F.col(value)).over(w))
    sd = F.when(F.coalesce(F.col("_sd"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("_sd"))
    z = F.when(F.col("_mad") > MAD_EPS, 0.6745 * (F.col(value) - F.col(median_out)) / F.col("_mad")) \
         .otherwise((F.col(value) - F.col(median_out)) / sd)
    return d.withColumn(out, z).drop("_dev", "_mad", "_sd")


def trailing_z(df: DataFrame, value: str, order: str, by: list[str] | None = None,
               window: int = 12, min_hist: int = 6, out: str = "z", baseline_out: str = "baseline") -> DataFrame:
    """z of each row against up to ``window`` previous rows (current excluded):
    median/MAD with scale 1.4826 MAD, fallback population std (or 1); fewer than
    ``min_hist`` previous rows -> z = 0 and baseline = the value itself."""
    w = Window.partitionBy(*(by or [])).orderBy(order).rowsBetween(-window, -1)
    d = df.withColumn("_hist", F.array_sort(F.collect_list(F.col(value).cast("double")).over(w)))
    d = d.withColumn("_med", _median_sorted(F.col("_hist")))
    d = d.withColumn("_mad", _median_sorted(F.array_sort(
        F.transform("_hist", lambda h: F.abs(h - F.col("_med"))))))
    d = d.withColumn("_sd", F.stddev_pop(F.col(value)).over(w))
    sd = F.when(F.coalesce(F.col("_sd"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("_sd"))
    scale = F.when(F.col("_mad") > MAD_EPS, 1.4826 * F.col("_mad")).otherwise(sd)
    enough = F.size("_hist") >= min_hist
    d = d.withColumn(out, F.when(enough, (F.col(value) - F.col("_med")) / scale).otherwise(F.lit(0.0)))
    d = d.withColumn(baseline_out, F.when(enough, F.col("_med")).otherwise(F.col(value).cast("double")))
    return d.drop("_hist", "_med", "_mad", "_sd")


def alerts_qualify(monthly: DataFrame, min_n: int = 30) -> DataFrame:
    """Months with at least ``min_n`` complaints (rates are the rounded ones)."""
    return monthly.filter(F.col("complaints") >= min_n)


def with_current_month(qual: DataFrame) -> DataFrame:
    """Add ``current_ym``: the last qualifying month, stepped back one when its
    volume is under half the median of the six months before it. Computed with
    whole-series window aggregates over the (bounded) monthly rows."""
    w_desc = Window.orderBy(F.col("year_month").desc())
    w_all = Window.partitionBy()
    r = qual.withColumn("_rn", F.row_number().over(w_desc))
    r = r.withColumns({
        "_last_ym": F.max(F.when(F.col("_rn") == 1, F.col("year_month"))).over(w_all),
        "_last_n": F.max(F.when(F.col("_rn") == 1, F.col("complaints"))).over(w_all),
        "_prev_ym": F.max(F.when(F.col("_rn") == 2, F.col("year_month"))).over(w_all),
        "prior_median": F.percentile(F.when(F.col("_rn").between(2, 7), F.col("complaints")), 0.5).over(w_all),
    })
    step = (F.coalesce(F.col("prior_median"), F.lit(0.0)) > 0) \
        & (F.col("_last_n") < 0.5 * F.col("prior_median")) & F.col("_prev_ym").isNotNull()
    r = r.withColumn("current_ym", F.when(step, F.col("_prev_ym")).otherwise(F.col("_last_ym")))
    return r.drop("_rn", "_last_ym", "_last_n", "_prev_ym")


def current_month_pick(qual: DataFrame) -> DataFrame:
    return with_current_month(qual).select("current_ym", "prior_median").distinct()


def metric_series(qual: DataFrame) -> DataFrame:
    """Long form (metric, label, kind, year_month, value, current_ym) with the z
    of each metric: trailing z for volume (it trends), global robust z for rates."""
    qual = with_current_month(qual)
    stacks = [F.struct(F.lit(k).alias("metric"), F.lit(lbl).alias("label"), F.lit(kind).alias("kind"),
                       F.lit(i).alias("metric_order"), F.col(k).cast("double").alias("value"))
              for i, (k, lbl, kind) in enumerate(METRICS)]
    long = qual.select("year_month", "current_ym", F.explode(F.array(*stacks)).alias("s")) \
               .select("year_month", "current_ym", "s.*")
    vol = trailing_z(long.filter(F.col("metric") == "complaints"), "value", "year_month", ["metric"])
    rates = robust_z(long.filter(F.col("metric") != "complaints"), "value", ["metric"], median_out="baseline")
    return vol.unionByName(rates)


def _fmt(value: Column, kind: Column) -> Column:
    return F.when(kind == "count", F.format_number(value, 0)) \
            .otherwise(F.format_string("%.1f%%", value * 100))


def alert_detail_attention(label, value, ym, z, direction, baseline, kind) -> Column:
    return F.concat(label, F.lit(" was "), _fmt(value, kind), F.lit(" in "), ym, F.lit(", "),
                    F.format_string("%.1f", F.abs(z)), F.lit("σ "), direction, F.lit(" the "),
                    _fmt(baseline, kind), F.lit(" baseline."))


def alert_detail_anomaly(label, value, ym, z, kind) -> Column:
    return F.concat(label, F.lit(" hit "), _fmt(value, kind), F.lit(" in "), ym, F.lit(" ("),
                    F.format_string("%.1f", F.abs(z)), F.lit("σ)."))


def _enough(qual: DataFrame, min_months: int) -> DataFrame:
    """Series rows kept only when the lens has >= min_months qualifying months."""
    return qual.withColumn("_months", F.count(F.lit(1)).over(Window.partitionBy())) \
               .filter(F.col("_months") >= min_months).drop("_months")


def alerts_attention(monthly: DataFrame, min_n: int = 30, min_months: int = 8,
                     z_threshold: float = 2.0) -> DataFrame:
    """Current month vs baseline for volume / escalation / churn (negative-rate
    is skipped): |z| >= threshold; above = bad -> severity, below -> good."""
    qual = _enough(alerts_qualify(monthly, min_n), min_months)
    s = metric_series(qual).filter(F.col("year_month") == F.col("current_ym"))
    s = s.filter((F.col("metric") != "negative_rate") & (F.abs("z") >= z_threshold))
    direction = F.when(F.col("value") >= F.col("baseline"), "above").otherwise("below")
    s = s.withColumn("direction", direction)
    sev = F.when(F.col("direction") == "above", severity_band(F.abs("z"))).otherwise(F.lit("good"))
    return s.select(
        sev.alias("severity"), F.col("label").alias("metric"), F.col("year_month").alias("ym"),
        rnd("value", 4).alias("value"), rnd("baseline", 4).alias("baseline"), rnd("z", 2).alias("z"),
        "direction",
        alert_detail_attention(F.col("label"), F.col("value"), F.col("year_month"), F.col("z"),
                               F.col("direction"), F.col("baseline"), F.col("kind")).alias("detail"))


def cap_per_metric(df: DataFrame, per_metric: int = 3, total: int = 8) -> DataFrame:
    """At most ``per_metric`` rows per metric by |z| (2 dp; ties by month),
    then the top ``total`` (ties by metric order, month)."""
    w = Window.partitionBy("metric").orderBy(F.abs("z").desc(), F.col("ym"))
    capped = df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= per_metric).drop("_r")
    return capped.orderBy(F.abs("z").desc(), F.col("metric_order"), F.col("ym")).limit(total)


def alerts_anomalies(monthly: DataFrame, min_n: int = 30, min_months: int = 8,
                     z_threshold: float = 3.5, since: str = "2015-01",
                     per_metric: int = 3, total: int = 8) -> DataFrame:
    """Historical upward spikes (z >= threshold), all months but the current,
    from ``since`` on, capped per metric, top ``total`` by |z|."""
    qual = _enough(alerts_qualify(monthly, min_n), min_months)
    s = metric_series(qual).filter(F.col("year_month") != F.col("current_ym"))
    s = s.filter((F.col("z") >= z_threshold) & (F.col("year_month") >= since))
    s = s.select(severity_band(F.abs("z")).alias("severity"), F.col("label").alias("metric"), "metric_order",
                 F.col("year_month").alias("ym"), rnd("value", 4).alias("value"),
                 rnd("z", 2).alias("z"),
                 alert_detail_anomaly(F.col("label"), F.col("value"), F.col("year_month"), F.col("z"),
                                      F.col("kind")).alias("detail"))
    return cap_per_metric(s, per_metric, total).drop("metric_order")


def alerts_timeline(monthly: DataFrame, anomalies: DataFrame, min_n: int = 30,
                    min_months: int = 8, flag_z: float = 3.5) -> DataFrame:
    """Full series of the rate metric with the most listed anomalies (ties:
    escalation > churn > negative), with z and a spike flag."""
    qual = _enough(alerts_qualify(monthly, min_n), min_months)
    series = metric_series(qual).filter(F.col("kind") == "rate")
    counts = anomalies.groupBy(F.col("metric").alias("label")).agg(F.count(F.lit(1)).alias("_a"))
    pref = F.create_map(*[x for k, v in TIMELINE_PREF.items() for x in (F.lit(k), F.lit(v))])
    labels = series.select("label").distinct().join(counts, "label", "left") \
        .select("label", F.coalesce("_a", F.lit(0)).alias("_a"), F.coalesce(pref[F.col("label")], F.lit(-1)).alias("_p"))
    best = labels.agg(F.max_by("label", F.struct("_a", "_p")).alias("best"))
    s = series.join(F.broadcast(best), series.label == best.best)
    return s.select(F.col("label").alias("metric"), F.col("year_month").alias("ym"),
                    rnd("value", 4).alias("value"), rnd("z", 2).alias("z"),
                    (F.abs("z") >= flag_z).alias("flag"))


def alert_base(fact: DataFrame) -> DataFrame:
    """All that the alert lists need of the fact, in one scan: counts and sums by month, by product and by issue
    (grouping sets, combined map-side), told apart by ``kind``. One row per month or category; land it
    (``checkpoint()``) and every list reads it instead of the fact. Undated rows are left out."""
    sets = ["year_month", "product", "issue"]
    g = drop_undated(fact).groupingSets([[c] for c in sets], *sets).agg(
        *[F.grouping(c).alias(f"_g_{c}") for c in sets],
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"{c}_sum") for c in ("is_escalated", "churn_high_risk")],
        *[F.avg(c).alias(f"{c}_avg") for c in ("is_escalated", "is_negative", "churn_high_risk", "sent_compound")])
    kind = F.when(F.col("_g_year_month") == 0, "month").when(F.col("_g_product") == 0, "product").otherwise("issue")
    name = F.when(kind == "month", F.col("year_month")).when(kind == "product", F.col("product").cast("string")) \
            .otherwise(F.col("issue").cast("string"))
    return g.select(kind.alias("kind"), name.alias("name"), *[c for c in g.columns if c not in sets and not c.startswith("_g_")])


def monthly_of(base: DataFrame) -> DataFrame:
    """The monthly trend out of ``alert_base``."""
    m = base.filter(F.col("kind") == "month").select(
        F.col("name").alias("year_month"), F.col("n").alias("complaints"),
        rnd("is_escalated_avg", 4).alias("escalation_rate"), rnd("is_negative_avg", 4).alias("negative_rate"),
        rnd("churn_high_risk_avg", 4).alias("churn_risk"), rnd("sent_compound_avg", 4).alias("avg_sentiment"))
    return filter_year_month(m)


def alerts_hotspots(fact: DataFrame, min_n: int = 150, min_lift: float = 1.4,
                    min_rate: float = 0.15, top: int = 8) -> DataFrame:
    """Products / issues whose escalation or churn-risk rate is far above the table-wide base rate."""
    return hotspots_of(alert_base(fact), min_n, min_lift, min_rate, top)


def hotspots_of(base: DataFrame, min_n: int = 150, min_lift: float = 1.4,
                min_rate: float = 0.15, top: int = 8) -> DataFrame:
    """Hotspots out of ``alert_base``; base rates are recovered from the per-category sums (no extra pass, no
    cross join), and both metrics of a category come from the same row."""
    w = Window.partitionBy("kind")
    g = base.filter(F.col("kind") != "month").withColumns({
        f"_{c}": F.sum(f"{c}_sum").over(w) / F.sum("n").over(w) for c in ("is_escalated", "churn_high_risk")})
    g = g.filter((F.col("n") >= min_n) & F.col("name").isNotNull())
    metrics = [F.struct(F.lit(metric).alias("metric"), (F.col(f"{c}_sum") / F.col("n")).alias("rate"),
                        F.col(f"_{c}").alias("baseline"), F.lit(order).alias("_mo"))
               for order, (metric, c) in enumerate((("escalation", "is_escalated"), ("churn-risk", "churn_high_risk")))]
    u = g.select("kind", "name", "n", F.when(F.col("kind") == "product", 0).otherwise(1).alias("_ko"), F.inline(F.array(*metrics)))
    u = u.withColumn("lift", F.when(F.col("baseline") != 0, F.col("rate") / F.col("baseline")).otherwise(F.lit(1.0)))
    u = u.filter((F.col("lift") >= min_lift) & (F.col("rate") >= min_rate))
    u = u.withColumn("lift2", rnd("lift", 2))
    top_rows = u.orderBy(F.col("lift2").desc(), "_ko", "name", "_mo").limit(top)
    detail = F.concat(F.substring("name", 1, 44), F.lit(" — "), F.col("metric"), F.lit(" "),
                      F.format_string("%.0f", F.col("rate") * 100), F.lit("% ("),
                      F.format_string("%.1f", F.col("lift")), F.lit("× the "),
                      F.format_string("%.0f", F.col("baseline") * 100), F.lit("% average, n="),
                      F.format_number(F.col("n"), 0), F.lit(")."))
    return top_rows.select(lift_severity("lift").alias("severity"), "kind", "name", "metric",
                           rnd("rate", 4).alias("rate"), rnd("baseline", 4).alias("baseline"),
                           F.col("lift2").alias("lift"), "n", detail.alias("detail"))


def alerts_counts(attention: DataFrame, hotspots: DataFrame) -> DataFrame:
    """critical / serious / warning counts over attention + hotspots."""
    sev = attention.select("severity").unionByName(hotspots.select("severity"))
    levels = sev.sparkSession.sql("SELECT * FROM VALUES ('critical'), ('serious'), ('warning') AS t(severity)")
    c = sev.groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    return levels.join(c, "severity", "left").select("severity", F.coalesce("n", F.lit(0)).alias("n"))


def stack_alerts(attention: DataFrame, anomalies: DataFrame, hotspots: DataFrame) -> DataFrame:
    """All alert lists in one long table (lens, severity, metric, where, detail)."""
    a = attention.select(F.lit("attention").alias("lens"), "severity", "metric", F.col("ym").alias("where"), "detail")
    b = anomalies.select(F.lit("anomaly").alias("lens"), "severity", "metric", F.col("ym").alias("where"), "detail")
    c = hotspots.select(F.lit("hotspot").alias("lens"), "severity", "metric", F.col("name").alias("where"), "detail")
    return a.unionByName(b).unionByName(c)
