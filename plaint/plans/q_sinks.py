"""Sink queries: each writes to a fresh folder under the shared checkpoint
folder and reads the result back."""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import bi, mis
from ..operators import dashboard as D
from ..operators import extract as X
from ..operators import metrics as M
from ..operators.refresh import refresh_log
from ..session import scratch_path
from ..sources import fixtures as fx
from ..sources import sinks
from .q_alerts import _A, ATTN_Z, HOT_LIFT, HOT_N, HOT_RATE, MIN_MONTHS, MIN_N, SINCE, SPIKE_Z
from .registry import query
from .sql_views import BULK, CASES, MIS_COMPANY, MIS_MONTHLY, R, mis_flags, scored, with_

LEX = (fx.FIXTURE_LEXICON, fx.FIXTURE_BOOSTERS, fx.FIXTURE_NEGATIONS, fx.FIXTURE_IDIOMS)


def _dir(spark, name):
    return scratch_path(spark, f"{name}_{uuid.uuid4().hex[:10]}")


@query("write_scored", with_(*scored(LEX)) + "SELECT year, count(*) AS rows FROM scored GROUP BY year")
def q_write_scored(spark, sf):
    """Scored fact written partitioned by year, read back per year."""
    p = _dir(spark, "scored")
    sinks.write_scored(fx.scored_fact(spark, sf), p)
    return spark.read.parquet(p).groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


@query("write_mis", with_(BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY) + """
SELECT 'monthly' AS mis, year_month || ' ' || segment AS key, complaints, timely_rate, relief_rate, narrative_rate, CAST(NULL AS INTEGER) AS rank FROM mis_monthly
UNION ALL SELECT 'company', company, complaints, timely_rate, relief_rate, narrative_rate, CAST(rank AS INTEGER) FROM mis_company""")
def q_write_mis(spark, sf):
    """Both MIS tables written from one scan and read back."""
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    p = _dir(spark, "mis")
    sinks.write_mis(mis.monthly_of(r), mis.league_of(r, fx.TARGET_COMPANY), p)
    shared = ("complaints", "timely_rate", "relief_rate", "narrative_rate")
    m = spark.read.parquet(f"{p}/mis_industry_monthly").select(F.lit("monthly").alias("mis"), F.concat_ws(" ", "year_month", "segment").alias("key"), *shared, F.lit(None).cast("int").alias("rank"))
    c = spark.read.parquet(f"{p}/mis_company_benchmark").select(F.lit("company").alias("mis"), F.col("company").alias("key"), *shared, "rank")
    return m.unionByName(c)


_STAR = {"fact_complaints": "is_escalated", "dim_date": "year", "mis_industry_monthly": "complaints", "mis_company_benchmark_top200": "complaints"}


@query("write_csv_star", with_(*scored(LEX), BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY) + """
SELECT 'fact_complaints' AS name, count(*) AS rows, CAST(sum(is_escalated) AS BIGINT) AS total, min(strftime(date_received, '%Y-%m-%d')) AS first_day FROM scored
UNION ALL SELECT 'dim_date', count(*), CAST(sum(year(d)) AS BIGINT), min(strftime(d, '%Y-%m-%d'))
  FROM (SELECT DISTINCT CAST(date_received AS DATE) AS d FROM scored WHERE date_received IS NOT NULL) x
UNION ALL SELECT 'mis_industry_monthly', count(*), CAST(sum(complaints) AS BIGINT), NULL FROM mis_monthly
UNION ALL SELECT 'mis_company_benchmark_top200', count(*), CAST(sum(complaints) AS BIGINT), NULL FROM mis_company WHERE rank <= 200""")
def q_write_csv_star(spark, sf):
    """Lean fact, date dimension and MIS tables as header CSVs with ISO dates, all four read back."""
    f = fx.scored_fact(spark, sf)
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    p = _dir(spark, "star")
    sinks.write_csv_star({"fact_complaints": f.drop("narrative"), "dim_date": bi.dim_date(f), "mis_industry_monthly": mis.monthly_of(r),
                          "mis_company_benchmark_top200": mis.league_of(r, fx.TARGET_COMPANY).filter(F.col("rank") <= 200)}, p)
    days = {"fact_complaints": F.substring("date_received", 1, 10), "dim_date": F.col("date")}
    got = [spark.read.option("header", True).csv(f"{p}/{k}").agg(
        F.lit(k).alias("name"), F.count(F.lit(1)).alias("rows"), F.sum(F.col(c).cast("long")).alias("total"),
        F.min(days.get(k, F.lit(None).cast("string"))).alias("first_day")) for k, c in _STAR.items()]
    return reduce(DataFrame.unionByName, got)


_BENCH = "year_month >= '1997-01'"
_FEED = "synthetic case feed"


@query("write_extract_json", _A.rstrip() + ",\n" + ",\n".join((BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY)) + f""",
rg AS (SELECT escalation_score AS s, sum(CASE WHEN is_escalated = 1 THEN 1 ELSE 0 END) AS pos,
  sum(CASE WHEN is_escalated = 1 THEN 0 ELSE 1 END) AS neg FROM scored WHERE escalation_score IS NOT NULL GROUP BY 1),
auc AS (SELECT sum(pos * ((cneg - neg) + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc
  FROM (SELECT *, sum(neg) OVER (ORDER BY s ROWS UNBOUNDED PRECEDING) AS cneg FROM rg) c),
bd AS (""" + " UNION ALL ".join(f"(SELECT count(*) AS value FROM dated GROUP BY {c} ORDER BY value DESC{f' LIMIT {n}' if n else ''})" for _, c, n in X.BREAKDOWNS) + """),
rk AS (""" + " UNION ALL ".join(f"(SELECT {R('r')} AS v FROM (SELECT {by} AS label, count(*) AS n, avg({c}) AS r FROM dated GROUP BY 1) g WHERE n >= 50 ORDER BY r DESC, label LIMIT {n})" for _, by, c, n in X.RISKS)
 + f" UNION ALL (SELECT {R('a')} FROM (SELECT product, avg(sent_compound) AS a FROM dated GROUP BY 1) g ORDER BY a, product LIMIT 8)" + f"""),
xp AS (SELECT complaint_id FROM dated WHERE has_narrative = 1 ORDER BY greatest(escalation_score, churn_risk_score) DESC, complaint_id LIMIT 700),
al AS (SELECT severity FROM attention UNION ALL SELECT severity FROM anomalies UNION ALL SELECT severity FROM hotspots
       UNION ALL SELECT severity FROM (VALUES ('critical'), ('serious'), ('warning')) v(severity)
       UNION ALL SELECT NULL FROM (SELECT DISTINCT year_month FROM series) y)
SELECT 'generated_from' AS section, CAST(1 AS BIGINT) AS rows, CAST({len(_FEED)} AS DOUBLE) AS total
UNION ALL SELECT 'company', 1, length('{fx.TARGET_COMPANY}')
UNION ALL SELECT 'kpis', 1, count(*) FROM dated
UNION ALL SELECT 'states_metrics', count(*), sum(n) FROM (SELECT upper(trim(state)) AS st, count(*) AS n FROM dated GROUP BY 1) x WHERE regexp_matches(st, '^[A-Z]{{2}}$')
UNION ALL SELECT 'monthly', count(*), {R('sum(escalation_rate)', 3)} FROM monthly
UNION ALL SELECT 'breakdowns', count(*), sum(value) FROM bd
UNION ALL SELECT 'risk', count(*), {R('sum(v)', 3)} FROM rk
UNION ALL SELECT 'models', 1, {R('max(roc_auc)', 3)} FROM auc
UNION ALL SELECT 'industry', count(*), sum(complaints) FROM (SELECT complaints FROM mis_company WHERE rank <= 15 UNION ALL SELECT complaints FROM mis_monthly WHERE {_BENCH}) i
UNION ALL SELECT 'complaints', count(*), sum(complaint_id) FROM xp
UNION ALL SELECT 'alerts', count(*), count(severity) FROM al""")
def q_write_extract_json(spark, sf):
    """All eleven dashboard sections as JSON lines, read back: rows and a sum of each."""
    f = fx.scored_fact(spark, sf)
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    auc = M.roc_auc(f, "escalation_score", "is_escalated").select(
        F.lit("escalation").alias("model"), "roc_auc", *[F.lit(None).cast(t).alias(c) for c, t in (("pr_auc", "double"), ("n_train", "long"), ("n_test", "long"))])
    limits = {"attention": dict(min_n=MIN_N, min_months=MIN_MONTHS, z_threshold=ATTN_Z), "anomalies": dict(min_n=MIN_N, min_months=MIN_MONTHS, z_threshold=SPIKE_Z, since=SINCE),
              "hotspots": dict(min_n=HOT_N, min_lift=HOT_LIFT, min_rate=HOT_RATE), "timeline": dict(min_n=MIN_N, min_months=MIN_MONTHS)}
    sections = X.extract_sections(f, mis.monthly_of(r), mis.league_of(r, fx.TARGET_COMPANY), auc, fx.TARGET_COMPANY, _FEED,
                                  since="1997-01", alert_limits=limits, trend=D.monthly_trend(f).checkpoint())
    p = _dir(spark, "extract")
    sinks.write_extract_json(sections, p)
    measure = {"generated_from": F.sum(F.length("value")), "company": F.sum(F.length("value")), "kpis": F.sum("total_complaints"),
               "states_metrics": F.sum("n"), "monthly": rnd(F.sum("escalation_rate"), 3), "breakdowns": F.sum("value"),
               "risk": rnd(F.sum(F.coalesce("rate", "avg_sentiment")), 3), "models": rnd(F.sum("roc_auc"), 3), "industry": F.sum("complaints"),
               "complaints": F.sum("id"), "alerts": F.count("severity")}
    got = [spark.read.schema(t.schema).json(f"{p}/{k}").agg(F.lit(k).alias("section"), F.count(F.lit(1)).alias("rows"), measure[k].cast("double").alias("total"))
           for k, t in sections.items()]
    return reduce(DataFrame.unionByName, got)


@query("load_warehouse", with_(*scored(LEX), BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY) + """
SELECT 'scored_complaints' AS name, count(*) AS rows, CAST(sum(is_escalated) AS BIGINT) AS total FROM scored
UNION ALL SELECT 'mis_company_benchmark', count(*), CAST(sum(complaints) AS BIGINT) FROM mis_company
UNION ALL SELECT 'mis_industry_monthly', count(*), CAST(sum(complaints) AS BIGINT) FROM mis_monthly""")
def q_load_warehouse(spark, sf):
    """The three curated tables replaced in the catalog as external tables, and read from it."""
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    tables = {"scored_complaints": (fx.scored_fact(spark, sf), "is_escalated"), "mis_industry_monthly": (mis.monthly_of(r), "complaints"),
              "mis_company_benchmark": (mis.league_of(r, fx.TARGET_COMPANY), "complaints")}
    sinks.load_warehouse({k: t for k, (t, _) in tables.items()}, _dir(spark, "warehouse"))
    got = [spark.table(f"default.{k}").agg(F.lit(k).alias("name"), F.count(F.lit(1)).alias("rows"), F.sum(c).cast("long").alias("total")) for k, (_, c) in tables.items()]
    return got[0].unionByName(got[1]).unionByName(got[2])


@query("refresh_log", with_(*scored(LEX)) + "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS new_rows, false AS retrained FROM scored")
def q_refresh_log(spark, sf):
    """A refresh stamp (rows, new rows, retrained) appended to the log table."""
    f = fx.scored_fact(spark, sf)
    n = f.count()
    p = _dir(spark, "log")
    sinks.append_log(refresh_log(spark, n, 0, False), p)
    return spark.read.parquet(p).select("rows", "new_rows", "retrained")


@query("scan_json_hits", with_(CASES) + "SELECT count(*) AS rows, count(date_received) AS dated FROM cases")
def q_scan_json_hits(spark, sf):
    """API payload files (hits wrapping _source) read with the fixed schema."""
    from ..sources.files import read_cases_json
    c = fx.cases(spark, sf).drop("score_hint_a", "score_hint_b")
    hits = c.select(F.col("complaint_id").cast("string").alias("_id"),
                    F.struct(*[F.col(x).cast("string").alias(x) for x in c.columns]).alias("_source"))
    p = _dir(spark, "hits")
    hits.write.mode("overwrite").json(p)
    return read_cases_json(spark, p, company=fx.TARGET_COMPANY, multiline=False) \
        .agg(F.count(F.lit(1)).alias("rows"), F.count("date_received").alias("dated"))


@query("scan_bulk_csv", with_(BULK) + """
SELECT product, count(*) AS rows, count(date_received) AS dated, count(DISTINCT company) AS companies,
       count(*) FILTER (WHERE trim(timely) = 'Yes') AS timely, min(date_received) AS first_day
FROM bulk GROUP BY product""")
def q_scan_bulk_csv(spark, sf):
    """Bulk export CSV (header names, quoted multi-line text) written, read back by ranges and renamed."""
    from ..schemas import BULK_COLUMN_MAP
    from ..sources.files import read_bulk_csv
    inv = {v: k for k, v in BULK_COLUMN_MAP.items()}
    b = fx.bulk(spark, sf)
    out = b.select(*[F.col(c).cast("string").alias(inv[c]) for c in b.columns if c in inv])
    # texts of several lines, with quotes and commas, so that records reach over lines and ranges
    text = inv["complaint_what_happened"]
    out = out.withColumn(text, F.when(F.col(text) != "", F.concat(F.lit('said "one,\n'), F.col(text), F.lit('"\n\ntwo'))))
    p = _dir(spark, "bulkcsv")
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(p)
    r = read_bulk_csv(spark, p)
    return r.groupBy("product").agg(
        F.count(F.lit(1)).alias("rows"), F.count("date_received").alias("dated"), F.count_distinct("company").alias("companies"),
        F.count_if(F.trim("timely") == "Yes").alias("timely"), F.min("date_received").alias("first_day"))
