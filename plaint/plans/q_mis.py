"""Industry MIS queries over the bulk stand-in (lineitem x supplier x part)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import mis
from ..sources import fixtures as fx
from .registry import query
from .sql_views import BULK, MIS_COMPANY, MIS_MONTHLY, R, mis_flags, with_

_BASE = with_(BULK, mis_flags())


def _monthly(spark, sf):
    return mis.mis_monthly(fx.bulk(spark, sf), fx.TARGET_COMPANY)


def _league(spark, sf):
    return mis.mis_company(fx.bulk(spark, sf), fx.TARGET_COMPANY)


@query("mis_monthly", with_(BULK, mis_flags(), MIS_MONTHLY) + "SELECT * FROM mis_monthly")
def q_mis_monthly(spark, sf):
    """Monthly complaints/timely/relief/narrative for Industry and Target segments."""
    return _monthly(spark, sf)


@query("mis_company", with_(BULK, mis_flags(), MIS_COMPANY) + "SELECT * FROM mis_company")
def q_mis_company(spark, sf):
    """Company league table with rates, rank and target flag."""
    return _league(spark, sf)


@query("company_rank", with_(BULK, mis_flags(), MIS_COMPANY)
       + "SELECT company, complaints, rank FROM mis_company")
def q_company_rank(spark, sf):
    """Rank of every company by complaint volume (ties by name)."""
    return _league(spark, sf).select("company", "complaints", "rank")


@query("mis_partial_final", with_(BULK, mis_flags(), MIS_MONTHLY)
       + "SELECT segment, CAST(sum(complaints) AS BIGINT) AS complaints, CAST(sum(timely) AS BIGINT) AS timely, "
         "count(*) AS months FROM mis_monthly GROUP BY segment")
def q_mis_partial_final(spark, sf):
    """Monthly MIS re-aggregated per segment: checks partial+final aggregation merges."""
    m = _monthly(spark, sf)
    return m.groupBy("segment").agg(F.sum("complaints").alias("complaints"),
                                    F.sum("timely").alias("timely"),
                                    F.count(F.lit(1)).alias("months"))


@query("mis_summary", with_(BULK, mis_flags(), MIS_MONTHLY, MIS_COMPANY) + """
SELECT (SELECT CAST(sum(complaints) AS BIGINT) FROM mis_company) AS total_rows_processed,
       (SELECT count(*) FROM mis_company) AS distinct_companies,
       (SELECT count(DISTINCT year_month) FROM mis_monthly) AS months,
       (SELECT max(rank) FROM mis_company WHERE is_target) AS target_rank""")
def q_mis_summary(spark, sf):
    """Total rows, companies, months, target rank, from one scan of the bulk table."""
    r = mis.mis_rollup(fx.bulk(spark, sf), fx.TARGET_COMPANY).checkpoint()
    return mis.mis_summary(mis.monthly_of(r), mis.league_of(r, fx.TARGET_COMPANY))


@query("distinct_companies", _BASE + """
SELECT count(DISTINCT coalesce(company, 'Unknown')) AS distinct_companies,
       count(DISTINCT year_month) AS months FROM mflags""")
def q_distinct_companies(spark, sf):
    """Exact distinct companies and months."""
    return mis.distinct_companies(fx.bulk(spark, sf))


@query("upper_equals_target", _BASE + """
SELECT count(*) FILTER (WHERE is_target) AS target_rows, count(*) AS rows FROM mflags""")
def q_upper_equals_target(spark, sf):
    """Case-insensitive target-company match counted over the bulk rows."""
    f = mis.mis_flags(fx.bulk(spark, sf), fx.TARGET_COMPANY)
    return f.agg(F.count_if("is_target").alias("target_rows"), F.count(F.lit(1)).alias("rows"))


@query("top_companies", with_(BULK, mis_flags(), MIS_COMPANY) + """
SELECT substr(company, 1, 40) AS company, complaints, timely_rate, relief_rate, is_target, rank
FROM mis_company WHERE rank <= 15""")
def q_top_companies(spark, sf):
    """First 15 rows of the league table."""
    return mis.top_companies(_league(spark, sf), 15)


@query("industry_context", with_(BULK, mis_flags(), MIS_COMPANY) + """
SELECT substr(company, 1, 40) AS company, complaints, timely_rate, relief_rate, is_target, rank,
       CAST(sum(complaints) OVER () AS BIGINT) AS total_rows_processed, count(*) OVER () AS distinct_companies,
       max(CASE WHEN is_target THEN rank END) OVER () AS target_rank,
       max(CASE WHEN is_target THEN timely_rate END) OVER () AS target_timely_rate,
       max(CASE WHEN is_target THEN relief_rate END) OVER () AS target_relief_rate
FROM mis_company QUALIFY rank <= 15""")
def q_industry_context(spark, sf):
    """Top 15 companies with industry totals and the target's rank/rates."""
    return mis.industry_context(_league(spark, sf), 15)


@query("industry_benchmark", with_(BULK, mis_flags(), MIS_MONTHLY) + """
SELECT year_month, segment, complaints, timely_rate, relief_rate
FROM mis_monthly WHERE year_month >= '1997-01'""")
def q_industry_benchmark(spark, sf):
    """Monthly benchmark rows since a start month, both segments."""
    return mis.industry_benchmark(_monthly(spark, sf), since="1997-01")
