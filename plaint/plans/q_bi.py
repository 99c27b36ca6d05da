"""Star schema and BI time-intelligence queries over the cleaned case feed."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bi
from ..operators.clean import dedup_by_id
from ..sources import fixtures as fx
from .registry import query
from .sql_views import CASES, R, cleaned, with_

_C = with_(CASES, cleaned("cases"))
_MONTHLY = """mc AS (SELECT date_trunc('month', CAST(date_received AS DATE)) AS month, count(*) AS complaints
               FROM cleaned WHERE date_received IS NOT NULL GROUP BY 1)"""


def _fact(spark, sf):
    """The feed's days, one row per id: the newest day survives whatever the other columns hold."""
    return dedup_by_id(fx.cases(spark, sf).select("complaint_id", "date_received"))


@query("dim_date", _C + """
SELECT DISTINCT CAST(date_received AS DATE) AS date, CAST(year(date_received) AS INTEGER) AS year,
       CAST(quarter(date_received) AS INTEGER) AS quarter, CAST(month(date_received) AS INTEGER) AS month,
       strftime(date_received, '%b') AS month_name, strftime(date_received, '%Y-%m') AS year_month
FROM cleaned WHERE date_received IS NOT NULL""")
def q_dim_date(spark, sf):
    """Date dimension over the days with data."""
    return bi.dim_date(_fact(spark, sf))


@query("dim_date_calendar", _C + """
SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, strftime(d, '%b') AS month_name, strftime(d, '%Y-%m') AS year_month
FROM (SELECT unnest(generate_series(min(CAST(date_received AS DATE)), max(CAST(date_received AS DATE)), INTERVAL 1 DAY)) AS d
      FROM cleaned) s""")
def q_dim_date_calendar(spark, sf):
    """Contiguous calendar variant for time intelligence."""
    return bi.dim_date_calendar(_fact(spark, sf))


@query("join_dim_date", _C + """
SELECT CAST(quarter(date_received) AS INTEGER) AS quarter, strftime(date_received, '%b') AS month_name, count(*) AS n
FROM cleaned WHERE date_received IS NOT NULL GROUP BY 1, 2""")
def q_join_dim_date(spark, sf):
    """Fact joined N:1 to the date dimension, counted per quarter and month name."""
    f = _fact(spark, sf)
    j = bi.join_dim_date(f, bi.dim_date(f)).filter(F.col("date").isNotNull())
    return j.groupBy("quarter", "month_name").agg(F.count(F.lit(1)).alias("n"))


def _chg(k, out):
    return _C + "," + _MONTHLY + f"""
SELECT CAST(c.month AS DATE) AS month, c.complaints, p.complaints AS previous,
       {R('(c.complaints - p.complaints) * 1.0 / nullif(p.complaints, 0)')} AS {out}
FROM mc c LEFT JOIN mc p ON p.month = c.month - INTERVAL {k} MONTH"""


@query("mom_change", _chg(1, "mom_change"))
def q_mom_change(spark, sf):
    """Month-over-month change vs the previous calendar month."""
    return bi.mom_change(_fact(spark, sf))


@query("yoy_change", _chg(12, "yoy_change"))
def q_yoy_change(spark, sf):
    """Year-over-year change vs the same month a year earlier."""
    return bi.yoy_change(_fact(spark, sf))


_ROLL = _C + """, daily AS (SELECT CAST(date_received AS DATE) AS day, count(*) AS n FROM cleaned
                 WHERE date_received IS NOT NULL GROUP BY 1),
m AS (SELECT date_trunc('month', day) AS month, max(day) AS last_day FROM daily GROUP BY 1)
SELECT CAST(m.month AS DATE) AS month, CAST(sum(d.n) AS BIGINT) AS rolling_3m
FROM m JOIN daily d ON d.day > m.last_day - INTERVAL 3 MONTH AND d.day <= m.last_day GROUP BY 1"""


@query("rolling_3m", _ROLL)
def q_rolling_3m(spark, sf):
    """Complaints in the 3 months up to each month's last day (DATESINPERIOD)."""
    return bi.rolling_3m(_fact(spark, sf))


@query("join_period_range", _ROLL)
def q_join_period_range(spark, sf):
    """Range (theta) join of months with the days in their trailing 3-month period."""
    return bi.rolling_3m(_fact(spark, sf))
