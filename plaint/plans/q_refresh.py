"""Refresh joins over the cleaned case feed and a cache of earlier scores.

The cache stands for a previous run: the scored cases received before 1999
(a previous pull), read from the scored fact."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import refresh as RF
from ..operators.clean import clean
from ..operators.sentiment import enrich
from ..sources import fixtures as fx
from .registry import query
from .sql_views import CASES, cleaned, scored, with_

LEX = (fx.FIXTURE_LEXICON, fx.FIXTURE_BOOSTERS, fx.FIXTURE_NEGATIONS, fx.FIXTURE_IDIOMS)
CUT = "1999-01-01"
_S = with_(*scored(LEX), f"""cache AS (SELECT complaint_id, sent_compound FROM scored WHERE date_received < TIMESTAMP '{CUT}'),
fresh AS (SELECT * FROM cleaned)""")


def _fresh(spark, sf):
    return clean(fx.cases(spark, sf))


def _cache(spark, sf):
    f = fx.scored_fact(spark, sf)
    return f.filter(F.col("date_received") < F.lit(CUT).cast("timestamp")).select("complaint_id", *RF.SENT_COLS)


@query("refresh_left_join", _S + """
SELECT count(*) AS rows, count(c.sent_compound) AS cached FROM fresh f LEFT JOIN cache c ON c.complaint_id = f.complaint_id""")
def q_refresh_left_join(spark, sf):
    """Fresh rows LEFT JOIN cached scores on id."""
    j = RF.refresh_left_join(_fresh(spark, sf), _cache(spark, sf))
    return j.agg(F.count(F.lit(1)).alias("rows"), F.count("sent_compound").alias("cached"))


@query("refresh_new_rows", _S + """
SELECT count(*) AS new_rows FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.complaint_id = f.complaint_id)""")
def q_refresh_new_rows(spark, sf):
    """Rows without a cached score (anti-join)."""
    return RF.refresh_new_rows(_fresh(spark, sf), _cache(spark, sf)).agg(F.count(F.lit(1)).alias("new_rows"))


@query("refresh_reused_rows", _S + """
SELECT count(*) AS reused_rows FROM fresh f WHERE EXISTS (SELECT 1 FROM cache c WHERE c.complaint_id = f.complaint_id)""")
def q_refresh_reused_rows(spark, sf):
    """Rows with a cached score (semi-join)."""
    return RF.refresh_reused_rows(_fresh(spark, sf), _cache(spark, sf)).agg(F.count(F.lit(1)).alias("reused_rows"))


@query("refresh_merge", _S + "SELECT complaint_id, sent_compound, sentiment_label FROM scored")
def q_refresh_merge(spark, sf):
    """Reused cached sentiment UNION newly scored rows = a full re-score."""
    def score_new(df):
        return enrich(df, "narrative", **fx.fixture_lexicons(spark), key="complaint_id")
    m = RF.refresh_merge(_fresh(spark, sf), _cache(spark, sf), score_new)
    return m.select("complaint_id", "sent_compound", "sentiment_label")


@query("dedup_cache", _S + """, dup AS (SELECT * FROM cache UNION ALL SELECT * FROM cache)
SELECT count(*) AS rows, count(DISTINCT complaint_id) AS ids FROM (SELECT DISTINCT complaint_id, sent_compound FROM dup) d""".replace(
    "\n, dup AS", ",\ndup AS"))
def q_dedup_cache(spark, sf):
    """Distinct cached scores per id (a cache holding every id twice)."""
    c = _cache(spark, sf)
    d = RF.dedup_cache(c.unionByName(c))
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("complaint_id").alias("ids"))


_ = (CASES, cleaned)
