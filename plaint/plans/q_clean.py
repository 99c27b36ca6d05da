"""Scans, cleaning, scalar functions, de-dup and distinct over the case feeds."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, labels, text
from ..operators import clean as C
from ..sources import files
from ..sources import fixtures as fx
from .registry import query
from .sql_views import BULK, CASES, CLEAN_NARRATIVE, R, STRIP, cleaned, with_

_CLEAN = with_(CASES, cleaned("cases"))


def _cleaned(spark, sf):
    return C.clean(fx.cases(spark, sf))


@query("clean_narrative", with_(CASES) + f"""
SELECT complaint_id, {CLEAN_NARRATIVE("complaint_what_happened")} AS narrative FROM cases""")
def q_clean_narrative(spark, sf):
    """Redaction tokens removed, whitespace collapsed, stripped (whole texts)."""
    c = fx.cases(spark, sf)
    return c.select("complaint_id", text.clean_narrative("complaint_what_happened").alias("narrative"))


@query("narrative_length", _CLEAN + "SELECT complaint_id, narrative_length, has_narrative FROM cleaned")
def q_narrative_length(spark, sf):
    """Code-point length and presence flag of the cleaned narrative."""
    return _cleaned(spark, sf).select("complaint_id", "narrative_length", "has_narrative")


@query("calendar_keys", _CLEAN + "SELECT complaint_id, year, month, year_month, quarter FROM cleaned")
def q_calendar_keys(spark, sf):
    """year, month, yyyy-MM and yyyyQn keys."""
    return _cleaned(spark, sf).select("complaint_id", "year", "month", "year_month", "quarter")


@query("handling_days", _CLEAN + "SELECT complaint_id, handling_days FROM cleaned")
def q_handling_days(spark, sf):
    """Days from receipt to forwarding, floored at 0, 2 dp, null-safe."""
    return _cleaned(spark, sf).select("complaint_id", "handling_days")


@query("fill_unknown", _CLEAN + """
SELECT product, sub_product, issue, state, submitted_via, company_response, count(*) AS n
FROM cleaned GROUP BY ALL""")
def q_fill_unknown(spark, sf):
    """null -> Unknown then strip on the categorical columns (grouped)."""
    cols = ["product", "sub_product", "issue", "state", "submitted_via", "company_response"]
    return _cleaned(spark, sf).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


@query("label_escalated", _CLEAN + "SELECT complaint_id, is_escalated FROM cleaned")
def q_label_escalated(spark, sf):
    """is_escalated = relief response OR untimely."""
    return _cleaned(spark, sf).select("complaint_id", "is_escalated")


@query("flag_timely_relief", _CLEAN + """
SELECT timely_flag, relief_flag, count(*) AS n FROM cleaned GROUP BY ALL""")
def q_flag_timely_relief(spark, sf):
    """timely_flag and relief_flag distribution."""
    return _cleaned(spark, sf).groupBy("timely_flag", "relief_flag").agg(F.count(F.lit(1)).alias("n"))


@query("coerce_types", with_(CASES) + """
SELECT complaint_id, date_received, date_sent_to_company, coalesce(complaint_what_happened, '') AS complaint_what_happened,
       company, timely FROM cases""")
def q_coerce_types(spark, sf):
    """Safe casts of a textual feed: dates arrive in six text forms, ids as text."""
    k = F.pmod("complaint_id", F.lit(6))
    forms = ["yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'", "yyyy-MM-dd HH:mm:ss.SSS", "yyyyMMdd", "MM/dd/yyyy", "' 'yyyy-MM-dd' '"]

    def text(c):
        out = F.date_format(c, forms[0])
        for i, f in enumerate(forms[1:], 1):
            out = F.when(k == i, F.date_format(c, f)).otherwise(out)
        return out
    c = fx.cases(spark, sf).select(
        F.col("complaint_id").cast("string").alias("complaint_id"),
        text("date_received").alias("date_received"), text("date_sent_to_company").alias("date_sent_to_company"),
        "complaint_what_happened", "company", "timely")
    t = files.coerce_types(c)
    return t.select("complaint_id", "date_received", "date_sent_to_company",
                    "complaint_what_happened", "company", "timely")


@query("source_company_filter", with_(BULK) + """
SELECT company, count(*) AS rows FROM bulk WHERE company = 'Supplier#000000000' GROUP BY 1""")
def q_source_company_filter(spark, sf):
    """Target-company rows of the industry feed."""
    kept = files.source_company_filter(fx.bulk(spark, sf), fx.TARGET_COMPANY)
    return kept.groupBy("company").agg(F.count(F.lit(1)).alias("rows"))


@query("scan_pruned_parquet", "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R'")
def q_scan_pruned_parquet(spark, sf):
    """Column-pruned Parquet scan with a pushed filter."""
    df = files.read_pruned_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_shipdate", "l_returnflag"])
    return df.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_shipdate")


@query("profile_source", with_(CASES) + """
SELECT count(*) AS rows, min(date_received) AS date_min, max(date_received) AS date_max,
       count(*) FILTER (WHERE length(coalesce(complaint_what_happened, '')) > 0) AS with_narrative FROM cases""")
def q_profile_source(spark, sf):
    """Rows, date range, rows with narrative."""
    return files.profile_source(fx.cases(spark, sf))


_FEED = """feed AS (SELECT l_orderkey AS complaint_id, CAST(l_shipdate AS TIMESTAMP) AS date_received,
  CAST(l_shipdate AS TIMESTAMP) + to_days(l_linenumber) AS date_sent_to_company,
  l_returnflag AS product, l_linestatus AS issue,
  CASE WHEN l_returnflag = 'R' THEN 'Closed with monetary relief' ELSE 'Closed with explanation' END AS company_response,
  CASE WHEN l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS timely,
  'line ' || CAST(l_linenumber AS VARCHAR) AS complaint_what_happened FROM lineitem)"""


@query("dedup_by_id", with_(_FEED) + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY complaint_id ORDER BY
  date_received DESC NULLS LAST, date_sent_to_company DESC NULLS LAST, product DESC NULLS LAST,
  issue DESC NULLS LAST, company_response DESC NULLS LAST, timely DESC NULLS LAST,
  complaint_what_happened DESC NULLS LAST) AS rn FROM feed) WHERE rn = 1""")
def q_dedup_by_id(spark, sf):
    """One row per id: newest received, then newest sent, then a total order."""
    return C.dedup_by_id(fx.feed(spark, sf))


@query("dup_count", with_(_FEED) + """
SELECT count(*) - count(DISTINCT complaint_id) - max(CAST(complaint_id IS NULL AS INTEGER)) AS duplicates_dropped FROM feed""")
def q_dup_count(spark, sf):
    """Rows a de-dup on the id drops."""
    return C.dup_count(fx.feed(spark, sf))


@query("distinct_dates", with_(CASES) + """
SELECT DISTINCT CAST(date_received AS DATE) AS date FROM cases WHERE date_received IS NOT NULL""")
def q_distinct_dates(spark, sf):
    """Distinct non-null days."""
    c = fx.cases(spark, sf)
    return c.select(F.to_date("date_received").alias("date")).filter(F.col("date").isNotNull()).distinct()


@query("state_code", with_(CASES) + f"""
SELECT CASE WHEN regexp_matches(upper({STRIP('state')}), '^[A-Z]{{2}}$') THEN upper({STRIP('state')}) END AS state,
       count(*) AS n FROM cases GROUP BY 1""")
def q_state_code(spark, sf):
    """Trimmed upper-case two-letter state codes (else null), counted."""
    c = fx.cases(spark, sf)
    return c.groupBy(text.state_code("state").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("snippet", _CLEAN + """
SELECT complaint_id, CASE WHEN length(narrative) > 240 THEN substr(narrative, 1, 240) || '…' ELSE narrative END AS snippet
FROM cleaned""")
def q_snippet(spark, sf):
    """First 240 characters plus an ellipsis when longer."""
    return _cleaned(spark, sf).select("complaint_id", text.snippet("narrative", 240).alias("snippet"))


@query("safe_rate", _CLEAN + f"""
SELECT issue, count(*) FILTER (WHERE is_escalated = 1) AS escalated,
       count(*) FILTER (WHERE handling_days > 5) AS slow,
       {R("CAST(count(*) FILTER (WHERE is_escalated = 1) AS DOUBLE) / nullif(count(*) FILTER (WHERE handling_days > 5), 0)")} AS ratio
FROM cleaned GROUP BY issue""")
def q_safe_rate(spark, sf):
    """DIVIDE semantics: null on a zero denominator (ANSI-safe)."""
    from ..functions.numeric import rnd
    c = _cleaned(spark, sf)
    esc = F.count_if(F.col("is_escalated") == 1)
    slow = F.count_if(F.col("handling_days") > 5)
    return c.groupBy("issue").agg(esc.alias("escalated"), slow.alias("slow"),
                                  rnd(labels.safe_rate(esc, slow), 4).alias("ratio"))
