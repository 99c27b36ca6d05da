"""DuckDB SQL fragments mirroring the stand-in inputs of sources/fixtures.py.

Used only by the oracle SQL of each query (the correctness gate)."""
from __future__ import annotations


def R(x: str, d: int = 4) -> str:
    """Round like functions.numeric.rnd: half-up, after a first rounding at 9 places."""
    return f"CAST(round(round(CAST({x} AS DECIMAL(38,12)), 9), {d}) AS DOUBLE)"


def STRIP(x: str) -> str:
    """Python-style strip of any whitespace."""
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def RATE(num: str, den: str, d: int = 4) -> str:
    return R(f"(({num}) * 1.0 / ({den}))", d)


BULK = """bulk AS (
  SELECT CAST(l.l_shipdate AS TIMESTAMP) AS date_received, s.s_name AS company,
         p.p_brand AS product, p.p_type AS issue,
         CASE WHEN l.l_linestatus = 'O' THEN 'Yes' ELSE ' no ' END AS timely,
         CASE l.l_returnflag WHEN 'R' THEN 'Closed with monetary relief'
              WHEN 'A' THEN 'Closed with explanation'
              ELSE 'Closed with non-monetary relief' END AS company_response,
         CASE WHEN l.l_tax > 0.04 THEN 'text' ELSE '' END AS complaint_what_happened
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
                  JOIN part p ON l.l_partkey = p.p_partkey)"""

TARGET = "Supplier#000000000"


def mis_flags(src: str = "bulk") -> str:
    return f"""mflags AS (
  SELECT strftime(date_received, '%Y-%m') AS year_month, company,
         coalesce(lower({STRIP('timely')}) = 'yes', false) AS timely_yes,
         coalesce(company_response IN ('Closed with monetary relief', 'Closed with non-monetary relief'), false) AS relief,
         length(coalesce(complaint_what_happened, '')) > 0 AS has_narr,
         upper(coalesce(company, '')) = upper('{TARGET}') AS is_target
  FROM {src})"""


MIS_MONTHLY = f"""mis_monthly AS (
  SELECT year_month, segment, complaints, timely, relief, narrative,
         {RATE('timely', 'complaints')} AS timely_rate,
         {RATE('relief', 'complaints')} AS relief_rate,
         {RATE('narrative', 'complaints')} AS narrative_rate
  FROM (
    SELECT year_month, 'Industry' AS segment, count(*) AS complaints,
           count(*) FILTER (WHERE timely_yes) AS timely, count(*) FILTER (WHERE relief) AS relief,
           count(*) FILTER (WHERE has_narr) AS narrative
    FROM mflags WHERE year_month IS NOT NULL GROUP BY year_month
    UNION ALL
    SELECT year_month, 'Target', count(*), count(*) FILTER (WHERE timely_yes),
           count(*) FILTER (WHERE relief), count(*) FILTER (WHERE has_narr)
    FROM mflags WHERE year_month IS NOT NULL AND is_target GROUP BY year_month
  ) g
  WHERE complaints > 0 AND regexp_matches(year_month, '^\\d{{4}}-\\d{{2}}'))"""

MIS_COMPANY = f"""mis_company AS (
  SELECT company, complaints, timely, relief, narrative,
         {RATE('timely', 'complaints')} AS timely_rate,
         {RATE('relief', 'complaints')} AS relief_rate,
         {RATE('narrative', 'complaints')} AS narrative_rate,
         CAST(row_number() OVER (ORDER BY complaints DESC, company) AS INTEGER) AS rank,
         upper(company) = upper('{TARGET}') AS is_target
  FROM (SELECT coalesce(company, 'Unknown') AS company, count(*) AS complaints,
               count(*) FILTER (WHERE timely_yes) AS timely, count(*) FILTER (WHERE relief) AS relief,
               count(*) FILTER (WHERE has_narr) AS narrative
        FROM mflags GROUP BY 1) g)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CASES = """cases AS MATERIALIZED (
  SELECT o.o_orderkey AS complaint_id, CAST(o.o_orderdate AS TIMESTAMP) AS date_received,
         CAST(f.first_ship AS TIMESTAMP) AS date_sent_to_company, c.c_mktsegment AS product,
         CAST(NULL AS VARCHAR) AS sub_product, o.o_orderpriority AS issue, CAST(NULL AS VARCHAR) AS sub_issue,
         'Supplier#000000000' AS company,
         chr(CAST(65 + c.c_nationkey % 5 AS INTEGER)) || chr(CAST(65 + c.c_nationkey // 5 AS INTEGER)) AS state,
         CASE o.o_custkey % 4 WHEN 0 THEN 'Web' WHEN 1 THEN 'Phone' WHEN 2 THEN 'Referral' END AS submitted_via,
         CASE o.o_orderstatus WHEN 'F' THEN 'Closed with explanation' WHEN 'O' THEN 'Closed with monetary relief'
              ELSE 'In progress' END AS company_response,
         CASE WHEN f.first_ship IS NULL THEN NULL WHEN f.first_ship > o.o_orderdate THEN 'Yes' ELSE 'No' END AS timely,
         CASE WHEN d.text IS NULL THEN '' ELSE d.text || ' XX/XX/XXXX charged XXXX' END AS complaint_what_happened,
         (c.c_acctbal + 1000.0) / 11000.0 AS score_hint_a,
         o.o_totalprice / (o.o_totalprice + 200000.0) AS score_hint_b
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_orderkey) f
         ON f.l_orderkey = o.o_orderkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey)"""


def CLEAN_NARRATIVE(x: str) -> str:
    """Redaction tokens -> space (two passes: RE2 has no look-around, so a
    match consumes its neighbour), collapse whitespace, strip."""
    pat = "'(^|[^A-Za-z0-9_])X{2,}([^A-Za-z0-9_]|$)'"
    t = f"coalesce({x}, '')"
    t = f"regexp_replace(regexp_replace({t}, {pat}, '\\1 \\2', 'g'), {pat}, '\\1 \\2', 'g')"
    t = f"regexp_replace({t}, '\\s+', ' ', 'g')"
    return STRIP(t)


def cleaned(src: str, name: str = "cleaned") -> str:
    """clean() of a feed whose ids are unique (de-dup is checked separately)."""
    tidy = ", ".join(f"{STRIP(f'coalesce({c}, {chr(39)}Unknown{chr(39)})')} AS {c}"
                     for c in ("product", "sub_product", "issue", "sub_issue", "state",
                               "submitted_via", "company_response"))
    hd = ("(epoch_us(date_sent_to_company) - epoch_us(date_received)) / 86400000000.0")
    return f"""{name} AS MATERIALIZED (
  SELECT * EXCLUDE (product, sub_product, issue, sub_issue, state, submitted_via, company_response),
         {tidy},
         CAST(coalesce(lower({STRIP('timely')}) = 'yes', false) AS INTEGER) AS timely_flag,
         CAST(coalesce({STRIP('company_response')} IN ('Closed with monetary relief', 'Closed with non-monetary relief'), false) AS INTEGER) AS relief_flag,
         CAST(coalesce({STRIP('company_response')} IN ('Closed with monetary relief', 'Closed with non-monetary relief'), false)
              OR coalesce(lower({STRIP('timely')}) = 'no', false) AS INTEGER) AS is_escalated
  FROM (SELECT *, CAST(year(date_received) AS INTEGER) AS year, CAST(month(date_received) AS INTEGER) AS month,
               strftime(date_received, '%Y-%m') AS year_month,
               strftime(date_received, '%Y') || 'Q' || CAST(quarter(date_received) AS VARCHAR) AS quarter,
               CASE WHEN {hd} IS NULL THEN NULL ELSE {R(f'greatest({hd}, 0.0)', 2)} END AS handling_days,
               {CLEAN_NARRATIVE('complaint_what_happened')} AS narrative,
               CAST(length({CLEAN_NARRATIVE('complaint_what_happened')}) > 0 AS INTEGER) AS has_narrative,
               CAST(length({CLEAN_NARRATIVE('complaint_what_happened')}) AS INTEGER) AS narrative_length
        FROM {src}) c0)"""


def scored(lex) -> list[str]:
    """CASES -> cleaned -> sentiment -> scored (mirrors fixtures.scored_cases)."""
    from .sql_sentiment import band_sql, label_sql, sentiment_ctes
    return [CASES, cleaned("cases")] + sentiment_ctes("cleaned", "complaint_id", "narrative", *lex) + [
        f"""scored AS MATERIALIZED (
  SELECT c.*, s.sent_neg, s.sent_neu, s.sent_pos, s.sent_compound,
         {label_sql('s.sent_compound')} AS sentiment_label, {band_sql('s.sent_compound')} AS sentiment_band,
         CAST(coalesce(s.sent_compound <= -0.2, false) AS INTEGER) AS is_negative,
         c.score_hint_a AS escalation_score, CAST(coalesce(c.score_hint_a >= 0.5, false) AS INTEGER) AS escalation_flag,
         CAST(coalesce(s.sent_compound <= -0.2, false) AND (coalesce(c.timely_flag = 0, false)
              OR coalesce(c.relief_flag = 0, false) OR coalesce(contains(lower(c.company_response), 'dispute'), false))
              AS INTEGER) AS churn_risk_label,
         c.score_hint_b AS churn_risk_score, CAST(coalesce(c.score_hint_b >= 0.5, false) AS INTEGER) AS churn_high_risk
  FROM cleaned c LEFT JOIN sv_score s ON s.k = c.complaint_id)"""]
