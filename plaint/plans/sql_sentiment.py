"""DuckDB rendering of the sentiment rules, for the oracle SQL.

Deliberately a different formulation from the Spark job (window lag/lead over
unnested tokens instead of packed neighbour structs), so the two cross-check.
"""
from __future__ import annotations

from ..operators.sentiment import (ALL_RULES, ALPHA, BUT_AFTER, BUT_BEFORE, C_INCR,
                                   DAMP, EXCLAIM_MAX, EXCLAIM_STEP, N_SCALAR,
                                   NEVER_SO, QUESTION_CAP, QUESTION_STEP)
from .sql_views import R


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols: str, types: list[str]) -> str:
    def lit(v, t):
        return _q(v) if t == "s" else f"CAST({v!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return f"(VALUES {body}) AS t({cols})"


def _upper(x: str) -> str:
    # Java/Python upper-case the sharp s to "SS"
    return f"replace(upper({x}), 'ß', 'SS')"


def _is_upper(x: str) -> str:
    return f"({x} <> lower({x}) AND {x} = {_upper(x)})"


PUNCT = "'^[[:punct:]]+|[[:punct:]]+$'"


def tokens_sql(text: str) -> str:
    raw = f"list_filter(string_split_regex(coalesce({text}, ''), '\\s+'), lambda x: x <> '')"
    strip = f"regexp_replace(t, {PUNCT}, '', 'g')"
    return f"list_transform({raw}, lambda t: CASE WHEN length({strip}) <= 2 THEN t ELSE {strip} END)"


def punct_sql(text: str) -> str:
    t = f"coalesce({text}, '')"
    ex = f"(length({t}) - length(replace({t}, '!', '')))"
    qm = f"(length({t}) - length(replace({t}, '?', '')))"
    return (f"(least({ex}, {EXCLAIM_MAX}) * {EXCLAIM_STEP} + CASE WHEN {qm} > 1 THEN "
            f"(CASE WHEN {qm} <= 3 THEN {qm} * {QUESTION_STEP} ELSE {QUESTION_CAP} END) ELSE 0.0 END)")


def lookup_ctes(lexicon, boosters, negations, idioms) -> list[str]:
    lex = _values(lexicon, "word, valence", ["s", "d"])
    boo = _values(boosters, "word, boost", ["s", "d"])
    neg = _values([(w,) for w in negations], "word", ["s"])
    idi = _values(idioms, "phrase, special", ["s", "d"])
    return [
        f"""vocab AS (SELECT word, max(valence) AS valence, max(boost) AS boost, bool_or(neg) AS neg FROM (
  SELECT lower(word) AS word, valence, CAST(NULL AS DOUBLE) AS boost, CAST(NULL AS BOOLEAN) AS neg FROM {lex}
  UNION ALL SELECT lower(word), NULL, boost, NULL FROM {boo}
  UNION ALL SELECT lower(word), NULL, NULL, true FROM {neg}) u GROUP BY word)""",
        f"""phr AS (SELECT phrase, max(special) AS special, max(pboost) AS pboost FROM (
  SELECT lower(phrase) AS phrase, special, CAST(NULL AS DOUBLE) AS pboost FROM {idi}
  UNION ALL SELECT lower(word), NULL, boost FROM {boo}) u GROUP BY phrase)""",
    ]


def token_ctes(src: str, key: str, text: str) -> list[str]:
    """CTEs sv_tok (k, pos, w, n) and sv_doc (k, n, capdiff, but, punct)."""
    return [
        f"sv_arr AS MATERIALIZED (SELECT {key} AS k, {tokens_sql(text)} AS W, {punct_sql(text)} AS punct FROM {src})",
        "sv_tok AS MATERIALIZED (SELECT k, unnest(W) AS w, unnest(range(len(W))) AS pos, len(W) AS n FROM sv_arr)",
        f"""sv_doc AS MATERIALIZED (SELECT a.k, len(a.W) AS n, a.punct,
  (len(a.W) - len(list_filter(a.W, lambda x: {_is_upper('x')}))) > 0
    AND (len(a.W) - len(list_filter(a.W, lambda x: {_is_upper('x')}))) < len(a.W) AS capdiff,
  coalesce(list_position(list_transform(a.W, lambda x: lower(x)), 'but'), 0) - 1 AS but
  FROM sv_arr a)""",
    ]


def valence_ctes(rules=ALL_RULES) -> list[str]:
    """CTEs over sv_tok/sv_doc ending in sv_val (k, pos, token, v)."""
    rules = frozenset(rules)
    ctes = [
        """sv_win AS (SELECT k, pos, n, w, lower(w) AS lw,
  lag(lower(w), 1) OVER d AS lm1, lag(lower(w), 2) OVER d AS lm2, lag(lower(w), 3) OVER d AS lm3,
  lead(lower(w), 1) OVER d AS lp1, lead(lower(w), 2) OVER d AS lp2,
  lag(w, 1) OVER d AS wm1, lag(w, 2) OVER d AS wm2, lag(w, 3) OVER d AS wm3
  FROM sv_tok WINDOW d AS (PARTITION BY k ORDER BY pos))""",
    ]
    kind = "AND NOT (h.lw = 'kind' AND coalesce(h.lp1 = 'of', false))" if "kind_of" in rules else ""
    word = {-3: "h.lm3", -2: "h.lm2", -1: "h.lm1", 0: "h.lw", 1: "h.lp1", 2: "h.lp2"}
    back, forward, boosting = ((-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)), ((0, 1), (0, 2)), ((-3, -1), (-3, -2), (-2, -1))

    def name(span):
        return f"from{span[0] + 3}to{span[1] + 3}"
    grams = {name(x): " || ' ' || ".join(word[k] for k in range(x[0], x[1] + 1)) for x in (*back, *forward)}
    gsel, gjoin = "", ""
    if "idioms" in rules:
        for g, e in grams.items():
            gsel += f", g_{g}.special AS {g}_sp, g_{g}.pboost AS {g}_pb"
            gjoin += f" LEFT JOIN phr g_{g} ON g_{g}.phrase = ({e})"
    ctes.append(f"""sv_hit AS MATERIALIZED (SELECT h.*, d.capdiff, d.but, lx.valence AS base,
  m1.valence IS NOT NULL AS m1lex, m1.boost AS m1b, coalesce(m1.neg, false) OR coalesce(contains(h.lm1, 'n''t'), false) AS m1neg,
  m2.valence IS NOT NULL AS m2lex, m2.boost AS m2b, coalesce(m2.neg, false) OR coalesce(contains(h.lm2, 'n''t'), false) AS m2neg,
  m3.valence IS NOT NULL AS m3lex, m3.boost AS m3b, coalesce(m3.neg, false) OR coalesce(contains(h.lm3, 'n''t'), false) AS m3neg,
  p1.valence IS NOT NULL AS p1lex{gsel}
  FROM sv_win h JOIN sv_doc d ON d.k = h.k
  JOIN vocab lx ON lx.word = h.lw AND lx.valence IS NOT NULL AND lx.boost IS NULL
  LEFT JOIN vocab m1 ON m1.word = h.lm1 LEFT JOIN vocab m2 ON m2.word = h.lm2
  LEFT JOIN vocab m3 ON m3.word = h.lm3 LEFT JOIN vocab p1 ON p1.word = h.lp1{gjoin}
  WHERE true {kind})""")

    def iseq(c, v):
        return f"coalesce({c} = '{v}', false)"

    def isin(c, *vs):
        return f"coalesce({c} IN ({', '.join(repr(v) for v in vs)}), false)"

    v = "base"
    if "no" in rules:
        v = f"CASE WHEN lw = 'no' AND pos <> n - 1 AND p1lex THEN 0.0 ELSE base END"
        noprev = f"({iseq('lm1', 'no')} OR {iseq('lm2', 'no')} OR ({iseq('lm3', 'no')} AND {isin('lm1', 'or', 'nor')}))"
        v = f"CASE WHEN {noprev} THEN base * {N_SCALAR} ELSE {v} END"
    steps = [("v0", v)]
    if "caps" in rules:
        steps.append(("v0c", f"CASE WHEN {_is_upper('w')} AND capdiff THEN "
                              f"(CASE WHEN v0 > 0 THEN v0 + {C_INCR} ELSE v0 - {C_INCR} END) ELSE v0 END"))
    prev = steps[-1][0]
    for k in (1, 2, 3):
        cond = f"(pos >= {k} AND NOT m{k}lex)"
        nv = prev
        if "boosters" in rules:
            s = f"(CASE WHEN {prev} < 0 THEN -m{k}b ELSE m{k}b END)"
            if "caps" in rules:
                s += (f" + (CASE WHEN {_is_upper(f'wm{k}')} AND capdiff THEN "
                      f"(CASE WHEN {prev} > 0 THEN {C_INCR} ELSE -{C_INCR} END) ELSE 0.0 END)")
            s = f"(CASE WHEN m{k}b IS NOT NULL THEN ({s}) * {DAMP[k]} ELSE 0.0 END)"
            nv = f"{prev} + {s}"
        steps.append((f"s{k}", f"CASE WHEN {cond} THEN {nv} ELSE {prev} END"))
        prev = f"s{k}"
        if "negation" in rules:
            if k == 1:
                ne = f"CASE WHEN m1neg THEN {prev} * {N_SCALAR} ELSE {prev} END"
            elif k == 2:
                ne = (f"CASE WHEN {iseq('lm2', 'never')} AND {isin('lm1', 'so', 'this')} THEN {prev} * {NEVER_SO} "
                      f"WHEN {iseq('lm2', 'without')} AND {iseq('lm1', 'doubt')} THEN {prev} "
                      f"WHEN m2neg THEN {prev} * {N_SCALAR} ELSE {prev} END")
            else:
                ne = (f"CASE WHEN ({iseq('lm3', 'never')} AND {isin('lm2', 'so', 'this')}) OR {isin('lm1', 'so', 'this')} "
                      f"THEN {prev} * {NEVER_SO} "
                      f"WHEN {iseq('lm3', 'without')} AND ({iseq('lm2', 'doubt')} OR {iseq('lm1', 'doubt')}) THEN {prev} "
                      f"WHEN m3neg THEN {prev} * {N_SCALAR} ELSE {prev} END")
            steps.append((f"n{k}", f"CASE WHEN {cond} THEN {ne} ELSE {prev} END"))
            prev = f"n{k}"
        if k == 3 and "idioms" in rules:
            sp = "coalesce(" + ", ".join(f"{name(x)}_sp" for x in back) + ")"
            iv = f"CASE WHEN {sp} IS NOT NULL THEN {sp} ELSE {prev} END"
            for x in forward:
                iv = f"CASE WHEN {name(x)}_sp IS NOT NULL THEN {name(x)}_sp ELSE {iv} END"
            iv = f"({iv})" + "".join(f" + coalesce({name(x)}_pb, 0.0)" for x in boosting)
            steps.append(("i3", f"CASE WHEN {cond} THEN {iv} ELSE {prev} END"))
            prev = "i3"
    if "least" in rules:
        lc = f"(pos > 0 AND NOT m1lex AND {iseq('lm1', 'least')})"
        steps.append(("lst", f"CASE WHEN {lc} AND pos > 1 AND {isin('lm2', 'at', 'very')} THEN {prev} "
                             f"WHEN {lc} THEN {prev} * {N_SCALAR} ELSE {prev} END"))
        prev = "lst"
    if "but" in rules:
        steps.append(("bt", f"CASE WHEN but >= 0 AND pos < but THEN {prev} * {BUT_BEFORE} "
                            f"WHEN but >= 0 AND pos > but THEN {prev} * {BUT_AFTER} ELSE {prev} END"))
        prev = "bt"
    src = "sv_hit"
    for i, (name, expr) in enumerate(steps):
        ctes.append(f"sv_s{i} AS (SELECT *, {expr} AS {name} FROM {src})")
        src = f"sv_s{i}"
    ctes.append(f"sv_val AS (SELECT k, pos, lw AS token, {prev} AS v FROM {src})")
    return ctes


def score_ctes(rules=ALL_RULES) -> list[str]:
    """sv_score (k, sent_neg, sent_neu, sent_pos, sent_compound) over sv_doc."""
    rules = frozenset(rules)
    punct = "d.punct" if "punct" in rules else "0.0"
    return [
        """sv_tot AS MATERIALIZED (SELECT k, sum(v) AS ssum, sum(CASE WHEN v > 0 THEN v + 1 END) AS spos,
  sum(CASE WHEN v < 0 THEN v - 1 END) AS sneg, count(*) FILTER (WHERE v <> 0) AS nz FROM sv_val GROUP BY k)""",
        f"""sv_f AS (SELECT d.k, d.n, {punct} AS punct, coalesce(t.ssum, 0.0) AS s, coalesce(t.spos, 0.0) AS p,
  coalesce(t.sneg, 0.0) AS ng, CAST(d.n - coalesce(t.nz, 0) AS DOUBLE) AS neu
  FROM sv_doc d LEFT JOIN sv_tot t ON t.k = d.k)""",
        """sv_g AS (SELECT *, CASE WHEN s > 0 THEN s + punct WHEN s < 0 THEN s - punct ELSE s END AS s2,
  CASE WHEN p > abs(ng) THEN p + punct ELSE p END AS p2,
  CASE WHEN p < abs(ng) THEN ng - punct ELSE ng END AS ng2 FROM sv_f)""",
        f"""sv_score AS (SELECT k,
  CASE WHEN n = 0 THEN 0.0 ELSE {R('abs(ng2 / (p2 + abs(ng2) + neu))', 3)} END AS sent_neg,
  CASE WHEN n = 0 THEN 1.0 ELSE {R('abs(neu / (p2 + abs(ng2) + neu))', 3)} END AS sent_neu,
  CASE WHEN n = 0 THEN 0.0 ELSE {R('abs(p2 / (p2 + abs(ng2) + neu))', 3)} END AS sent_pos,
  CASE WHEN n = 0 THEN 0.0 ELSE {R(f'least(greatest(s2 / sqrt(s2 * s2 + {ALPHA}), -1.0), 1.0)', 4)} END AS sent_compound
  FROM sv_g)""",
    ]


def sentiment_ctes(src: str, key: str, text: str, lexicon, boosters, negations, idioms,
                   rules=ALL_RULES) -> list[str]:
    return (lookup_ctes(lexicon, boosters, negations, idioms) + token_ctes(src, key, text)
            + valence_ctes(rules) + score_ctes(rules))


def label_sql(c: str) -> str:
    return f"CASE WHEN {c} >= 0.05 THEN 'Positive' WHEN {c} <= -0.05 THEN 'Negative' ELSE 'Neutral' END"


def band_sql(c: str) -> str:
    return (f"CASE WHEN {c} <= -0.6 THEN 'Very Negative' WHEN {c} <= -0.05 THEN 'Negative' "
            f"WHEN {c} < 0.05 THEN 'Neutral' WHEN {c} < 0.6 THEN 'Positive' ELSE 'Very Positive' END")
