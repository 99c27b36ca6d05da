"""Sentiment queries over `documents` (whole texts), one per rule plus the full score."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import sentiment as S
from ..sources import fixtures as fx
from .registry import query
from .sql_sentiment import (band_sql, label_sql, lookup_ctes, sentiment_ctes,
                            token_ctes)
from .sql_views import R, with_

LEX = (fx.FIXTURE_LEXICON, fx.FIXTURE_BOOSTERS, fx.FIXTURE_NEGATIONS, fx.FIXTURE_IDIOMS)
# The invented prose hardly ever has the English rule words, so each text ends with one phrase that has: by doc_id
PHRASES = ("least rewh", "at least orre", "orre but thatin", "never so orre", "without doubt rewh", "kind of ha",
           "no ed", "the rewh", "VERY ORRE ly THATIN", "very least hehely")
DOCS = ("sv_src AS (SELECT doc_id, text || ' ' || CASE doc_id % 10 "
        + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PHRASES)) + " END AS text FROM documents)")


def _text():
    phrase = F.element_at(F.array(*[F.lit(p) for p in PHRASES]), (F.col("doc_id") % 10 + 1).cast("int"))
    return F.concat("text", F.lit(" "), phrase).alias("text")


def _docs(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", _text())


def _score_sql(rules) -> str:
    return (with_(DOCS, *sentiment_ctes("sv_src", "doc_id", "text", *LEX, rules=rules))
            + "SELECT k AS doc_id, sent_neg, sent_neu, sent_pos, sent_compound FROM sv_score")


def _score(spark, sf, rules):
    return S.score_sentiment(_docs(spark, sf), "doc_id", "text", rules=rules,
                             **fx.fixture_lexicons(spark))


@query("vader_tokens", with_(DOCS, *token_ctes("sv_src", "doc_id", "text"))
       + "SELECT k AS doc_id, pos, w AS token FROM sv_tok")
def q_vader_tokens(spark, sf):
    """Whitespace tokens with edge punctuation stripped, positioned."""
    return S.vader_tokens(_docs(spark, sf), "doc_id", "text")


@query("vader_punct", with_(DOCS, *token_ctes("sv_src", "doc_id", "text"))
       + f"SELECT k AS doc_id, {R('punct', 3)} AS punct FROM sv_doc")
def q_vader_punct(spark, sf):
    """Exclamation / question-mark amplifier per text."""
    d = _docs(spark, sf)
    return d.select("doc_id", rnd(S.punct_amplifier(F.col("text")), 3).alias("punct"))


_RULE_QUERIES = {
    "vader_lexicon": ({"kind_of"}, "Base lexicon valence only (boosters and 'kind of' score 0)."),
    "vader_caps": ({"kind_of", "caps"}, "Lexicon + caps emphasis."),
    "vader_no": ({"kind_of", "no"}, "Lexicon + the 'no' rules."),
    "vader_boosters": ({"kind_of", "boosters"}, "Lexicon + booster words 1-3 back."),
    "vader_negation": ({"kind_of", "negation"}, "Lexicon + negation 1-3 back, never so/this, without doubt."),
    "vader_least": ({"kind_of", "least"}, "Lexicon + 'least' rule."),
    "vader_idioms": ({"kind_of", "idioms"}, "Lexicon + idioms and booster n-grams."),
    "vader_but": ({"kind_of", "but"}, "Lexicon + 'but' re-weighting."),
    "vader_score": (set(S.ALL_RULES), "All rules: compound and pos/neu/neg shares."),
}


def _make(name, rules, doc):
    def fn(spark, sf):
        return _score(spark, sf, rules)
    fn.__doc__ = doc
    fn.__name__ = f"q_{name}"
    query(name, _score_sql(rules))(fn)


for _n, (_r, _d) in _RULE_QUERIES.items():
    _make(_n, frozenset(_r), _d)


@query("sentiment_enrich", with_(DOCS, *sentiment_ctes("sv_src", "doc_id", "text", *LEX)) + f"""
SELECT d.doc_id, d.lang, s.sent_neg, s.sent_neu, s.sent_pos, s.sent_compound,
       {label_sql('s.sent_compound')} AS sentiment_label, {band_sql('s.sent_compound')} AS sentiment_band,
       CAST(s.sent_compound <= -0.2 AS INTEGER) AS is_negative
FROM documents d JOIN sv_score s ON s.k = d.doc_id""")
def q_sentiment_enrich(spark, sf):
    """Sentiment scores, label, band and negative flag attached to every document."""
    d = fx.table(spark, sf, "documents").select("doc_id", "lang", _text())
    return S.enrich(d, "text", key="doc_id", **fx.fixture_lexicons(spark)).drop("text")


@query("sentiment_label", with_(DOCS, *sentiment_ctes("sv_src", "doc_id", "text", *LEX)) + f"""
SELECT {label_sql('sent_compound')} AS sentiment_label, count(*) AS n FROM sv_score GROUP BY 1""")
def q_sentiment_label(spark, sf):
    """Documents per sentiment label (>= 0.05 Positive, <= -0.05 Negative)."""
    from ..functions.labels import sentiment_label
    s = _score(spark, sf, S.ALL_RULES)
    return s.groupBy(sentiment_label("sent_compound").alias("sentiment_label")).agg(F.count(F.lit(1)).alias("n"))


@query("sentiment_band", with_(DOCS, *sentiment_ctes("sv_src", "doc_id", "text", *LEX)) + f"""
SELECT {band_sql('sent_compound')} AS sentiment_band, count(*) AS n FROM sv_score GROUP BY 1""")
def q_sentiment_band(spark, sf):
    """Documents per five-way sentiment band."""
    from ..functions.labels import sentiment_band
    s = _score(spark, sf, S.ALL_RULES)
    return s.groupBy(sentiment_band("sent_compound").alias("sentiment_band")).agg(F.count(F.lit(1)).alias("n"))


@query("join_lexicon", with_(DOCS, *lookup_ctes(*LEX), *token_ctes("sv_src", "doc_id", "text")) + f"""
SELECT t.k AS doc_id, count(*) AS lexicon_hits, {R('sum(v.valence)', 6)} AS valence_sum
FROM sv_tok t JOIN vocab v ON v.word = lower(t.w) AND v.valence IS NOT NULL GROUP BY t.k""")
def q_join_lexicon(spark, sf):
    """Token -> valence lookup (broadcast join) summed per document."""
    toks = S.vader_tokens(_docs(spark, sf), "doc_id", "text")
    lex = fx.fixture_lexicons(spark)["lexicon"].select(F.lower("word").alias("word"), "valence")
    lex = lex.groupBy("word").agg(F.max("valence").alias("valence"))
    j = toks.join(F.broadcast(lex), F.lower("token") == F.col("word"))
    return j.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lexicon_hits"),
                                   rnd(F.sum("valence"), 6).alias("valence_sum"))
