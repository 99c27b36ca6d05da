"""Text-feature queries over `documents` (whole texts): terms, vocabulary,
TF-IDF, linear scoring and explanations.

The coefficient table used by ``score_linear_terms`` / ``explain_terms`` is a
stand-in for a fitted model's weights, derived from each term's characters
(the fitted path is ``train_text_model``)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..operators import terms as G
from ..operators import text as T
from ..sources import fixtures as fx
from .registry import query
from .sql_views import R, with_

KEY = "doc_id"
INTERCEPT = -0.5
_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"

_TERMS = f"""tt AS MATERIALIZED (SELECT doc_id, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]{{2,}}'),
                                       lambda w: NOT list_contains({_STOP}, w)) AS t FROM documents),
terms AS MATERIALIZED (SELECT doc_id, unnest(t) AS term, 'uni' AS kind FROM tt
          UNION ALL
          SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term, 'bi' AS kind FROM tt),
counts AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY 1, 2),
ndocs AS (SELECT count(*) AS n FROM documents),
vocab AS MATERIALIZED (SELECT term, df, total, ln((1 + (SELECT n FROM ndocs)) / (1 + df)) + 1 AS idf FROM (
          SELECT term, count(*) AS df, sum(tf) AS total FROM counts GROUP BY term) g
          WHERE df >= 5 ORDER BY total DESC, term LIMIT 5000),
weights AS MATERIALIZED (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
          SELECT c.doc_id, c.term, (1 + ln(c.tf)) * v.idf AS w FROM counts c JOIN vocab v ON v.term = c.term) x),
coef AS (SELECT term, ((length(term) % 5) - 2) * 0.25 + (CASE WHEN contains(term, ' ') THEN 0.1 ELSE 0.0 END) AS coef FROM vocab)
"""
_W = with_(_TERMS)


def _docs(spark, sf):
    return fx.table(spark, sf, "documents").select(KEY, "text")


def _one_row_a_key(docs):
    return docs.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).isEmpty()


def _vocab(docs):
    """(term, df, total, idf) of the vocabulary; all rows of a key are one document."""
    words = docs.select(KEY, G.words("text", T.ASCII_TERMS).alias("words"))
    top = G.top_terms(words, "words", 5, 5000, None if _one_row_a_key(docs) else KEY)
    vocab = docs.sparkSession.createDataFrame([tuple(r) for r in top], "term string, df long, total long")
    return T.with_idf(vocab, F.lit(docs.count()))


def _coef(vocab):
    c = ((F.length("term") % 5) - 2) * 0.25 + F.when(F.col("term").contains(" "), 0.1).otherwise(0.0)
    return F.broadcast(vocab.select("term", c.alias("coef")))  # a row a term of the vocabulary


def _weights(spark, sf):
    """(doc, term, weight) and the vocabulary. Weights are worked out within a row; the counts of a key's rows are added up first."""
    docs = _docs(spark, sf)
    vocab = _vocab(docs)
    if _one_row_a_key(docs):
        words = docs.select(KEY, G.words("text", T.ASCII_TERMS).alias("words"))
        return G.text_weights(words, KEY, "words", vocab.select("term", "idf").collect()), vocab
    known = T.tokenize_terms(docs, KEY, "text").join(F.broadcast(vocab.select("term")), "term", "left_semi")
    return T.tfidf(T.term_counts(known, KEY), vocab, KEY), vocab


@query("tokenize_terms", _W + "SELECT doc_id, count(*) AS n_terms, count(DISTINCT term) AS n_distinct FROM terms GROUP BY 1")
def q_tokenize_terms(spark, sf):
    """Lower-case terms (>= 2 word chars), stop words removed before bigrams."""
    t = T.tokenize_terms(_docs(spark, sf), KEY, "text")
    return t.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_terms"), F.count_distinct("term").alias("n_distinct"))


@query("ngram_union", _W + "SELECT kind, count(*) AS n FROM terms GROUP BY 1")
def q_ngram_union(spark, sf):
    """Unigrams UNION ALL bigrams, counted per kind."""
    t = T.tokenize_terms(_docs(spark, sf), KEY, "text")
    kind = F.when(F.col("term").contains(" "), "bi").otherwise("uni")
    return t.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("vocabulary", _W + f"SELECT term, df, total, {R('idf', 6)} AS idf FROM vocab")
def q_vocabulary(spark, sf):
    """Terms with df >= 5, top 5000 by corpus count, with smooth idf."""
    v = _vocab(_docs(spark, sf))
    return v.select("term", "df", "total", rnd("idf", 6).alias("idf"))


@query("tfidf", _W + f"""SELECT doc_id, count(*) AS n_terms, {R('sum(weight)', 6)} AS weight_sum,
       {R('max(weight)', 6)} AS weight_max FROM weights GROUP BY 1""")
def q_tfidf(spark, sf):
    """Sublinear tf x smooth idf, L2-normalized (summarized per document)."""
    w, _ = _weights(spark, sf)
    return w.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_terms"), rnd(F.sum("weight"), 6).alias("weight_sum"),
                              rnd(F.max("weight"), 6).alias("weight_max"))


@query("score_linear_terms", _W + f"""SELECT d.doc_id, coalesce(matched, 0) AS matched,
       {R(f'1 / (1 + exp(-({INTERCEPT} + coalesce(z, 0))))', 6)} AS prob
FROM documents d LEFT JOIN (SELECT w.doc_id, count(*) AS matched, sum(c.coef * w.weight) AS z
     FROM weights w JOIN coef c ON c.term = w.term GROUP BY 1) s ON s.doc_id = d.doc_id""")
def q_score_linear_terms(spark, sf):
    """sigmoid(intercept + sum coef x tfidf) for every document."""
    w, vocab = _weights(spark, sf)
    s = T.score_linear_terms(w, _coef(vocab), KEY, INTERCEPT, _docs(spark, sf))
    return s.select(KEY, "matched", rnd("prob", 6).alias("prob"))


@query("join_coefficients", _W + f"""SELECT w.term, count(*) AS docs, {R('max(c.coef)', 6)} AS coef
FROM weights w JOIN coef c ON c.term = w.term GROUP BY 1""")
def q_join_coefficients(spark, sf):
    """term -> coefficient lookup joined to the weights."""
    w, vocab = _weights(spark, sf)
    j = w.join(_coef(vocab), "term")
    return j.groupBy("term").agg(F.count(F.lit(1)).alias("docs"), rnd(F.max("coef"), 6).alias("coef"))


@query("explain_terms", _W + f"""SELECT doc_id, direction, rank, term, {R('contribution', 6)} AS contribution FROM (
  SELECT w.doc_id, w.term, c.coef * w.weight AS contribution,
         CASE WHEN c.coef * w.weight > 0 THEN 'up' ELSE 'down' END AS direction,
         CASE WHEN c.coef * w.weight > 0
              THEN row_number() OVER (PARTITION BY w.doc_id, c.coef * w.weight > 0 ORDER BY c.coef * w.weight DESC, w.term)
              ELSE row_number() OVER (PARTITION BY w.doc_id, c.coef * w.weight > 0 ORDER BY c.coef * w.weight ASC, w.term) END AS rank
  FROM weights w JOIN coef c ON c.term = w.term WHERE c.coef * w.weight <> 0) x WHERE rank <= 6""")
def q_explain_terms(spark, sf):
    """Top 6 positive and 6 negative term contributions per document."""
    w, vocab = _weights(spark, sf)
    e = T.explain_terms(w, _coef(vocab), KEY, 6)
    return e.withColumn("contribution", rnd("contribution", 6))


@query("model_export_table", _W + f"SELECT term, {R('idf', 5)} AS idf, {R('coef', 5)} AS coef FROM vocab JOIN coef USING (term)")
def q_model_export_table(spark, sf):
    """(term, idf, coef) table at 5 dp."""
    vocab = _vocab(_docs(spark, sf))
    j = vocab.join(_coef(vocab), "term")
    return j.select("term", rnd("idf", 5).alias("idf"), rnd("coef", 5).alias("coef"))
