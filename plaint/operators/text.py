"""Text features in long form: (doc, term) rows, vocabulary, TF-IDF, linear
scores and per-document term explanations.

Everything is a shuffle-based relational job: explode terms (narrow), count
(doc, term) with partial aggregation, document frequency per term, vocabulary
top-k, and broadcast joins of the bounded vocabulary back to the long table.
The vocabulary is at most ``max_features`` rows, so broadcasting it is bounded;
coefficient tables of callers are joined without a hint."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# --- fixed values: English stop words removed before n-grams ------------------
STOP_WORDS = sorted("""
a about above across after afterwards again against all almost alone along already also
although always am among amongst amoungst amount an and another any anyhow anyone anything
anyway anywhere are around as at back be became because become becomes becoming been before
beforehand behind being below beside besides between beyond bill both bottom but by call can
cannot cant co con could couldnt cry de describe detail do done down due during each eg eight
either eleven else elsewhere empty enough etc even ever every everyone everything everywhere
except few fifteen fifty fill find fire first five for former formerly forty found four from
front full further get give go had has hasnt have he hence her here hereafter hereby herein
hereupon hers herself him himself his how however hundred i ie if in inc indeed interest into
is it its itself keep last latter latterly least less ltd made many may me meanwhile might
mill mine more moreover most mostly move much must my myself name namely neither never
nevertheless next nine no nobody none noone nor not nothing now nowhere of off often on once
one only onto or other others otherwise our ours ourselves out over own part per perhaps
please put rather re same see seem seemed seeming seems serious several she should show side
since sincere six sixty so some somehow someone something sometime sometimes somewhere still
such system take ten than that the their them themselves then thence there thereafter thereby
therefore therein thereupon these they thick thin third this those though three through
throughout thru thus to together too top toward towards twelve twenty two un under until up
upon us very via was we well were what whatever when whence whenever where whereafter whereas
whereby wherein whereupon wherever whether which while whither who whoever whole whom whose
why will with within without would yet you your yours yourself yourselves
""".split())

# runs of two or more word characters: ASCII for the browser-side scorer, Unicode for training
ASCII_TERMS = r"([a-z0-9_]{2,})"
UNICODE_TERMS = r"([\p{L}\p{N}_]{2,})"


def tokenize_terms(df: DataFrame, key: str, text_col: str, ngram: int = 2, pattern: str = ASCII_TERMS) -> DataFrame:
    """(key, term) rows: lower-case runs of >= 2 word characters, stop words
    removed before n-grams, unigrams and bigrams in one pass over the texts."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(pattern), 1)
    d = df.select(key, F.filter(runs, lambda t: ~t.isin(*STOP_WORDS)).alias("_t"))
    if ngram < 2:
        return d.select(key, F.explode("_t").alias("term"))
    n = F.size("_t")
    pairs = F.zip_with(F.slice("_t", 1, F.greatest(n - 1, F.lit(0))), F.slice("_t", 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, b))
    return d.select(key, F.explode(F.concat("_t", pairs)).alias("term"))


def term_counts(terms: DataFrame, key: str) -> DataFrame:
    """(key, term, tf) -- partial aggregation happens before the shuffle."""
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, key: str, min_df: int = 5, max_features: int = 5000) -> DataFrame:
    """Terms with document frequency >= min_df, top max_features by total count
    (ties by term); with idf = ln((1 + n_docs) / (1 + df)) + 1.

    n_docs is the number of distinct documents with at least one term plus
    none other -- passed in through ``n_docs`` when documents without terms count."""
    g = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    g = g.filter(F.col("df") >= min_df)
    top = g.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    return top


def with_idf(vocab: DataFrame, n_docs: Column) -> DataFrame:
    return vocab.withColumn("idf", F.log((1 + n_docs) / (1 + F.col("df"))) + 1)


def tfidf(counts: DataFrame, vocab: DataFrame, key: str) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * idf, L2-normalized per document.

    ``vocab`` comes out of ``vocabulary`` (at most ``max_features`` rows), so it
    is broadcast."""
    v = F.broadcast(vocab.select("term", "idf"))
    w = counts.join(v, "term").withColumn("_w", (1 + F.log(F.col("tf"))) * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("_w") / norm).alias("weight"))


def score_linear_terms(weights: DataFrame, coef: DataFrame, key: str, intercept: float,
                       documents: DataFrame) -> DataFrame:
    """sigmoid(intercept + sum coef * weight) for every row of ``documents``
    (column ``key``); one without a known term gets sigmoid(intercept), matched 0."""
    j = weights.join(coef.select("term", "coef"), "term")
    g = j.groupBy(key).agg(F.sum(F.col("coef") * F.col("weight")).alias("_z"),
                           F.count(F.lit(1)).alias("_m"))
    every = documents.select(key).join(g, key, "left")
    z = F.lit(intercept) + F.coalesce("_z", F.lit(0.0))
    return every.select(key, F.coalesce("_m", F.lit(0)).alias("matched"), (1 / (1 + F.exp(-z))).alias("prob"))


def explain_terms(weights: DataFrame, coef: DataFrame, key: str, k: int = 6) -> DataFrame:
    """Top k positive and top k negative term contributions per document."""
    j = weights.join(coef.select("term", "coef"), "term") \
               .withColumn("contribution", F.col("coef") * F.col("weight")).filter(F.col("contribution") != 0)
    j = j.withColumn("direction", F.when(F.col("contribution") > 0, "up").otherwise("down"))
    w = Window.partitionBy(key, "direction").orderBy(F.abs("contribution").desc(), "term")
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
            .select(key, "direction", "rank", "term", "contribution")


def ordinal_levels(df: DataFrame, col: str) -> DataFrame:
    """(level, code): the fitted alphabetical 0-based codes of a column's values."""
    from .ranking import global_row_number
    levels = df.select(F.col(col).alias("level")).distinct().filter(F.col("level").isNotNull())
    return global_row_number(levels, [F.col("level").asc()], "code").select("level", (F.col("code") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, col: str, out: str | None = None, levels: DataFrame | None = None) -> DataFrame:
    """Alphabetical ordinal code (0-based) of a categorical column; a value that
    is null or not among the fitted ``levels`` (default: fitted on ``df``) gets -1."""
    fitted = ordinal_levels(df, col) if levels is None else levels
    coded = df.join(fitted.select(F.col("level").alias("_level"), F.col("code").alias("_code")), F.col(col) == F.col("_level"), "left")
    return coded.withColumn(out or f"{col}_code", F.coalesce("_code", F.lit(-1))).drop("_level", "_code")


def rare_levels(df: DataFrame, col: str, min_count: int = 25) -> DataFrame:
    """Levels with fewer than ``min_count`` rows (null is a level), counted map-side first."""
    return df.groupBy(F.col(col).alias("_rare")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < min_count).select("_rare")


def rare_pool(df: DataFrame, col: str, min_count: int = 25, rare: str = "__rare__") -> DataFrame:
    """Categories with fewer than ``min_count`` rows pooled into one level.

    Only rare levels are joined back, so frequent (hot) levels meet no partner;
    Spark broadcasts the list where its measured size allows."""
    few = rare_levels(df, col, min_count).withColumn("_is", F.lit(True))
    j = df.join(few, F.col(col).eqNullSafe(F.col("_rare")), "left")
    return j.withColumn(col, F.when(F.col("_is"), F.lit(rare)).otherwise(F.col(col))).drop("_rare", "_is")
