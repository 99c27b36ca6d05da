"""Lexicon + rule sentiment (VADER rules) as a relational Spark job.

Plan per text:
1. one pass in Arrow batches splits a text on white space, strips its tokens of edge
   punctuation, counts them and tells the caps-emphasis gate, the position of the first
   "but" and the marks that amplify; tokens that may be in the lexicon leave with their
   neighbour words (i-3..i+2), and a row without words stands for the text itself.
2. a broadcast join with the lexicon keeps the scoring ones.
3. left broadcast joins look the neighbours up (lexicon / booster /
   negation), and the idiom phrases.
4. the VADER rules are chained column expressions over those lookups.
5. ``groupBy(key)`` sums (partial aggregation happens in the exploding task),
   and the per-text totals are joined back to every row (null-safe key).

Lookup tables are inputs (``lexicon_frames``); they are small and fixed in size,
so broadcasting them is bounded. ``rules`` switches single rules on/off so each
rule can be checked in isolation.
"""
from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels
from ..functions.numeric import rnd
from ..session import landed

# --- fixed values: VADER constants -----------------------------------------
B_INCR = 0.293
B_DECR = -0.293
C_INCR = 0.733
N_SCALAR = -0.74
ALPHA = 15.0
EXCLAIM_STEP, EXCLAIM_MAX = 0.292, 4
QUESTION_STEP, QUESTION_CAP = 0.18, 0.96
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
NEVER_SO = 1.25
DAMP = {1: 1.0, 2: 0.95, 3: 0.9}

ALL_RULES = frozenset({"caps", "no", "boosters", "negation", "least", "idioms",
                       "but", "punct", "kind_of"})

# A whitespace-delimited token loses its edge punctuation when at least three characters remain.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# a token with an upper-case letter and no lower-case letter; any other token; "but" with or without edge punctuation
CAPS_TOKEN_RE = r"(?:^|\s)[^\s\p{Ll}]*\p{Lu}[^\s\p{Ll}]*+(?!\S)"
OTHER_TOKEN_RE = r"(?:^|\s)(?:\S*\p{Ll}|[^\s\p{Lu}]++(?!\S))"
BUT_RE = r"(?i)(?:^|\s)\p{Punct}*but\p{Punct}*(?!\S)"


def _literal_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """Small fixed table as a JVM-local relation (no Python workers at run time)."""
    rows = list(rows)
    names = [f.split()[0] for f in schema.split(",")]
    types = [f.split()[1] for f in schema.split(",")]
    if not rows:
        return spark.createDataFrame([], schema)

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if t == "boolean":
            return "true" if v else "false"
        if t == "string":
            return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"CAST({float(v)!r} AS DOUBLE)"
    body = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(names)})")


def lexicon_frames(spark: SparkSession, lexicon, boosters, negations, idioms) -> dict[str, DataFrame]:
    """Build the four lookup DataFrames from (word, value) lists."""
    return {
        "lexicon": _literal_frame(spark, lexicon, "word string, valence double"),
        "boosters": _literal_frame(spark, boosters, "word string, boost double"),
        "negations": _literal_frame(spark, [(w,) for w in negations], "word string"),
        "idioms": _literal_frame(spark, idioms, "phrase string, special double"),
    }


def _raw_tokens(text: Column) -> Column:
    """Whitespace-delimited tokens as they stand."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def _core(token: Column) -> Column:
    """The token without edge punctuation, unless <= 2 chars remain."""
    inner = F.btrim(token, F.lit(PUNCTUATION))
    return F.when(F.length(inner) >= 3, inner).otherwise(token)


def punct_amplifier(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    ex = F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))
    qm = F.length(t) - F.length(F.replace(t, F.lit("?"), F.lit("")))
    return _amplifier(ex, qm)


def _amplifier(ex: Column, qm: Column) -> Column:
    ep = F.least(ex, F.lit(EXCLAIM_MAX)) * EXCLAIM_STEP
    qp = F.when(qm > 1, F.when(qm <= 3, qm * QUESTION_STEP).otherwise(QUESTION_CAP)).otherwise(0.0)
    return ep + qp


def text_features(df: DataFrame, text_col: str) -> DataFrame:
    """Row-level features: token count, caps gate (some tokens in capitals, but not all), position of the
    first 'but' (-1 without). Edge punctuation has no case, so the gate reads the text as it stands."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = F.array_position(F.transform(_raw_tokens(text), lambda t: F.lower(_core(t))), "but") - 1
    return df.withColumns({
        "_n": F.size(_raw_tokens(text)),
        "_capdiff": text.rlike(CAPS_TOKEN_RE) & text.rlike(OTHER_TOKEN_RE),
        "_but": F.when(text.rlike(BUT_RE), place).otherwise(F.lit(-1).cast("long")),
    })


def vader_tokens(df: DataFrame, key: str, text_col: str) -> DataFrame:
    """(key, pos, token) for every token of every text."""
    toks = df.select(key, F.posexplode(_raw_tokens(F.col(text_col))).alias("pos", "_t"))
    return toks.select(key, "pos", _core(F.col("_t")).alias("token"))


def _vocab(lexicon: DataFrame, boosters: DataFrame, negations: DataFrame) -> DataFrame:
    """word -> (valence, boost, neg): one union + aggregate, no joins."""
    nd, nb = F.lit(None).cast("double"), F.lit(None).cast("boolean")
    u = (lexicon.select(F.lower("word").alias("word"), F.col("valence"), nd.alias("boost"), nb.alias("neg"))
         .unionByName(boosters.select(F.lower("word").alias("word"), nd.alias("valence"), F.col("boost"), nb.alias("neg")))
         .unionByName(negations.select(F.lower("word").alias("word"), nd.alias("valence"), nd.alias("boost"),
                                       F.lit(True).alias("neg"))))
    return u.groupBy("word").agg(F.max("valence").alias("valence"), F.max("boost").alias("boost"),
                                 F.max("neg").alias("neg"))


def _phrases(idioms: DataFrame, boosters: DataFrame) -> DataFrame:
    nd = F.lit(None).cast("double")
    u = (idioms.select(F.lower("phrase").alias("phrase"), F.col("special"), nd.alias("pboost"))
         .unionByName(boosters.select(F.lower("word").alias("phrase"), nd.alias("special"),
                                      F.col("boost").alias("pboost"))))
    return u.groupBy("phrase").agg(F.max("special").alias("special"), F.max("pboost").alias("pboost"))


# Word spans around a scoring word (0), from the first to the last offset: those whose idiom
# value replaces the word's (in order of precedence), those that reach behind it, and those that boost.
BACK_PHRASES = ((-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2))
FORWARD_PHRASES = ((0, 1), (0, 2))
BOOST_PHRASES = ((-3, -1), (-3, -2), (-2, -1))


def offset_name(k: int) -> str:
    """The lower-cased word ``k`` places behind (negative) or after the scoring word."""
    return "lw" if k == 0 else f"lm{-k}" if k < 0 else f"lp{k}"


def phrase_name(first: int, last: int) -> str:
    return f"from{first + 3}to{last + 3}"


def _joined(words: list[Column]) -> Column:
    """The words with spaces between; null if one is missing."""
    out = words[0]
    for w in words[1:]:
        out = F.concat(out, F.lit(" "), w)
    return out


MAX_LOOKUP_ROWS = 500_000  # lexicon-sized; anything larger is not a lookup table


def _bounded_local(df: DataFrame, schema: str, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """A lookup table of at most ``max_rows`` rows as one local relation with a
    broadcast hint (the row count is checked first, so what is broadcast has a
    proven bound); a larger one as it is, to be joined by a shuffle."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(_literal_frame(df.sparkSession, [tuple(r) for r in rows], schema))


def _lookup(df: DataFrame, table: DataFrame, on: Column, key: str, prefix: str, cols: list[str]) -> DataFrame:
    """Left join against one shared side (identical plans, so the exchange is
    built once and reused by every lookup)."""
    t = table.alias(prefix)
    j = df.join(t, on == F.col(f"{prefix}.{key}"), "left")
    return j.select(*[df[c] for c in df.columns],
                    *[F.col(f"{prefix}.{c}").alias(f"{prefix}_{c}") for c in cols])


#: Columns of a word and its neighbours, by offset.
NEAR = {0: "w", -1: "wm1", -2: "wm2", -3: "wm3", 1: "wp1", 2: "wp2"}


#: Tokens that a task remembers, at most.
MEMO_TOKENS = 200_000


#: What a text's only pass over its tokens tells besides: those of ``text_features`` and the counts of ``punct_amplifier``.
FEATURES = {"_n": pa.int32(), "_capdiff": pa.bool_(), "_but": pa.int64(), "_ex": pa.int32(), "_qm": pa.int32()}
#: Lower-cased words by offset, and the bits of those at 0, -1, -2 and -3 that are in capitals.
LOWER = {0: "lw", -1: "lm1", -2: "lm2", -3: "lm3", 1: "lp1", 2: "lp2"}
#: The place of the row that a text without any scoring word has, too.
NOWHERE = -1


def _candidates(df: DataFrame, text_col: str, scoring: DataFrame, features: bool = False) -> DataFrame:
    """The text in ``text_col`` replaced by one row for each word that may score: its position, itself and its neighbours (null
    beyond the ends). Only these are exploded; the join with ``scoring`` decides. A lexicon beyond the lookup limit lets every
    word through.

    With ``features`` the words are in lower case, ``caps`` tells those in capitals, the columns FEATURES are added, and each
    text has one row more, at NOWHERE and without words."""
    known = [r[0] for r in scoring.select("_word").limit(MAX_LOOKUP_ROWS + 1).collect()]
    shared = df.sparkSession.sparkContext.broadcast(frozenset(known) if len(known) <= MAX_LOOKUP_ROWS else None)
    kept = [c for c in df.columns if c != text_col]
    near = LOWER if features else NEAR
    words = [T.StructField(c, T.ArrayType(T.StringType())) for c in near.values()]
    found = T.StructType([T.StructField("pos", T.ArrayType(T.IntegerType())), *words, *([T.StructField("caps", T.ArrayType(T.IntegerType()))] if features else [])])
    told = T._parse_datatype_string("_n int, _capdiff boolean, _but long, _ex int, _qm int").fields if features else []

    def core(token: str) -> str:
        inner = token.strip(PUNCTUATION)
        return inner if len(inner) >= 3 else token

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        edges = PUNCTUATION.encode()
        # a word that may score, or a "but", is one of these when it has lost its edge punctuation, however short it is then
        short = {w.encode().strip(edges) for w in (*(known or ()), "but")}
        may: dict[bytes, int] = {}  # of a token as it stands: whether it may score (1) and whether it is a "but" (2)
        seen: dict[bytes, tuple[str, bool]] = {}  # a word as it is sent, and whether it is in capitals
        high: dict[bytes, bool] = {}

        def kind(token: bytes) -> int:
            if len(may) >= MEMO_TOKENS:
                may.clear()
            word = core(token.decode()).lower()
            got = may[token] = (known is None or word in known) + 2 * (word == "but")
            return got

        def sent(token: bytes) -> tuple[str, bool]:
            got = seen.get(token)
            if got is None:
                if len(seen) >= MEMO_TOKENS:
                    seen.clear()
                word = core(token.decode())
                low = word.lower()
                got = seen[token] = (low if features else word), word != low and word == word.upper()
            return got

        def in_caps(token: bytes) -> bool:
            got = high.get(token)
            if got is None:
                if len(high) >= MEMO_TOKENS:
                    high.clear()
                kinds = {unicodedata.category(c) for c in token.decode()}
                got = high[token] = "Lu" in kinds and "Ll" not in kinds  # as CAPS_TOKEN_RE
            return got

        for batch in batches:
            ends, places, marks, out = [0], [], [], [[] for _ in near]
            facts: list[list] = [[] for _ in FEATURES]
            for text in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist():
                text = text or b""
                tokens = text.split()  # at the six ASCII white-space characters
                low = (text.lower() if text.isascii() else text.decode().lower().encode()).split()
                n, but, at = len(tokens), -1, []
                for p in range(n) if known is None else [p for p, t in enumerate(low) if t.strip(edges) in short]:
                    t = tokens[p]
                    got = kind(t) if (got := may.get(t)) is None else got
                    if got & 1:
                        at.append(p)
                    if got & 2 and but < 0:
                        but = p
                places += at
                first = len(marks)
                marks += [0] * len(at)
                for column, k in zip(out, near):
                    for i, p in enumerate(at, first):
                        if 0 <= p + k < n:
                            word, upper = sent(tokens[p + k])
                            column.append(word)
                            if upper and k <= 0:
                                marks[i] |= 1 << -k
                        else:
                            column.append(None)
                if features:
                    # the gate matters to words in capitals alone
                    gate = False
                    if any(marks[first:]):
                        kinds = {in_caps(t) for t in set(tokens)}
                        gate = len(kinds) == 2
                    for column, x in zip(facts, (n, gate, but, text.count(b"!"), text.count(b"?"))):
                        column.append(x)
                    places.append(NOWHERE)
                    marks.append(0)
                    for column in out:
                        column.append(None)
                ends.append(len(places))
            columns = [pa.array(places, pa.int32()), *(pa.array(x, pa.string()) for x in out), *([pa.array(marks, pa.int32())] if features else [])]
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in columns]
            more = [pa.array(x, t) for x, t in zip(facts, FEATURES.values())] if features else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *more, *lists], names=[*kept, *(f.name for f in told), *found.names])

    schema = T.StructType([*df.select(*kept).schema.fields, *told, *found.fields])
    lists = df.select(*kept, text_col).mapInArrow(run, schema)
    kept += [f.name for f in told]
    return lists.select(*kept, F.explode(F.arrays_zip(*found.names)).alias("t")).select(*kept, "t.*")


def token_valences(df: DataFrame, key: str, text_col: str, lexicon: DataFrame,
                   boosters: DataFrame, negations: DataFrame, idioms: DataFrame,
                   rules=ALL_RULES) -> DataFrame:
    """One row per scoring token: (key, pos, v) with every enabled rule applied, and one per text at NOWHERE without a value;
    each with the text's number of tokens and its counts of ``!`` and ``?``."""
    rules = frozenset(rules)
    vocab = _bounded_local(_vocab(lexicon, boosters, negations),
                           "word string, valence double, boost double, neg boolean")
    scoring = vocab.filter(F.col("valence").isNotNull() & F.col("boost").isNull()) \
                   .select(F.col("word").alias("_word"), F.col("valence").alias("base"))
    toks = _candidates(df.select(key, text_col), text_col, scoring, features=True)
    hits = toks.join(scoring, F.col("lw") == F.col("_word"), "left")
    hits = hits.filter(F.col("_word").isNotNull() | (F.col("pos") == NOWHERE)).drop("_word")
    if "kind_of" in rules:
        hits = hits.filter(~(F.coalesce(F.col("lw") == "kind", F.lit(False)) & F.coalesce(F.col("lp1") == "of", F.lit(False))))

    for nb in ("lm1", "lm2", "lm3", "lp1"):
        hits = _lookup(hits, vocab, F.col(nb), "word", f"{nb}v", ["valence", "boost", "neg"])
    phrases = _bounded_local(_phrases(idioms, boosters), "phrase string, special double, pboost double")
    grams = {phrase_name(*span): _joined([F.col(offset_name(k)) for k in range(span[0], span[1] + 1)])
             for span in (*BACK_PHRASES, *FORWARD_PHRASES)}
    if "idioms" in rules:
        for g, expr in grams.items():
            hits = _lookup(hits, phrases, expr, "phrase", f"g_{g}", ["special", "pboost"])

    def inlex(nb):
        return F.col(f"{nb}v_valence").isNotNull()

    def negated(nb):
        return F.coalesce(F.col(f"{nb}v_neg"), F.lit(False)) | F.coalesce(F.col(nb).contains("n't"), F.lit(False))

    def eq(c, s):
        return F.coalesce(F.col(c) == s, F.lit(False))

    def isin(c, *s):
        return F.coalesce(F.col(c).isin(*s), F.lit(False))

    pos, n, capdiff = F.col("pos"), F.col("_n"), F.col("_capdiff")

    def upper(place):
        return F.col("caps").bitwiseAND(F.lit(1 << place)) != 0

    basev = F.col("base")
    steps: list[tuple[str, Column]] = []
    v = basev
    if "no" in rules:
        v = F.when((F.col("lw") == "no") & (pos != n - 1) & inlex("lp1"), F.lit(0.0)).otherwise(v)
        no_prev = eq("lm1", "no") | eq("lm2", "no") | (eq("lm3", "no") & isin("lm1", "or", "nor"))
        v = F.when(no_prev, basev * N_SCALAR).otherwise(v)
    steps.append(("v0", v))
    if "caps" in rules:
        steps.append(("v0", F.when(upper(0) & capdiff,
                                   F.when(F.col("v0") > 0, F.col("v0") + C_INCR)
                                   .otherwise(F.col("v0") - C_INCR)).otherwise(F.col("v0"))))
    prev = "v0"
    for k in (1, 2, 3):
        nb = f"lm{k}"
        cur = F.col(prev)
        cond = (pos >= k) & ~inlex(nb)
        newv = cur
        if "boosters" in rules:
            b = F.col(f"{nb}v_boost")
            s = F.when(cur < 0, -b).otherwise(b)
            if "caps" in rules:
                s = s + F.when(upper(k) & capdiff,
                               F.when(cur > 0, F.lit(C_INCR)).otherwise(F.lit(-C_INCR))).otherwise(0.0)
            s = F.when(b.isNotNull(), s * DAMP[k]).otherwise(0.0)
            newv = newv + s
        steps.append((f"s{k}", F.when(cond, newv).otherwise(cur)))
        cur_s = F.col(f"s{k}")
        if "negation" in rules:
            if k == 1:
                nv = F.when(negated("lm1"), cur_s * N_SCALAR).otherwise(cur_s)
            elif k == 2:
                nv = (F.when(eq("lm2", "never") & isin("lm1", "so", "this"), cur_s * NEVER_SO)
                      .when(eq("lm2", "without") & eq("lm1", "doubt"), cur_s)
                      .when(negated("lm2"), cur_s * N_SCALAR).otherwise(cur_s))
            else:
                nv = (F.when((eq("lm3", "never") & isin("lm2", "so", "this")) | isin("lm1", "so", "this"),
                             cur_s * NEVER_SO)
                      .when(eq("lm3", "without") & (eq("lm2", "doubt") | eq("lm1", "doubt")), cur_s)
                      .when(negated("lm3"), cur_s * N_SCALAR).otherwise(cur_s))
            steps.append((f"n{k}", F.when(cond, nv).otherwise(cur_s)))
            prev = f"n{k}"
        else:
            prev = f"s{k}"
        if k == 3 and "idioms" in rules:
            cur_i = F.col(prev)
            special = F.coalesce(*[F.col(f"g_{phrase_name(*x)}_special") for x in BACK_PHRASES])
            iv = F.when(special.isNotNull(), special).otherwise(cur_i)
            for x in FORWARD_PHRASES:  # the longer one wins
                iv = F.coalesce(F.col(f"g_{phrase_name(*x)}_special"), iv)
            for x in BOOST_PHRASES:
                iv = iv + F.coalesce(F.col(f"g_{phrase_name(*x)}_pboost"), F.lit(0.0))
            steps.append(("i3", F.when(cond, iv).otherwise(cur_i)))
            prev = "i3"
    if "least" in rules:
        cur = F.col(prev)
        least = (pos > 0) & ~inlex("lm1") & eq("lm1", "least")
        steps.append(("lst", F.when(least & (pos > 1) & isin("lm2", "at", "very"), cur)
                      .when(least, cur * N_SCALAR).otherwise(cur)))
        prev = "lst"
    if "but" in rules:
        cur = F.col(prev)
        b = F.col("_but")
        steps.append(("bt", F.when((b >= 0) & (pos < b), cur * BUT_BEFORE)
                      .when((b >= 0) & (pos > b), cur * BUT_AFTER).otherwise(cur)))
        prev = "bt"
    for name, expr in steps:
        hits = hits.withColumn(name, expr)
    value = F.when(pos != NOWHERE, F.col(prev))
    return hits.select(key, "pos", F.col("lw").alias("token"), value.alias("v"), "_n", "_ex", "_qm")


def doc_totals(df: DataFrame, key: str, text_col: str, lexicon: DataFrame,
               boosters: DataFrame, negations: DataFrame, idioms: DataFrame,
               rules=ALL_RULES) -> DataFrame:
    """Per text: sum, positive and negative sift sums, number of non-zero valences (partial + final aggregate),
    and what its pass over the tokens counted."""
    vals = token_valences(df, key, text_col, lexicon, boosters, negations, idioms, rules)
    return vals.groupBy(key).agg(
        F.sum("v").alias("_sum"),
        F.sum(F.when(F.col("v") > 0, F.col("v") + 1)).alias("_pos"),
        F.sum(F.when(F.col("v") < 0, F.col("v") - 1)).alias("_neg"),
        F.count_if(F.col("v") != 0).alias("_nz"),
        *[F.max(c).alias(c) for c in ("_n", "_ex", "_qm")],
    )


_TID = "_text_id"
_NEUTRAL = {"sent_neg": 0.0, "sent_neu": 1.0, "sent_pos": 0.0, "sent_compound": 0.0}


def _text_scores(texts: DataFrame, text_col: str, frames: dict, rules) -> DataFrame:
    """(_TID, four scores) for one row per distinct text."""
    rules = frozenset(rules)
    totals = doc_totals(texts, _TID, text_col, rules=rules, **frames)
    punct = _amplifier(F.col("_ex"), F.col("_qm")) if "punct" in rules else F.lit(0.0)
    return totals.withColumn("_punct", punct).select(_TID, *[c.expr.alias(c.alias_name) for c in _finish_cols()])


def _scored(df: DataFrame, text_col: str, frames: dict, rules, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row of df with its scores, each distinct text scored once.

    The rows are worked out once and written, and read back for their texts and for the result. A text is known by the
    128 bits of its digest. Copies collapse in their task before the texts are shuffled; the scores are joined back to
    the rows by digest, where a text with many rows is split by the adaptive skew join. Rows without text are neutral
    and are not shuffled."""
    blank = F.length(F.trim(F.coalesce(F.col(text_col), F.lit("")))) == 0
    kept = [c for c in keep if c not in _NEUTRAL]
    rows = landed(df.select(*dict.fromkeys([*kept, text_col]), F.when(~blank, F.md5(F.col(text_col))).alias(_TID)), "rows", "zstd")
    told = rows.filter(F.col(_TID).isNotNull())
    texts = told.groupBy(_TID).agg(F.first(text_col).alias(text_col))
    scores = _text_scores(texts, text_col, frames, rules)
    scored = told.select(*kept, _TID).join(scores, _TID, "left").drop(_TID).fillna(_NEUTRAL)
    neutral = rows.filter(F.col(_TID).isNull()).select(*kept, *[F.lit(v).alias(c) for c, v in _NEUTRAL.items()])
    return scored.unionByName(neutral)


def score_sentiment(df: DataFrame, key: str, text_col: str, lexicon: DataFrame,
                    boosters: DataFrame, negations: DataFrame, idioms: DataFrame,
                    rules=ALL_RULES) -> DataFrame:
    """(key, sent_neg, sent_neu, sent_pos, sent_compound) for every row of df; keys may repeat."""
    frames = dict(lexicon=lexicon, boosters=boosters, negations=negations, idioms=idioms)
    return _scored(df.select(key, text_col), text_col, frames, rules, [key])


class _Named:
    def __init__(self, alias_name, expr):
        self.alias_name, self.expr = alias_name, expr


def _finish_cols() -> list[_Named]:
    n, punct = F.col("_n"), F.col("_punct")
    s = F.coalesce(F.col("_sum"), F.lit(0.0))
    s2 = F.when(s > 0, s + punct).when(s < 0, s - punct).otherwise(s)
    comp = s2 / F.sqrt(s2 * s2 + F.lit(ALPHA))
    comp = F.least(F.greatest(comp, F.lit(-1.0)), F.lit(1.0))
    pos = F.coalesce(F.col("_pos"), F.lit(0.0))
    neg = F.coalesce(F.col("_neg"), F.lit(0.0))
    neu = (n - F.coalesce(F.col("_nz"), F.lit(0))).cast("double")
    pos2 = F.when(pos > F.abs(neg), pos + punct).otherwise(pos)
    neg2 = F.when(pos < F.abs(neg), neg - punct).otherwise(neg)
    total = pos2 + F.abs(neg2) + neu
    empty = n == 0
    # empty text scores neutral (neu = 1)
    return [
        _Named("sent_neg", F.when(empty, 0.0).otherwise(rnd(F.abs(neg2 / total), 3))),
        _Named("sent_neu", F.when(empty, 1.0).otherwise(rnd(F.abs(neu / total), 3))),
        _Named("sent_pos", F.when(empty, 0.0).otherwise(rnd(F.abs(pos2 / total), 3))),
        _Named("sent_compound", F.when(empty, 0.0).otherwise(rnd(comp, 4))),
    ]


def enrich(df: DataFrame, text_col: str, lexicon: DataFrame, boosters: DataFrame,
           negations: DataFrame, idioms: DataFrame, key: str, rules=ALL_RULES) -> DataFrame:
    """Add sent_neg/neu/pos/compound, sentiment_label, sentiment_band, is_negative.
    Rows are scored by their text alone, so repeated and null values of ``key`` are fine."""
    frames = dict(lexicon=lexicon, boosters=boosters, negations=negations, idioms=idioms)
    out = _scored(df, text_col, frames, rules, df.columns)
    return out.withColumns({
        "sentiment_label": labels.sentiment_label("sent_compound"),
        "sentiment_band": labels.sentiment_band("sent_compound"),
        "is_negative": labels.is_negative("sent_compound"),
    })


def sentiment_mix(df: DataFrame) -> DataFrame:
    """Share of each sentiment label among rows with a narrative."""
    from pyspark.sql import Window
    g = df.filter(F.col("has_narrative") == 1).groupBy("sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", rnd(F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


_SCORE_SCHEMA = T.StructType([T.StructField(c, T.DoubleType()) for c in
                              ("sent_neg", "sent_neu", "sent_pos", "sent_compound")])
