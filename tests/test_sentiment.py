"""Sentiment rules on hand-made English sentences with a small self-written lexicon."""
import math

import pytest
from pyspark.sql import functions as F

from plaint.operators.sentiment import lexicon_frames, score_sentiment

LEX = [("good", 1.9), ("bad", -2.5), ("great", 3.1), ("kind", 2.4)]
BOOST = [("very", 0.293), ("slightly", -0.293), ("kind of", -0.293)]
NEG = ["not", "never", "without"]
IDIOMS = [("cut the mustard", 2.0)]


def comp(s):
    return round(s / math.sqrt(s * s + 15), 4)


@pytest.fixture(scope="module")
def frames(spark):
    return lexicon_frames(spark, LEX, BOOST, NEG, IDIOMS)


CASES = [
    ("good", comp(1.9)),
    ("not good", comp(1.9 * -0.74)),
    ("very good", comp(1.9 + 0.293)),
    ("good!!", comp(1.9 + 2 * 0.292)),
    ("GOOD day", comp(1.9 + 0.733)),
    ("good but bad", comp(1.9 * 0.5 - 2.5 * 1.5)),
    ("isn't good", comp(1.9 * -0.74)),
    ("never so good", comp(1.9 * 1.25)),
    ("", 0.0),
    ("the cat sat", 0.0),
]


@pytest.mark.parametrize("text,expected", CASES)
def test_compound(spark, frames, text, expected):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    r = score_sentiment(df, "id", "text", **frames).collect()[0]
    assert abs(r.sent_compound - expected) < 1e-4, (text, r)


def test_empty_text_is_neutral(spark, frames):
    df = spark.createDataFrame([(1, "   ")], "id long, text string")
    r = score_sentiment(df, "id", "text", **frames).collect()[0]
    assert (r.sent_neg, r.sent_neu, r.sent_pos, r.sent_compound) == (0.0, 1.0, 0.0, 0.0)


def test_shares_sum_to_one(spark, frames):
    df = spark.createDataFrame([(1, "good and bad and nothing else")], "id long, text string")
    r = score_sentiment(df, "id", "text", **frames).collect()[0]
    assert abs(r.sent_neg + r.sent_neu + r.sent_pos - 1) < 2e-3


def test_copies_and_repeated_keys(spark, frames):
    """A text counts once for each row, whatever keys repeat, and blank texts are neutral."""
    rows = [(1, "very good"), (1, "very good"), (1, "bad"), (None, "bad"), (None, "bad"), (None, None), (2, ""), (2, " "), (3, "not good")]
    df = spark.createDataFrame(rows, "id long, text string")
    got = sorted(((r.id, r.sent_compound, r.sent_neu) for r in score_sentiment(df, "id", "text", **frames).collect()), key=str)
    texts = sorted({t for _, t in rows if t is not None})
    alone = score_sentiment(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text", **frames)
    one = {texts[r.id]: r for r in alone.collect()}
    one[None] = one[""]
    assert got == sorted(((i, one[t].sent_compound, one[t].sent_neu) for i, t in rows), key=str)


def test_each_distinct_text_is_scored_once(spark, frames):
    """With 500 copies of three texts the step that splits tokens gets three rows."""
    df = spark.range(500).selectExpr("id", "element_at(array('good day', 'not bad', 'very good!'), CAST(id % 3 + 1 AS INT)) AS text")
    plan = score_sentiment(df, "id", "text", **frames)._jdf.queryExecution().optimizedPlan().toString()
    explode = plan.index("Generate explode(arrays_zip")
    assert "Aggregate [_text_id" in plan[explode:]


def test_only_words_of_the_lexicon_are_exploded(spark, frames):
    """The loop over a text's words is no longer part of the lookups' generated code: of 300 words two reach them."""
    from plaint.operators import sentiment as S
    df = spark.createDataFrame([(1, "x " * 299 + "(GOOD), very"), (2, None), (3, " \t")], "id long, text string")
    scoring = frames["lexicon"].select(F.col("word").alias("_word"))
    got = S._candidates(df, "text", scoring).collect()
    assert [tuple(r) for r in got] == [(1, 299, "GOOD", "x", "x", "x", "very", None)]


@pytest.mark.parametrize("text,n,capdiff,but", [("a BUT, b", 3, True, 1), ("ALL CAPS", 2, False, -1), ("butter b", 2, False, -1), (" -- no but!", 3, False, 2), ("", 0, False, -1), (None, 0, False, -1), ("I x 1", 3, True, -1)])
def test_text_features(spark, text, n, capdiff, but):
    from plaint.operators import sentiment as S
    r = S.text_features(spark.createDataFrame([(text,)], "text string"), "text").first()
    assert (r["_n"], r["_capdiff"], r["_but"]) == (n, capdiff, but)


def test_narrative_is_worked_out_once(spark):
    from plaint.operators.clean import clean
    df = spark.createDataFrame([(1, " aXXX  XX\t b\u00a0 XXXX/XXXX ")], "complaint_id long, complaint_what_happened string")
    df = df.selectExpr("*", "timestamp'2020-01-01' AS date_received", "timestamp'2020-01-01' AS date_sent_to_company", "'Yes' AS timely", "'Closed' AS company_response")
    out = clean(df)
    assert out.first().narrative == "aXXX b\u00a0 /"
    plan = out.filter("has_narrative = 1")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("X(?<") == 1


def test_rows_are_worked_out_once(spark, frames):
    """Texts and result read the written rows, not the plan behind them."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(1, "good"), (2, None), (3, "bad day"), (3, "bad day")]
    df = spark.createDataFrame(rows, "id long, text string").mapInArrow(count, "id long, text string")
    got = sorted((r.id, r.sent_compound) for r in score_sentiment(df, "id", "text", **frames).collect())
    assert got == [(1, comp(1.9)), (2, 0.0), (3, comp(-2.5)), (3, comp(-2.5))] and seen.value == len(rows)


@pytest.mark.parametrize("text", ["a BUT, b GOOD", "GOOD CAPS", "good \x1cbut but (but)", " -- no BUT! but? good??", "x  GOOD ÉTÉ Go", "ǅ GOOD", ""])
def test_the_only_pass_tells_the_text_features(spark, frames, text):
    """Tokens, "but" and marks as the column expressions tell them; the gate where a word in capitals may score."""
    from plaint.operators import sentiment as S
    df = spark.createDataFrame([(1, text)], "id long, text string")
    want = S.text_features(df, "text").first()
    got = S._candidates(df, "text", frames["lexicon"].select(F.col("word").alias("_word")), features=True).collect()
    assert [r["pos"] for r in got].count(S.NOWHERE) == 1
    for r in got:
        assert (r["_n"], r["_but"], r["_ex"], r["_qm"]) == (want["_n"], want["_but"], text.count("!"), text.count("?"))
        assert not r["caps"] or r["_capdiff"] == want["_capdiff"]


def test_texts_are_read_by_one_pass(spark, frames):
    """The token counts come with the scoring words: no second aggregate of the texts is joined to them."""
    df = spark.createDataFrame([(1, "good"), (2, "bad day")], "id long, text string")
    plan = score_sentiment(df, "id", "text", **frames)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("first(text") == 1


def test_words_are_found_in_any_case_and_punctuation(spark):
    """The quick look at a text's tokens lets no scoring word go: short ones keep their marks, others lose them."""
    from plaint.operators import sentiment as S
    scoring = spark.createDataFrame([(w,) for w in (":)", "no", "ok!", "good", "été", "i\u0307z", "σας")], "_word string")
    text = "x :) ( :), NO No! no. OK! ok \"Good\"... goo-d ÉTÉ, \u0130Z ΣΑΣ ΣΑΣ. --- ´good but"
    got = S._candidates(spark.createDataFrame([(text,)], "text string"), "text", scoring).collect()
    tokens = text.split(" ")

    def core(t):
        inner = t.strip(S.PUNCTUATION)
        return inner if len(inner) >= 3 else t

    known = {r[0] for r in scoring.collect()}
    assert [r["pos"] for r in got] == [p for p, t in enumerate(tokens) if core(t).lower() in known]
