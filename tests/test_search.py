"""The trigram index against a plain scan of the same texts."""
import random

import pyarrow as pa
from pyspark.sql import functions as F

from plaint.operators import search as S
from plaint.session import scratch_path

TERMS = ["abc", "ABC", "bca b", "a", "ab", "", "zzz", "none of it", "日本語", "本", "c\na", "aaaa", "%_a", "İb"]


def texts():
    rnd = random.Random(5)
    rows = [(i, "".join(rnd.choice("abcABC \n") for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(7, "abc twice under one key"), (7, "bca b"), (None, "abc without key"), (None, "also without: none of it"), (200, None),
             (201, "x日本語のa"), (202, "aaaaaaaa"), (203, "100%_a"), (204, "İbis"), (205, "ab" * 50_000 + "none OF it")]
    return rows


def expected(rows, folded):
    return sorted(((t, k) for t, f in folded.items() for k, lower in rows if f in lower), key=str)


def test_search_equals_scan(spark, tmp_path):
    df = spark.createDataFrame(texts(), "id long, body string")
    path = str(tmp_path / "index")
    S.write_index(df, "id", "body", path, buckets=8)
    lowered = [(r.id, r.t) for r in df.select("id", F.lower(F.coalesce("body", F.lit(""))).alias("t")).collect()]
    folded = {r.t: r.f for r in spark.createDataFrame([(t,) for t in TERMS], "t string").withColumn("f", F.lower("t")).collect()}
    got = sorted(((r.term, r.key) for r in S.search(spark, path, TERMS, buckets=8).collect()), key=str)
    assert got == expected(lowered, folded)
    assert S.search(spark, path, [], buckets=8).count() == 0


def test_a_gram_is_sent_once_for_many_texts():
    """Postings go to their bucket as a gram and its keys, repeated and null keys among them."""
    grams = [["abc", "bcd"], None, ["bcd"], [], ["abc", "xyz", "bcd"]]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6, None, 7, 5], pa.int64()), pa.array(grams, pa.list_(pa.string()))], names=["key", "grams"])
    sent = [r for part in S._keys_by_gram(iter([batch.slice(0, 0), batch])) for r in part.to_pylist()]
    assert sorted((r["gram"], r["keys"]) for r in sent) == [("abc", [5, 5]), ("bcd", [5, None, 5]), ("xyz", [5])]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "index")
    S.write_index(spark.createDataFrame([], "id long, body string"), "id", "body", path, buckets=4)
    assert S.search(spark, path, ["abc", "a"], buckets=4).count() == 0


def test_search_reads_less_than_a_scan(spark):
    """The plan prunes postings by bucket and gram, and text folders by the candidates."""
    path = scratch_path(spark, "search_plan_test")
    df = spark.range(3000).select(F.col("id"), F.concat(F.lit("text number "), F.md5(F.col("id").cast("string"))).alias("body"))
    S.write_index(df.withColumn("body", F.when(F.col("id") == 17, F.lit("a needle here")).otherwise(F.col("body"))), "id", "body", path)
    found = S.search(spark, path, ["needle"])
    assert [tuple(r) for r in found.collect()] == [("needle", 17)]
    plan = found._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan and "PushedFilters: [In(gram" in plan
    assert spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin("nee", "dle")).count() == 2
