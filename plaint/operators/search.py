"""Substring search over a text table by a trigram index.

``write_index`` writes three tables: ``postings`` (gram, key) in folders by hash bucket of the gram and sorted by
it, ``grams`` (gram, number of texts) and ``texts`` in folders by hash bucket of the key. A search reads the
folders of its rarest grams, intersects their postings, and reads only the text folders that hold a candidate to
verify each with ``contains``; terms of fewer than three letters are looked up by a scan of the texts."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .terms import word_slices

BUCKETS = 64
RAREST = 4  # grams of a term whose postings are read; what they let through by chance is verified
# every three letters in a row: matches are empty, so the next begins one letter on
_EACH_GRAM = r"(?s)(?=(...))"


def _grams(folded: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(_EACH_GRAM), 1))


def _bucket(c: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    other = {"texts": "text", "postings": "gram"}[name]
    key = spark.read.parquet(f"{path}/keys").schema["key"].dataType.simpleString()
    return spark.read.schema(f"key {key}, {other} string, bucket int").parquet(f"{path}/{name}")


def _keys_by_gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, keys of the batch's texts that hold it): a gram is sent once for many texts."""
    for batch in word_slices(batches, "grams"):
        lists = batch.column(1)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        rows = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        ends = np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))
        keys = batch.column(0).take(pa.array(rows[np.argsort(codes, kind="stable")]))
        yield pa.RecordBatch.from_arrays([coded.dictionary, pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), keys)], names=["gram", "keys"])


def write_index(df: DataFrame, key: str, text_col: str, path: str, buckets: int = BUCKETS) -> None:
    """Index the texts of ``df`` (null counts as empty), letters folded to lower case. Keys may repeat or be null.

    Rows are rebalanced by bucket: small buckets share a task, one that outgrows a task (a frequent gram, a hot
    key) is split over several by its size at run time. Files are sorted, so a reader skips other row groups."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.select(F.col(key).alias("key"), text.alias("text"))
    (df.withColumn("bucket", _bucket(F.col("key"), buckets)).hint("rebalance", "bucket")
     .sortWithinPartitions("bucket", "key").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/texts"))
    kind = df.schema["key"].dataType.simpleString()
    posts = df.select("key", _grams(F.lower("text")).alias("grams")).mapInArrow(_keys_by_gram, f"gram string, keys array<{kind}>")
    (posts.withColumn("bucket", _bucket(F.col("gram"), buckets)).hint("rebalance", "bucket").select("gram", F.explode("keys").alias("key"), "bucket")
     .sortWithinPartitions("bucket", "gram", "key").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/postings"))
    df.select("key").limit(0).write.parquet(f"{path}/keys")  # an empty partitioned table has no file to tell the key's type
    counts = _table(df.sparkSession, path, "postings").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    counts.sort("gram").write.parquet(f"{path}/grams")


def _plan(spark: SparkSession, path: str, terms: list[str], buckets: int, rarest: int) -> list:
    """(term, folded, grams with their buckets, rarest first) per term of the search; a gram that no text has counts 0."""
    t = spark.createDataFrame([(x,) for x in dict.fromkeys(terms)], "term string").withColumn("folded", F.lower("term"))
    t = t.withColumn("gram", F.explode_outer(_grams(F.col("folded"))))
    known = spark.read.parquet(f"{path}/grams").join(F.broadcast(t.select("gram").distinct()), "gram")
    best = F.slice(F.sort_array(F.collect_list(F.when(F.col("gram").isNotNull(), F.struct(
        F.coalesce("n", F.lit(0)).alias("n"), "gram", _bucket(F.col("gram"), buckets).alias("bucket"))))), 1, rarest)
    return t.join(known, "gram", "left").groupBy("term", "folded").agg(best.alias("grams")).collect()


def search(spark: SparkSession, path: str, terms: list[str], buckets: int = BUCKETS, rarest: int = RAREST) -> DataFrame:
    """(term, key) for every text that contains a term, whatever the case. ``terms`` are what a user typed, a
    few; ``buckets`` as given to ``write_index``."""
    plan = _plan(spark, path, terms, buckets, rarest)
    texts = _table(spark, path, "texts")
    parts = []
    wanted = [(p.term, p.folded, g.gram, g.bucket, 1 << i, (1 << len(p.grams)) - 1)
              for p in plan if p.grams and p.grams[0].n > 0 for i, g in enumerate(p.grams)]
    if wanted:
        want = spark.createDataFrame(wanted, "term string, folded string, gram string, bucket int, flag int, all int")
        posts = _table(spark, path, "postings") \
            .filter(F.col("bucket").isin(sorted({w[3] for w in wanted})) & F.col("gram").isin(sorted({w[2] for w in wanted})))
        hits = posts.join(F.broadcast(want.drop("bucket")), "gram").groupBy("term", "folded", "key") \
            .agg(F.bit_or("flag").alias("flags"), F.max("all").alias("all")).filter(F.col("flags") == F.col("all"))
        hits = hits.select("term", "folded", F.col("key").alias("_key"), _bucket(F.col("key"), buckets).alias("_bucket"))
        j = texts.join(hits, (texts.bucket == hits._bucket) & texts.key.eqNullSafe(hits._key))
        parts.append(j.filter(F.lower("text").contains(F.col("folded"))).select("term", "key"))
    for p in plan:
        if not p.grams:
            parts.append(texts.filter(F.lower("text").contains(p.folded)).select(F.lit(p.term).alias("term"), "key"))
    if not parts:
        return texts.select(F.lit("").alias("term"), "key").limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
