"""A corpus pipeline over ``documents``: language ID, quality rules, SimHash near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as the next one's ``docs``.
All but the last return the columns of documents. Null texts have no letter and leave in the first stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plaint.llm import langid, packing, quality, simhash, substrings
from plaint.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a learned language, however short or close to another one; only those without letters (``und``) go."""
    got = langid.identify(docs.select(*COLUMNS), langid.training_sample(langid.train_rows(docs)))
    return got.filter(F.col("lang_pred") != langid.UNKNOWN).select("row.*")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass the base check and that no learned rule rejects; the rules are learned on this stage's documents."""
    learned = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_stats(docs.select(*COLUMNS)).filter(~quality.base_failed() & quality.verdict(learned)).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: that with the smallest doc_id, or one without doc_id if none has any."""
    return simhash.one_per_component(docs.select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes the words that a window shared with an earlier document covers; texts that lose none stay as they are."""
    got = substrings.remove_repeats(docs.select(*COLUMNS), keep_columns=("doc_id", "lang", "source", "n_chars"), as_is=True)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")).cast("long")
    return got.select("row.doc_id", F.col("kept").alias("text"), "row.lang", "row.source", n_chars.alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token pieces of all documents into sequences of at most 4096 tokens."""
    return packing.packed_documents(docs)


STAGES = [("language ID", language), ("quality rules", rules), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup), ("best-fit packing", pack)]

#: SQL can't express the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each one's result is written in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
