"""The corpus pipeline stage by stage against what each operator says, on the test tables and on edge rows."""
import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

from plaint.llm import langid, quality, simhash, substrings
from plaint.llm.common import table, written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage and the last one's result."""
    out = [table(spark, SF, "documents")]
    for k, (_, stage) in enumerate(cp.STAGES):
        out.append(written(stage(spark, out[-1], SF), f"test{k}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_keep_the_columns_of_documents(steps):
    assert [n for n, _ in cp.STAGES] == ["language ID", "quality rules", "SimHash near-dedup", "substring dedup", "best-fit packing"]
    for df in steps[1:5]:
        assert df.dtypes == steps[0].dtypes


def test_each_stage_does_what_its_operator_decides(spark, steps):
    docs, known, good, one, cut, packed = steps
    got = langid.identify(docs, langid.training_sample(langid.train_rows(docs)))
    assert ids(known) == sorted(r.doc_id for r in got.filter(f"lang_pred <> 'und'").select("row.doc_id").collect())
    rules = quality.fit(known, table(spark, SF, "labels"))
    stats = quality.with_stats(known).filter(~quality.base_failed() & quality.verdict(rules)).select("row.doc_id")
    assert ids(good) == ids(stats)
    assert ids(one) == sorted({r.component_id for r in simhash.near_duplicates(good).collect()})
    kept = {r.doc_id: r for r in substrings.remove_repeats(one, keep_columns=("doc_id", "text")).select("row.doc_id", "row.text", "n_removed", "kept").collect()}
    assert {r.doc_id: r.text for r in cut.collect()} == {k: r.kept if r.n_removed else r.text for k, r in kept.items()}
    assert all(r.n_chars == len(r.text) for r in cut.collect() if kept[r.doc_id].n_removed)
    assert sorted(set(ids(packed))) == ids(cut)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096


def test_clean_documents_stay(spark, steps):
    """Of the documents labelled good that pass the fixed base check, the filters keep nearly all."""
    labels = table(spark, SF, "labels").filter("quality = 1").select("doc_id")
    passed = quality.with_stats(steps[0].select("doc_id", "text")).filter(~quality.base_failed()).select("row.doc_id")
    clean = labels.join(passed, "doc_id")
    assert clean.join(steps[2], "doc_id", "left_semi").count() >= 0.98 * clean.count()


def test_short_and_close_documents_stay_after_language_id(spark):
    """Labelled documents cut to one to ten words, and a language that is there under two labels."""
    docs = table(spark, SF, "documents").filter(F.col("text").rlike(r"\p{L}"))
    word = F.filter(F.split("text", r"\s+"), lambda w: w.rlike(r"\p{L}"))
    short = docs.filter(F.col("lang").isNotNull()).withColumn("n", F.explode(F.array(*[F.lit(k) for k in (1, 2, 3, 5, 10)])))
    short = short.withColumn("text", F.array_join(F.slice(word, 1, F.col("n")), " ")).withColumn("doc_id", F.col("doc_id") * 100 + F.col("n") + 10**6)
    twice = docs.filter("lang = 'en'").withColumn("lang", F.lit("en2")).withColumn("doc_id", F.col("doc_id") + 10**9)
    mixed = written(docs.unionByName(short.drop("n")).unionByName(twice), "mixed")
    assert mixed.filter("lang = 'en2'").count() and ids(cp.language(spark, mixed, SF)) == ids(mixed)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    """Copies without ids, and two different texts under one id."""
    one, two, three = (" ".join(f"{p}{i * i}" for i in range(80)) for p in ("alpha", "beta", "gamma"))
    rows = [(None, one), (None, one), (1, two), (1, three), (1, two), (2, three), (None, three), (7, two)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = [tuple(r) for r in cp.near_dedup(spark, docs, SF).select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted([(None, one), (1, two), (1, three)], key=str)


def test_edge_rows_go_through_every_stage(spark):
    rows = [(None, "word " * 3, "en", None, 15), (1, None, None, "s", None), (2, "", "en", "s", 0), (3, "Some words of a short text that nothing else says today", "en", "s", 5)] * 2
    edge = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("extra", F.lit(1)).withColumn("score", F.lit("clash"))
    for some in (edge, edge.limit(0)):
        for _, stage in cp.STAGES[:4]:
            assert stage(spark, some, SF).dtypes == [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")]
            assert stage(spark, some, SF).count() <= some.count()
        assert cp.STAGES[4][1](spark, some, SF).count() == some.count()
