"""Complaint-shaped stand-in inputs built from the driver's test tables.

These only give rows in the schema the jobs expect; they do none of the jobs'
work. Every job must be right on any data of that schema.

* ``bulk``   – industry export shape (one row per lineitem): feeds MIS.
* ``cases``  – one company's case feed (one row per order), narratives from
  ``documents`` joined on id.
* ``feed``   – case feed with repeated ids (lineitem order keys) for de-dup.
* ``scored_cases`` – cases run through clean + sentiment, with two model-score
  stand-ins taken from table columns (models are checked separately).
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# --- fixed values: target company of the test tables -------------------------
TARGET_COMPANY = "Supplier#000000000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    j = l.join(s, l.l_suppkey == s.s_suppkey).join(p, l.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_shipdate").cast("timestamp").alias("date_received"),
        F.col("s_name").alias("company"),
        F.col("p_brand").alias("product"),
        F.col("p_type").alias("issue"),
        F.when(F.col("l_linestatus") == "O", "Yes").otherwise(" no ").alias("timely"),
        F.when(F.col("l_returnflag") == "R", "Closed with monetary relief")
         .when(F.col("l_returnflag") == "A", "Closed with explanation")
         .otherwise("Closed with non-monetary relief").alias("company_response"),
        F.when(F.col("l_tax") > 0.04, "text").otherwise("").alias("complaint_what_happened"),
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    first_ship = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                  .agg(F.min("l_shipdate").alias("first_ship")))
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(first_ship, first_ship.l_orderkey == o.o_orderkey, "left")
          .join(d, d.doc_id == o.o_orderkey, "left"))
    nk = F.col("c_nationkey")
    state = F.concat(F.chr(F.lit(65) + nk % 5), F.chr(F.lit(65) + F.floor(nk / 5)))
    via = (F.when(F.col("o_custkey") % 4 == 0, "Web").when(F.col("o_custkey") % 4 == 1, "Phone")
           .when(F.col("o_custkey") % 4 == 2, "Referral"))
    response = (F.when(F.col("o_orderstatus") == "F", "Closed with explanation")
                .when(F.col("o_orderstatus") == "O", "Closed with monetary relief")
                .otherwise("In progress"))
    fs = F.col("first_ship").cast("timestamp")
    od = F.col("o_orderdate").cast("timestamp")
    timely = F.when(fs.isNull(), F.lit(None).cast("string")).when(fs > od, "Yes").otherwise("No")
    text = F.when(F.col("text").isNull(), F.lit("")).otherwise(
        F.concat(F.col("text"), F.lit(" XX/XX/XXXX charged XXXX")))
    return j.select(
        F.col("o_orderkey").alias("complaint_id"),
        od.alias("date_received"),
        fs.alias("date_sent_to_company"),
        F.col("c_mktsegment").alias("product"),
        F.lit(None).cast("string").alias("sub_product"),
        F.col("o_orderpriority").alias("issue"),
        F.lit(None).cast("string").alias("sub_issue"),
        F.lit(TARGET_COMPANY).alias("company"),
        state.alias("state"),
        via.alias("submitted_via"),
        response.alias("company_response"),
        timely.alias("timely"),
        text.alias("complaint_what_happened"),
        # stand-ins for the two model outputs (see scored_cases)
        ((F.col("c_acctbal") + 1000.0) / 11000.0).alias("score_hint_a"),
        (F.col("o_totalprice") / (F.col("o_totalprice") + 200000.0)).alias("score_hint_b"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case feed with repeated ids (order key of each line item)."""
    l = table(spark, sf_dir, "lineitem")
    ship = F.col("l_shipdate").cast("timestamp")
    return l.select(
        F.col("l_orderkey").alias("complaint_id"),
        ship.alias("date_received"),
        F.expr("timestampadd(DAY, l_linenumber, CAST(l_shipdate AS TIMESTAMP))").alias("date_sent_to_company"),
        F.col("l_returnflag").alias("product"),
        F.col("l_linestatus").alias("issue"),
        F.when(F.col("l_returnflag") == "R", "Closed with monetary relief")
         .otherwise("Closed with explanation").alias("company_response"),
        F.when(F.col("l_linestatus") == "O", "Yes").otherwise("No").alias("timely"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("complaint_what_happened"),
    )


# --- fixed values: test lexicon over frequent invented words of `documents` ---
# The driver's prose is invented, so an English lexicon would never match.
# (token, valence)
FIXTURE_LEXICON = [
    ("rewh", -1.8), ("orre", 1.6), ("thatin", -2.2), ("inoran", 1.1),
    ("ononst", -0.9), ("hehely", 2.4), ("orantion", -2.7), ("ha", 1.3),
    ("ed", -0.6), ("ing", 0.8), ("tion", -1.4), ("ble", -1.0), ("ea", 1.7),
    ("no", -1.2), ("der", 0.9), ("que", -0.7), ("ou", 1.2), ("ti", -1.5),
    ("sich", 2.0), ("los", -2.1),
]
# (token or phrase, increment)
FIXTURE_BOOSTERS = [("ly", 0.293), ("re", -0.293), ("nt", 0.293), ("he", 0.293),
                    ("the of", 0.293), ("of the", -0.293)]
# negation words
FIXTURE_NEGATIONS = ["nd", "st", "zu", "never", "without"]
# (phrase, valence)
FIXTURE_IDIOMS = [("the rewh", 1.5), ("the orre", -1.5), ("rewh the", 2.0),
                  ("of thatin", 0.5)]


def fixture_lexicons(spark: SparkSession) -> dict[str, DataFrame]:
    from ..operators.sentiment import lexicon_frames
    return lexicon_frames(spark, FIXTURE_LEXICON, FIXTURE_BOOSTERS,
                          FIXTURE_NEGATIONS, FIXTURE_IDIOMS)


def scored_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cases -> clean -> sentiment -> score stand-ins -> flags and labels."""
    from ..operators.clean import clean
    from ..operators.scoring import attach_scores, select_scored
    from ..operators.sentiment import enrich
    df = clean(cases(spark, sf_dir)).drop("complaint_what_happened")  # the fact holds the cleaned text
    df = enrich(df, "narrative", **fixture_lexicons(spark), key="complaint_id")
    return select_scored(attach_scores(df, F.col("score_hint_a"), F.col("score_hint_b")))


_FACTS: dict[tuple[str, str], str] = {}


def scored_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored fact, built once per Spark application and input folder as a
    new Parquet table in the shared checkpoint folder (lineage cut; survives
    executor loss) and read back by every dashboard query. An application
    always reads a table that its own code built."""
    from ..session import scratch_path
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FACTS:
        path = scratch_path(spark, f"scored_{uuid.uuid4().hex}")
        scored_cases(spark, sf_dir).write.option("compression", "zstd").parquet(path)
        _FACTS[key] = path
    return spark.read.parquet(_FACTS[key])
