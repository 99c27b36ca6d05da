"""Industry MIS roll-ups over the bulk export.

The reference accumulates chunk-local group-bys into Python dicts; here the
same work is one declarative aggregate: Spark's partial HashAggregate plays
the per-chunk role, the Exchange + final HashAggregate the merge. Skewed
companies (a few hold most rows) are harmless because partial aggregation
collapses them map-side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, labels, text
from ..functions.numeric import rnd

SEGMENT_ALL = "Industry"
SEGMENT_TARGET = "Target"


def mis_flags(df: DataFrame, target: str) -> DataFrame:
    """Per-row MIS flags: month key, timely, relief, raw narrative present, target."""
    return df.select(
        dates.year_month(dates.as_timestamp("date_received")).alias("year_month"),
        F.col("company"),
        labels.timely_yes("timely").alias("timely_yes"),
        labels.relief("company_response").alias("relief"),
        (F.length(F.coalesce("complaint_what_happened", F.lit(""))) > 0).alias("has_narr"),
        text.upper_equals("company", target).alias("is_target"),
    )


def _rates(df: DataFrame, digits: int = 4) -> DataFrame:
    return df.withColumns({
        "timely_rate": rnd(F.col("timely") / F.col("complaints"), digits),
        "relief_rate": rnd(F.col("relief") / F.col("complaints"), digits),
        "narrative_rate": rnd(F.col("narrative") / F.col("complaints"), digits),
    })


def _sums() -> list:
    t = F.col("is_target")
    return [
        F.count(F.lit(1)).alias("all_complaints"),
        F.count_if("timely_yes").alias("all_timely"),
        F.count_if("relief").alias("all_relief"),
        F.count_if("has_narr").alias("all_narrative"),
        F.count_if(t).alias("tgt_complaints"),
        F.count_if(t & F.col("timely_yes")).alias("tgt_timely"),
        F.count_if(t & F.col("relief")).alias("tgt_relief"),
        F.count_if(t & F.col("has_narr")).alias("tgt_narrative"),
    ]


def mis_rollup(df: DataFrame, target: str) -> DataFrame:
    """(by_company, year_month, company, sums): months and companies in one scan by grouping sets.

    Write or checkpoint it once; ``monthly_of``, ``league_of`` and ``mis_summary`` read it. Undated rows
    count for their company and form the month null."""
    f = mis_flags(df, target).withColumn("company", F.coalesce("company", F.lit("Unknown")))
    g = f.groupingSets([["year_month"], ["company"]], "year_month", "company")
    return g.agg(F.grouping("year_month").alias("by_company"), *_sums())


def monthly_of(rollup: DataFrame, target_segment: str = SEGMENT_TARGET) -> DataFrame:
    """The monthly table from a roll-up."""
    return _segments(rollup.filter((F.col("by_company") == 0) & F.col("year_month").isNotNull()), target_segment)


def league_of(rollup: DataFrame, target: str) -> DataFrame:
    """The league table from a roll-up."""
    g = rollup.filter(F.col("by_company") == 1)
    return _league(g.select("company", *[F.col(f"all_{c}").alias(c) for c in ("complaints", "timely", "relief", "narrative")]), target)


def mis_monthly(df: DataFrame, target: str, target_segment: str = SEGMENT_TARGET) -> DataFrame:
    """Per (year_month, segment): complaints, timely, relief, narrative, 3 rates.

    One scan with conditional counts, then an unpivot into the two segments
    (the reference scans each chunk twice). Undated rows are dropped; a
    segment row exists only where it has complaints."""
    f = mis_flags(df, target).filter(F.col("year_month").isNotNull())
    return _segments(f.groupBy("year_month").agg(*_sums()), target_segment)


def _segments(g: DataFrame, target_segment: str) -> DataFrame:
    long = g.select(
        "year_month",
        F.explode(F.array(
            F.struct(F.lit(SEGMENT_ALL).alias("segment"), F.col("all_complaints").alias("complaints"),
                     F.col("all_timely").alias("timely"), F.col("all_relief").alias("relief"),
                     F.col("all_narrative").alias("narrative")),
            F.struct(F.lit(target_segment).alias("segment"), F.col("tgt_complaints").alias("complaints"),
                     F.col("tgt_timely").alias("timely"), F.col("tgt_relief").alias("relief"),
                     F.col("tgt_narrative").alias("narrative")),
        )).alias("s"),
    ).select("year_month", "s.*")
    long = long.filter((F.col("complaints") > 0) & F.col("year_month").rlike(r"^\d{4}-\d{2}"))
    return _rates(long).orderBy("year_month", "segment")


def mis_company(df: DataFrame, target: str) -> DataFrame:
    """League table per company (null -> Unknown), rates, rank, target flag.
    Undated rows are kept here (unlike the monthly table)."""
    f = mis_flags(df, target).withColumn("company", F.coalesce("company", F.lit("Unknown")))
    g = f.groupBy("company").agg(
        F.count(F.lit(1)).alias("complaints"),
        F.count_if("timely_yes").alias("timely"),
        F.count_if("relief").alias("relief"),
        F.count_if("has_narr").alias("narrative"),
    )
    return _league(g, target)


def _league(g: DataFrame, target: str) -> DataFrame:
    g = _rates(g)
    return company_rank(g).withColumn("is_target", F.upper("company") == F.lit(target.upper()))


def company_rank(league: DataFrame) -> DataFrame:
    """1..N by complaints desc; ties broken by name, never shared.

    A global (un-partitioned) window: only ever applied to the aggregated
    league table, whose size is the number of companies, not of rows."""
    w = Window.orderBy(F.col("complaints").desc(), F.col("company"))
    return league.withColumn("rank", F.row_number().over(w))


def mis_summary(monthly: DataFrame, league: DataFrame) -> DataFrame:
    """Total rows, companies, months and the target's rank, as one row.

    Two scalar aggregates are combined by union + aggregate (no cross join)."""
    a = league.agg(
        F.sum("complaints").alias("total_rows_processed"),
        F.count(F.lit(1)).alias("distinct_companies"),
        F.lit(None).cast("long").alias("months"),
        F.max(F.when(F.col("is_target"), F.col("rank"))).alias("target_rank"),
    )
    b = monthly.agg(
        F.lit(None).cast("long").alias("total_rows_processed"),
        F.lit(None).cast("long").alias("distinct_companies"),
        F.count_distinct("year_month").alias("months"),
        F.lit(None).cast("int").alias("target_rank"),
    )
    return a.unionByName(b).agg(*[F.max(c).alias(c) for c in a.columns])


def distinct_companies(df: DataFrame) -> DataFrame:
    """Exact number of companies (null -> Unknown) and of dated months."""
    ym = dates.year_month(dates.as_timestamp("date_received"))
    return df.agg(
        F.count_distinct(F.coalesce("company", F.lit("Unknown"))).alias("distinct_companies"),
        F.count_distinct(ym).alias("months"),
    )


def top_companies(league: DataFrame, n: int = 15, name_chars: int = 40) -> DataFrame:
    return (league.filter(F.col("rank") <= n)
            .select(text.truncate("company", name_chars).alias("company"), "complaints",
                    "timely_rate", "relief_rate", "is_target", "rank"))


def industry_context(league: DataFrame, n: int = 15) -> DataFrame:
    """Top-n companies plus industry totals and the target's rank and rates,
    carried as columns via whole-table window aggregates over the league."""
    w = Window.partitionBy()
    ctx = league.select(
        "*",
        F.sum("complaints").over(w).alias("total_rows_processed"),
        F.count(F.lit(1)).over(w).alias("distinct_companies"),
        F.max(F.when(F.col("is_target"), F.col("rank"))).over(w).alias("target_rank"),
        F.max(F.when(F.col("is_target"), F.col("timely_rate"))).over(w).alias("target_timely_rate"),
        F.max(F.when(F.col("is_target"), F.col("relief_rate"))).over(w).alias("target_relief_rate"),
    )
    return (ctx.filter(F.col("rank") <= n)
            .select(text.truncate("company", 40).alias("company"), "complaints", "timely_rate",
                    "relief_rate", "is_target", "rank", "total_rows_processed",
                    "distinct_companies", "target_rank", "target_timely_rate", "target_relief_rate"))


def industry_benchmark(monthly: DataFrame, since: str = "2019-01") -> DataFrame:
    return (monthly.filter(F.col("year_month") >= since)
            .select("year_month", "segment", "complaints", "timely_rate", "relief_rate"))
