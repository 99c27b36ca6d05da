"""Star-schema date dimension and BI time intelligence.

Calendar tables (one row per day or month with data) are bounded by the
calendar, not by the fact, so joining them with range conditions or
broadcasting them is safe at any fact size."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import safe_rate
from ..functions.numeric import rnd


def _date_attrs(d):
    return [F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            F.date_format(d, "MMM").alias("month_name"), F.date_format(d, "yyyy-MM").alias("year_month")]


def dim_date(fact: DataFrame, ts: str = "date_received") -> DataFrame:
    """Distinct non-null fact days with year, quarter, month, MMM, yyyy-MM."""
    days = fact.select(F.to_date(ts).alias("date")).filter(F.col("date").isNotNull()).distinct()
    return days.select("date", *_date_attrs(F.col("date")))


def dim_date_calendar(fact: DataFrame, ts: str = "date_received") -> DataFrame:
    """Contiguous calendar from the first to the last fact day."""
    b = fact.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = b.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select("date", *_date_attrs(F.col("date")))


def join_dim_date(fact: DataFrame, dim: DataFrame, ts: str = "date_received") -> DataFrame:
    """Fact N:1 date dimension on the day (dimension broadcast: calendar-bounded).
    Fact columns named like dimension attributes are replaced by the dimension's."""
    fact = fact.drop(*[c for c in dim.columns if c in fact.columns and c != ts])
    return fact.join(F.broadcast(dim), F.to_date(fact[ts]) == dim["date"], "left")


def monthly_counts(fact: DataFrame, ts: str = "date_received") -> DataFrame:
    return fact.filter(F.col(ts).isNotNull()) \
        .groupBy(F.trunc(F.to_date(ts), "month").alias("month")).agg(F.count(F.lit(1)).alias("complaints"))


def period_change(monthly: DataFrame, months_back: int, out: str) -> DataFrame:
    """(cur - prev) / prev against the same measure ``months_back`` calendar months earlier.

    Every month reports itself and, shifted, what it is the previous month of; one aggregate brings both
    together, so the fact is read once and a missing month gives null rather than the row before."""
    both = monthly.select(F.explode(F.array(
        F.struct(F.col("month"), F.col("complaints"), F.lit(None).cast("long").alias("previous")),
        F.struct(F.add_months("month", months_back).alias("month"), F.lit(None).cast("long").alias("complaints"),
                 F.col("complaints").alias("previous")))).alias("m")).select("m.*")
    g = both.groupBy("month").agg(F.max("complaints").alias("complaints"), F.max("previous").alias("previous"))
    return g.filter(F.col("complaints").isNotNull()).select(
        "month", "complaints", "previous",
        rnd(safe_rate(F.col("complaints") - F.col("previous"), F.col("previous")), 4).alias(out))


def mom_change(fact: DataFrame) -> DataFrame:
    return period_change(monthly_counts(fact), 1, "mom_change")


def yoy_change(fact: DataFrame) -> DataFrame:
    return period_change(monthly_counts(fact), 12, "yoy_change")


def daily_counts(fact: DataFrame, ts: str = "date_received") -> DataFrame:
    return fact.filter(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def period_sums(daily: DataFrame, periods: Column, by: list[str], out: str) -> DataFrame:
    """Sums of ``n`` over periods of days, any number and any overlap, from one running sum.

    ``daily`` has one row per ``day``; ``periods`` is an array of structs (start, end, ``by`` columns) that a
    row asks for, or null. A period is the days after ``start`` up to ``end``: the running sum at its
    end less that at its start. Days and both bounds are rows of one calendar, so there is no range join. The
    order goes through one window, whose rows are days and period bounds, not rows of the fact. Periods of
    equal ``by`` values add up; a period without days gives 0."""
    keys = [F.col(f"p.{c}").alias(c) for c in by]
    none = [F.lit(None).cast(t).alias(c) for c, t in daily.select(F.explode(periods).alias("p")).select(*keys).dtypes]
    asked = daily.select(F.explode(periods).alias("p"))
    events = (daily.select(F.col("day").alias("at"), "n", F.lit(0).alias("sign"), *none)
              .unionByName(asked.select(F.col("p.end").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("sign"), *keys))
              .unionByName(asked.select(F.col("p.start").alias("at"), F.lit(0).cast("long").alias("n"), F.lit(-1).alias("sign"), *keys)))
    # the default frame takes in all rows of the same day, so a bound on a day with data counts that day
    run = events.withColumn("_run", F.sum("n").over(Window.orderBy("at")))
    return run.filter(F.col("sign") != 0).groupBy(*by).agg(F.sum(F.col("_run") * F.col("sign")).cast("long").alias(out))


def rolling_3m(fact: DataFrame, ts: str = "date_received", months: int = 3) -> DataFrame:
    """Per month: complaints on days in (last_day - 3 months, last_day], where
    last_day is the month's last day with data (DATESINPERIOD semantics)."""
    month = F.trunc("day", "month")
    daily = daily_counts(fact, ts).withColumn("_last", F.max("day").over(Window.partitionBy(month)) == F.col("day"))
    period = F.struct(F.add_months("day", -months).alias("start"), F.col("day").alias("end"), month.alias("month"))
    return period_sums(daily, F.when(F.col("_last"), F.array(period)), ["month"], "rolling_3m")
