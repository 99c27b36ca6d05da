"""Period sums and month changes against loops over the days."""
import calendar
import datetime as dt
import random

from pyspark.sql import functions as F

from plaint.operators import bi

D = dt.date


def months_before(d, k):
    y, m = divmod(d.year * 12 + d.month - 1 - k, 12)
    return D(y, m + 1, min(d.day, calendar.monthrange(y, m + 1)[1]))


def fact(spark, days):
    return spark.createDataFrame([(d,) for d in days], "date_received date")


def test_rolling_with_gaps_and_month_ends(spark):
    rnd = random.Random(3)
    days = [D(2019, 11, 1) + dt.timedelta(rnd.randint(0, 700)) for _ in range(400)]
    days = [d for d in days if (d.year, d.month) not in ((2020, 4), (2020, 5), (2020, 6), (2020, 7))]
    days += [D(2020, 2, 29), D(2019, 11, 30), D(2020, 1, 31), D(2020, 3, 31), None]
    got = {r.month: r.rolling_3m for r in bi.rolling_3m(fact(spark, days)).collect()}
    days = [d for d in days if d]
    want = {}
    for m in {d.replace(day=1) for d in days}:
        last = max(d for d in days if d.replace(day=1) == m)
        want[m] = sum(months_before(last, 3) < d <= last for d in days)
    assert got == want


def test_any_periods(spark):
    """Overlapping, equal, empty and far periods; those of one name add up."""
    rnd = random.Random(4)
    days = [D(2020, 1, 1) + dt.timedelta(rnd.randint(0, 50)) for _ in range(200)]
    periods = [("a", D(2020, 1, 3), D(2020, 1, 20)), ("b", D(2020, 1, 10), D(2020, 2, 9)), ("b", D(2020, 1, 10), D(2020, 1, 12)),
               ("none", D(2030, 1, 1), D(2030, 2, 1)), ("all", D(2000, 1, 1), D(2040, 1, 1)), ("nothing", D(2020, 1, 5), D(2020, 1, 5))]
    daily = bi.daily_counts(fact(spark, days))
    first = F.col("day") == F.lit(min(days))
    asked = F.array(*[F.struct(F.lit(s).alias("start"), F.lit(e).alias("end"), F.lit(n).alias("name")) for n, s, e in periods])
    got = {r.name: r.total for r in bi.period_sums(daily, F.when(first, asked), ["name"], "total").collect()}
    want = {}
    for n, s, e in periods:
        want[n] = want.get(n, 0) + sum(s < d <= e for d in days)
    assert got == want


def test_change_with_a_missing_month(spark):
    days = [D(2020, 1, 5)] * 4 + [D(2020, 2, 5)] * 6 + [D(2020, 4, 5)] * 3
    got = {r.month.month: (r.complaints, r.previous, r.mom_change) for r in bi.mom_change(fact(spark, days)).collect()}
    assert got == {1: (4, None, None), 2: (6, 4, 0.5), 4: (3, None, None)}


def test_no_days(spark):
    none = spark.createDataFrame([], "date_received date")
    assert bi.rolling_3m(none).count() == 0 and bi.mom_change(none).count() == 0


def test_rolling_has_no_range_join(spark):
    plan = bi.rolling_3m(fact(spark, [D(2020, 1, 1)]))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
