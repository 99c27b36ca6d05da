"""Calendar keys and durations."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import rnd


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c) -> Column:
    """timestamp_ntz / string / timestamp -> timestamp (UTC session)."""
    return _c(c).cast("timestamp")


def year_month(c) -> Column:
    return F.date_format(_c(c), "yyyy-MM")


def quarter_key(c) -> Column:
    """e.g. 1998Q4"""
    return F.date_format(_c(c), "yyyy'Q'q")


def calendar_columns(ts) -> dict[str, Column]:
    """year, month, year_month (yyyy-MM), quarter (yyyyQn); null stays null."""
    t = _c(ts)
    return {
        "year": F.year(t).cast("int"),
        "month": F.month(t).cast("int"),
        "year_month": year_month(t),
        "quarter": quarter_key(t),
    }


def handling_days(sent, received, digits: int = 2) -> Column:
    """(sent - received) in days, floored at 0, rounded; null when either is null."""
    d = (F.unix_micros(as_timestamp(sent)) - F.unix_micros(as_timestamp(received))) / F.lit(86_400_000_000.0)
    # greatest() skips nulls, so guard explicitly to keep a missing date null
    return F.when(d.isNotNull(), rnd(F.greatest(d, F.lit(0.0)), digits))


def month_start(c) -> Column:
    return F.trunc(_c(c).cast("date"), "month")
