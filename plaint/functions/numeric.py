"""Numeric helpers."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rnd(c, digits: int) -> Column:
    """Round half-up at ``digits`` after first rounding at 9 places, so values
    that differ only by summation-order noise round the same way."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.round(c, 9), digits)
