"""Registry of named queries: Spark callable + (optional) DuckDB oracle SQL."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    sql: str | None
    doc: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the equivalent DuckDB SQL over the driver's table views; None
    for operators that are not SQL-expressible (fitted models, side effects)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules registers their queries
    from . import (q_alerts, q_bi, q_clean, q_dashboard, q_mis, q_ml, q_pipeline,  # noqa: F401
                   q_refresh, q_sentiment, q_sinks, q_stream, q_text)
    return REGISTRY
