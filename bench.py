"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with seconds per query.

Each query is executed to completion through Spark's no-op sink (no collect
to the driver). ``scored_fact_build`` times the full clean -> sentiment ->
score pipeline that the dashboard queries read."""
from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "mis_monthly", "mis_company", "mis_summary", "industry_context",
    "dedup_by_id", "clean_narrative",
    "vader_score", "sentiment_enrich",
    "kpis", "monthly_trend", "states_metrics", "explorer_topk", "bi_measures", "risk_deciles",
    "alerts_anomalies", "alerts_hotspots",
    "mom_change", "rolling_3m",
    "tfidf", "score_linear_terms",
    "roc_auc", "pr_auc",
    "refresh_merge",
]


def main() -> None:
    from plaint.plans.registry import load_all
    from plaint.session import local_session
    from plaint.sources import fixtures as fx

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    reg = load_all()
    times: dict[str, float] = {}

    t = time.time()
    fx.scored_cases(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times["scored_fact_build"] = round(time.time() - t, 3)

    for name in HEADLINE:
        t = time.time()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)

    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
