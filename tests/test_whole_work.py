"""Queries that did less than their whole job."""
from plaint.operators import models as ML
from plaint.plans import q_dashboard, q_pipeline
from plaint.schemas import SCORED_COLUMNS
from plaint.sources import fixtures as fx


def test_fact_lean_gives_every_row_and_column_but_the_text(spark, monkeypatch):
    rows = [tuple(f"{c} {i}" for c in SCORED_COLUMNS) for i in (1, 2, 2)] + [(None,) * len(SCORED_COLUMNS)]
    fact = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SCORED_COLUMNS))
    monkeypatch.setattr(fx, "scored_fact", lambda spark, sf: fact)
    got = q_dashboard.q_fact_lean(spark, "made")
    assert got.columns == [c for c in SCORED_COLUMNS if c != "narrative"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(v for c, v in zip(SCORED_COLUMNS, r) if c != "narrative") for r in rows), key=str)


def test_run_pipeline_trains_with_the_full_settings(spark, monkeypatch):
    """The query hands no smaller setting down to either model."""
    given = {}

    class Seen(Exception):
        pass

    def churn(train, **settings):
        given["churn"] = settings
        raise Seen

    monkeypatch.setattr(ML, "train_escalation", lambda train, **settings: given.update(escalation=settings))
    monkeypatch.setattr(ML, "train_churn", churn)
    rows = [(i, f"2000-01-0{1 + i % 9}", "a b", "Web", "Yes" if i % 2 else "No") for i in range(20)]
    cases = spark.createDataFrame(rows, "complaint_id long, date_received string, complaint_what_happened string, submitted_via string, timely string")
    text = {c: "string" for c in ("product", "sub_product", "issue", "sub_issue", "company", "state", "company_response")}
    monkeypatch.setattr(fx, "cases", lambda spark, sf: cases.selectExpr(
        "complaint_id", "CAST(date_received AS timestamp) AS date_received", "CAST(date_received AS timestamp) AS date_sent_to_company", "submitted_via", "timely", "complaint_what_happened",
        *[f"CAST('x' AS {t}) AS {c}" for c, t in text.items()], "CAST(0.5 AS double) AS score_hint_a", "CAST(0.5 AS double) AS score_hint_b"))
    try:
        q_pipeline.q_run_pipeline(spark, "made")
    except Seen:
        pass
    assert given == {"escalation": {}, "churn": {}}
