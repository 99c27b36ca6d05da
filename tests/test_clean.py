"""Edge rows for cleaning, flags, labels and de-dup."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from plaint.operators.clean import clean, dedup_by_id, dup_count
from plaint.schemas import CASE_SCHEMA

T0 = dt.datetime(2020, 1, 10, 12, 0)


def _rows(spark, rows):
    full = []
    for r in rows:
        d = {f.name: None for f in CASE_SCHEMA.fields}
        d.update(r)
        full.append(tuple(d[f.name] for f in CASE_SCHEMA.fields))
    return spark.createDataFrame(full, CASE_SCHEMA)


def test_clean_edge_rows(spark):
    df = _rows(spark, [
        dict(complaint_id=1, date_received=T0, date_sent_to_company=T0 - dt.timedelta(days=2),
             product="   ", timely=" YES ", company_response="Closed with relief",
             complaint_what_happened="XXXX"),
        dict(complaint_id=2, date_received=T0, date_sent_to_company=None, product=None, timely="no",
             company_response="Closed with monetary relief",
             complaint_what_happened="  On XX/XX/XXXX I\tpaid   XXXX dollars  "),
        dict(complaint_id=3, date_received=T0, date_sent_to_company=T0 + dt.timedelta(hours=36),
             product="\tCard\n", timely=None, company_response=" Closed with non-monetary relief ",
             complaint_what_happened=None),
    ])
    out = {r.complaint_id: r for r in clean(df).collect()}
    assert out[1].product == ""                      # blank-only -> "", not Unknown
    assert out[2].product == "Unknown"               # null -> Unknown
    assert out[3].product == "Card"                  # tabs/newlines stripped
    assert out[1].handling_days == 0.0               # sent before received -> 0
    assert out[2].handling_days is None              # missing sent date -> null
    assert out[3].handling_days == 1.5
    assert out[1].has_narrative == 0 and out[1].narrative == ""
    assert out[2].narrative == "On / / I paid dollars"
    assert out[1].timely_flag == 1 and out[2].timely_flag == 0 and out[3].timely_flag == 0
    assert out[1].relief_flag == 0                   # legacy "Closed with relief" is not relief
    assert out[3].relief_flag == 1                   # padded response tidied first
    assert out[2].is_escalated == 1 and out[1].is_escalated == 0
    assert out[3].is_escalated == 1                  # null timely counts as neither
    assert (out[1].year, out[1].month, out[1].year_month, out[1].quarter) == (2020, 1, "2020-01", "2020Q1")


def test_dedup_keeps_newest_and_collapses_null_ids(spark):
    df = _rows(spark, [
        dict(complaint_id=None, date_received=T0, complaint_what_happened="a"),
        dict(complaint_id=None, date_received=T0, complaint_what_happened="b"),
        dict(complaint_id=7, date_received=T0, complaint_what_happened="old"),
        dict(complaint_id=7, date_received=T0 + dt.timedelta(days=1), complaint_what_happened="new"),
    ])
    d = dedup_by_id(df).collect()
    assert len(d) == 2
    by = {r.complaint_id: r for r in d}
    assert by[7].complaint_what_happened == "new"
    assert by[None].complaint_what_happened == "b"   # deterministic survivor
    assert dup_count(df).collect()[0][0] == 2


@pytest.mark.parametrize("value", [" a b\t\x0b", "\r\n", "a  ", "a   ", " a ", "", "x\n\x85", "\x1ca\x1c"])
def test_strip_without_patterns(spark, value):
    """Both ends lose the six ASCII white-space characters, as the two patterns took them away."""
    from plaint.functions import text as X
    df = spark.createDataFrame([(value,)], "v string")
    old = F.regexp_replace(F.regexp_replace("v", X._LEAD_WS, ""), X._TRAIL_WS, "")
    r = df.select(X.py_strip("v").alias("new"), old.alias("old")).first()
    assert r["new"] == r["old"]


@pytest.mark.parametrize("value", ["a  b", "a\tb \n c", "   x", "a b", "\t", "a\x0b", "  "])
def test_white_space_is_collapsed(spark, value):
    from plaint.functions import text as X
    r = spark.createDataFrame([(value,)], "v string").select(F.regexp_replace("v", X.WHITESPACE_PATTERN, " ").alias("new"), F.regexp_replace("v", r"\s{2,}|[^\S ]", " ").alias("old")).first()
    assert r["new"] == r["old"]
