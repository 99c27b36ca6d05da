"""Cleaning: de-duplication, calendar keys, narrative hygiene, flags, labels."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, labels, text
from ..schemas import TIDY_CATEGORICALS


def dedup_by_id(df: DataFrame, id_col: str = "complaint_id",
                order: list[str] | None = None) -> DataFrame:
    """Keep one row per id: the newest received, then newest sent, then the
    greatest of the remaining columns (a total order, so the survivor is
    deterministic). Null ids form one group.

    Written as ``groupBy(id).agg(max(struct(...)))`` rather than a
    ``row_number`` window: the aggregate is combined map-side, so a hot id (or
    the null id) collapses inside each task before the shuffle instead of
    landing whole in one window partition."""
    order = order or [c for c in ("date_received", "date_sent_to_company") if c in df.columns]
    rest = [c for c in df.columns if c != id_col and c not in order]
    key_cols = order + rest
    packed = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key_cols)])
    best = df.groupBy(id_col).agg(F.max(packed).alias("_best"))
    return best.select(id_col, *[F.col(f"_best.k{i}").alias(c) for i, c in enumerate(key_cols)]) \
               .select(*df.columns)


def dup_count(df: DataFrame, id_col: str = "complaint_id") -> DataFrame:
    """Number of rows a de-dup on ``id_col`` drops (null ids count as one id)."""
    return df.agg(
        (F.count(F.lit(1))
         - F.count_distinct(F.col(id_col))
         - F.max(F.col(id_col).isNull().cast("int"))).alias("duplicates_dropped"))


def clean(df: DataFrame, dedup: bool = True, id_col: str = "complaint_id") -> DataFrame:
    """De-dup, derive calendar keys, handling days, narrative, flags and label."""
    if dedup:
        df = dedup_by_id(df, id_col)
    cal = dates.calendar_columns(dates.as_timestamp("date_received"))
    narrative = text.clean_narrative("complaint_what_happened")
    derived = {
        **cal,
        "handling_days": dates.handling_days("date_sent_to_company", "date_received"),
    }
    # a generated column is worked out once a row; as a plain one its regexes would be repeated for every use and pushed filter
    others = [c for c in df.columns if c != "narrative"]
    df = df.withColumns(derived)
    df = df.select(*others, *[c for c in derived if c not in others], F.explode(F.array(narrative)).alias("narrative"))
    df = df.withColumns({
        "has_narrative": text.has_text("narrative"),
        "narrative_length": text.narrative_length("narrative"),
    })
    tidy = {c: text.fill_unknown(c) for c in TIDY_CATEGORICALS if c in df.columns}
    df = df.withColumns(tidy)
    return df.withColumns({
        "timely_flag": labels.timely_flag("timely"),
        "relief_flag": labels.relief_flag("company_response"),
        "is_escalated": labels.label_escalated("company_response", "timely"),
    })
