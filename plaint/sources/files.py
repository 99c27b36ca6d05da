"""Readers: API payload JSON, bulk CSV export, column-pruned Parquet."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import API_FIELDS, BULK_COLUMN_MAP, HIT_SCHEMA
from .csv_ranges import read_records


def coerce_types(df: DataFrame) -> DataFrame:
    """Safe casts: dates -> timestamp (bad -> null), id -> long (bad -> null),
    null narrative -> '', all other fields -> string. Missing fields -> null."""
    cols = set(df.columns)

    def field(name):
        return F.col(name) if name in cols else F.lit(None).cast("string")

    out = []
    for name in API_FIELDS:
        c = field(name)
        if name == "complaint_id":
            out.append(c.cast("string").try_cast("long").alias(name))
        elif name in ("date_received", "date_sent_to_company"):
            out.append(safe_timestamp(c, df.schema[name].dataType if name in cols else None).alias(name))
        elif name == "complaint_what_happened":
            out.append(F.coalesce(c.cast("string"), F.lit("")).alias(name))
        else:
            out.append(c.cast("string").alias(name))
    extra = [F.col(c) for c in df.columns if c not in API_FIELDS]
    return df.select(*out, *extra)


def safe_timestamp(c: Column, kind: T.DataType | None = None) -> Column:
    """Text -> timestamp; unparsable or blank text -> null (ANSI-safe).

    Timestamp and date columns (``kind``) pass through. Text is trimmed, then read
    as an ISO form (sub-seconds and zones too), else as yyyyMMdd, MM/dd/yyyy or MM/dd/yy."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    s = F.trim(c.cast("string"))
    compact = s.rlike(r"^\d{8}$")
    return F.when(compact, F.try_to_timestamp(s, F.lit("yyyyMMdd"))).otherwise(F.coalesce(
        s.try_cast("timestamp"),
        F.try_to_timestamp(s, F.lit("M/d/yyyy")),
        F.try_to_timestamp(s, F.lit("M/d/yy")),
    ))


def unparsed_dates(raw: DataFrame, column: str) -> DataFrame:
    """One row: non-blank values of ``column`` and how many of them are no date."""
    c = F.col(column)
    filled = F.length(F.trim(c.cast("string"))) > 0
    return raw.agg(F.count_if(filled).alias("filled"),
                   F.count_if(filled & safe_timestamp(c, raw.schema[column].dataType).isNull()).alias("unparsed"))


CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path: str, hits: bool, multiline: bool) -> DataFrame:
    schema = T.StructType([*(HIT_SCHEMA if hits else RAW_CASE_SCHEMA).fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).json(path))


def read_cases_json(spark: SparkSession, path: str, company: str | None = None,
                    hits: bool = True, multiline: bool = True) -> DataFrame:
    """Read API payload files (a list of hits wrapping ``_source``), force the
    16-field schema and coerce types; corrupt records are left out (see
    ``count_corrupt_json``). ``company`` filters by exact match."""
    df = _json(spark, path, hits, multiline).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    df = coerce_types(df.select("_source.*") if hits else df)
    if company is not None:
        df = source_company_filter(df, company)
    return df


def count_corrupt_json(spark: SparkSession, path: str, hits: bool = True, multiline: bool = True) -> DataFrame:
    """One row: records read and how many of them are corrupt."""
    df = _json(spark, path, hits, multiline).select(F.col(CORRUPT).isNotNull().alias("bad"), F.length(F.to_json(F.struct("*"))).alias("n"))
    return df.agg(F.count("n").alias("records"), F.count_if("bad").alias("corrupt"))


def source_company_filter(df: DataFrame, company: str, column: str = "company") -> DataFrame:
    """Target-company predicate: plain equality, which Parquet scans push down."""
    return df.filter(F.col(column) == company)


def _bulk_raw(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """All text columns under their header names and the corrupt line. Every file's header must
    equal the first one's; a file with another order of columns ends the job instead of swapping them.

    ``multiline`` reads by ranges (csv_ranges), so that one file of any size is many tasks."""
    reader = spark.read.option("header", "true").option("escape", '"')
    names = reader.csv(path).columns
    if multiline:
        return read_records(spark, path, names, CORRUPT)
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]])
    return (reader.option("enforceSchema", "false").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(path))


def read_bulk_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Bulk export: header CSV, quoted multi-line text, all strings; keep only the
    mapped columns, rename them, leave out malformed lines (see
    ``count_corrupt_csv``), parse dates safely.

    With ``multiline`` one large file is read by many tasks; jobs that run often
    should still land it once as Parquet (``land_parquet``)."""
    raw = _bulk_raw(spark, path, multiline)
    raw = raw.filter(F.col(CORRUPT).isNull())
    present = [h for h in BULK_COLUMN_MAP if h in raw.columns]
    df = raw.select(*[F.col(f"`{h}`").alias(BULK_COLUMN_MAP[h]) for h in present])
    for name in set(BULK_COLUMN_MAP.values()) - set(df.columns):
        df = df.withColumn(name, F.lit(None).cast("string"))
    return df.withColumn("date_received", safe_timestamp(F.col("date_received")))


def count_corrupt_csv(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """One row: lines read and how many of them are malformed."""
    raw = _bulk_raw(spark, path, multiline)
    rows = raw.select(F.col(CORRUPT).isNotNull().alias("bad"), F.length(F.to_json(F.struct("*"))).alias("n"))
    return rows.agg(F.count("n").alias("lines"), F.count_if("bad").alias("corrupt"))


def land_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_pruned_parquet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Column-pruned read: only ``columns`` reach the scan's ReadSchema."""
    return spark.read.parquet(path).select(*columns)


def profile_source(df: DataFrame) -> DataFrame:
    """Rows, min/max received date and rows with a raw narrative."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date_received").alias("date_min"),
        F.max("date_received").alias("date_max"),
        F.count_if(F.length(F.coalesce("complaint_what_happened", F.lit(""))) > 0).alias("with_narrative"),
    )
