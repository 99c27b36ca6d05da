"""Sinks: scored table, MIS tables, BI star-schema CSVs, dashboard JSON
sections, catalog tables and the refresh log."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_scored(df: DataFrame, path: str) -> None:
    """Overwrite the scored fact, partitioned by year (prunes year filters)."""
    df.write.mode("overwrite").partitionBy("year").parquet(path)


def write_mis(monthly: DataFrame, league: DataFrame, path: str) -> None:
    monthly.write.mode("overwrite").parquet(f"{path}/mis_industry_monthly")
    league.write.mode("overwrite").parquet(f"{path}/mis_company_benchmark")


def write_csv_star(tables: dict[str, DataFrame], path: str) -> None:
    """One CSV folder per table, header, ISO dates."""
    for name, df in tables.items():
        (df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
         .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(f"{path}/{name}"))


def write_extract_json(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON-lines folder per dashboard section (rows stay distributed)."""
    for name, df in sections.items():
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(f"{path}/{name}")


def load_warehouse(tables: dict[str, DataFrame], location: str, database: str = "default") -> None:
    """Replace each curated table in the catalog (external tables at ``location``)."""
    for name, df in tables.items():
        (df.write.mode("overwrite").option("path", f"{location}/{name}")
         .saveAsTable(f"{database}.{name}"))


def append_log(log: DataFrame, path: str) -> None:
    log.write.mode("append").parquet(path)
