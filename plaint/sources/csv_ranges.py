"""Quoted multi-line CSV read in parallel: one large file is as many tasks as it has ranges.

Whether a line begins inside a quoted field depends on all lines before it. First each range (a split of Spark's text
source) reports in which state it ends if it begins outside quotes, and if it begins inside. Following these reports
range by range gives the state in which each one begins. Then every range cuts its own lines into records; the records
that reach over a range's edge come out as pieces, which alone are shuffled and put together.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Ranges up to which their states are broadcast (a path and a number each); beyond, they are joined by a shuffle.
MAX_BROADCAST_RANGES = 50_000
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def ends_inside(line: str, inside: bool, quote: str = '"', sep: str = ",") -> bool:
    """Whether a quoted field is open at the end of ``line``: a quote opens a field only at its start, two in a row stay inside."""
    at = 0
    while True:
        if inside:
            at = line.find(quote, at)
            if at < 0:
                return True
            if line.startswith(quote, at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith(quote, at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at) + 1
        if not at:
            return False


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(value, path, range): the lines in file order within each range, read by as many tasks as Spark makes splits."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    """The batches cut where path or range changes, with that key."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, at = batch.column(1), batch.column(2)
        change = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(at[1:], at[:-1]))
        cuts = [0, *(i + 1 for i, x in enumerate(change.to_pylist()) if x), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a), (path[a].as_py(), at[a].as_py())


def range_ends(lines: DataFrame) -> DataFrame:
    """(path, range, from_outside, from_inside): the state at each range's end for both states at its beginning."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ends = None, [False, True]

        def report() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), *(pa.array([x]) for x in ends)], names=["path", "range", "from_outside", "from_inside"])

        for part, new in _stretches(batches):
            if new != key:
                if key is not None:
                    yield report()
                key, ends = new, [False, True]
            quoted = part.column(0).filter(pc.match_substring(part.column(0), '"'))  # other lines change no state
            for line in quoted.to_pylist():
                ends = [ends_inside(line, ends[0]), ends_inside(line, ends[1])] if ends[0] != ends[1] else [ends_inside(line, ends[0])] * 2
        if key is not None:
            yield report()

    return lines.mapInArrow(run, "path string, range long, from_outside boolean, from_inside boolean")


def range_states(ends: DataFrame) -> DataFrame:
    """(path, range, inside): the state at each range's beginning, a file's first being outside. One small row a range."""
    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("range")
        state, states = False, []
        for out, within in zip(rows["from_outside"], rows["from_inside"]):
            states.append(state)
            state = bool(within if state else out)
        return pd.DataFrame({"path": rows["path"], "range": rows["range"], "inside": states})

    return ends.groupBy("path").applyInPandas(follow, "path string, range long, inside boolean")


def _pieces(lines: DataFrame) -> DataFrame:
    """(path, range, kind, first, record): records that lie in one range, and the pieces of those that reach over an edge."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, kind, parts, nth = None, False, WHOLE, [], 0
        out: list[tuple] = []

        def close() -> None:
            if parts:
                out.append((*key, MIDDLE if kind == HEAD else TAIL, key[1] == 0 and nth == 0, "\n".join(parts)))

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["path", "range", "kind", "first", "record"])
            out.clear()
            return made

        for part, new in _stretches(batches):
            if new != key:
                close()
                key, parts, nth = new, [], 0
                inside = part.column(3)[0].as_py()
                kind = HEAD if inside else WHOLE
            for value in part.column(0).to_pylist():
                parts.append(value)
                if '"' in value:
                    inside = ends_inside(value, inside)
                if not inside:
                    out.append((*key, kind, key[1] == 0 and nth == 0, parts[0] if len(parts) == 1 else "\n".join(parts)))
                    kind, parts, nth = WHOLE, [], nth + 1
            yield batch_of()
        close()
        yield batch_of()

    return lines.mapInArrow(run, "path string, range long, kind int, first boolean, record string")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, first, record): the file's records as text, blank lines left out; ``first`` marks each file's first one.

    A field that is never closed reaches to the end of its file. Empty files give no row."""
    lines = lines_of(spark, path)
    ensure_checkpoint_dir(spark)
    states = range_states(range_ends(lines)).checkpoint()  # not persist(): a later read of a changed folder must not find them
    if states.count() <= MAX_BROADCAST_RANGES:
        stated = lines.join(F.broadcast(states), ["path", "range"]).select("value", "path", "range", "inside")
    else:  # the shuffle loses the order of lines, so it is numbered and restored
        numbered = lines.withColumn("line", F.monotonically_increasing_id()).join(states, ["path", "range"])
        stated = numbered.repartition("path", "range").sortWithinPartitions("path", "range", "line").select("value", "path", "range", "inside")
    cut = _pieces(stated)
    edges = cut.filter(F.col("kind") != WHOLE)
    # a record over an edge: the tail of one range, whole ranges inside it, the head of another
    order = "PARTITION BY path ORDER BY range, CASE WHEN kind = 2 THEN 1 ELSE 0 END ROWS UNBOUNDED PRECEDING"
    edges = edges.withColumn("nth", F.expr(f"count_if(kind = {TAIL}) OVER ({order})"))
    parts = F.array_sort(F.collect_list(F.struct("range", (F.col("kind") == TAIL).alias("last"), "record")))
    joined = edges.groupBy("path", "nth").agg(F.max("first").alias("first"), F.array_join(F.transform(parts, lambda x: x["record"]), "\n").alias("record"))
    out = cut.filter(F.col("kind") == WHOLE).select("path", "first", "record").unionByName(joined.select("path", "first", "record"))
    return out.withColumn("record", F.regexp_replace("record", "\r$", "")).filter(F.col("record") != "")


def read_records(spark: SparkSession, path: str, names: list[str], corrupt: str) -> DataFrame:
    """The columns ``names`` as text, and ``corrupt``: a record with another number of fields. Each file's header must hold just ``names``."""
    schema = ", ".join(f"`{n}` string" for n in [*names, corrupt])
    parsed = F.from_csv("record", F.lit(schema), {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    rows = records(spark, path).select("first", parsed.alias("r"))
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"r.`{n}`").eqNullSafe(F.lit(n))
    rows = rows.filter(F.when(F.col("first") & ~same, F.raise_error(F.lit("a file's header differs from the first file's")).cast("boolean")).otherwise(~F.col("first")))
    return rows.select("r.*")
