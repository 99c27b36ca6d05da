"""WARC archives: a writer with identical-payload revisits and a salvage reader.

Archives are gzip members, one for each record. The reader trusts nothing: a record counts only if its member
decompresses, its version line, headers and lengths agree and its digests are right. After a failed check it searches
for the next valid member (or, in a plain archive, version line), so later records are recovered; bytes that belong to
no valid record are reported as quarantined gaps. Large archives are read in byte ranges by many tasks.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import fresh_folder, qualified, slices, small_batches, store, table, written

VERSION = b"WARC/1.1"
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
#: Bytes of an archive that one task starts to read records in.
RANGE_BYTES = 32 << 20
#: Read ahead of a record's start, doubled until the record is whole.
STEP = 1 << 20
FIRST_LOOK = 1 << 16


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{payload_digest}')}>"


def record(page_id: int | None, url: str | None, payload_digest: str, size: int, payload: bytes = b"", first: int | None = None) -> bytes:
    """A response with its payload, or if ``first`` is given a revisit of that page's response: its HTTP header, which tells the payload's length, without the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size + payload
    head = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", record_id(page_id, payload_digest)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", " ".join(url.split())))  # a header value stands on one line
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{payload_digest}"), ("WARC-Block-Digest", f"sha1:{digest(block)}")]
    if first is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(first, payload_digest)), ("X-Refers-To-Page-ID", str(first))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    payload: bytes
    http_length: int | None


class View:
    """Bytes of a file from any offset on, read in steps; ``limit`` is the file's end."""

    def __init__(self, file, limit: int):
        self.file, self.limit, self.base, self.data = file, limit, 0, b""

    def get(self, start: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``start``."""
        end = min(self.limit, start + size)
        if start < self.base or end > self.base + len(self.data):
            self.base = start
            self.data = self.file.read_at(max(0, min(self.limit, max(end, start + STEP)) - start), start)
        return self.data[start - self.base: end - self.base]


def parse_record(data: bytes, digests: bool = True) -> tuple[dict[str, str], bytes, int | None, int] | str | None:
    """(headers, payload, length told by the HTTP header, bytes used) of the record at the start of ``data``; what is wrong with it; None if it goes on behind ``data``."""
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        return None if len(data) < 10 and data[:7] == b"WARC/1."[: len(data)] else "no version line"
    split = data.find(b"\r\n\r\n")
    if split < 0:
        return "endless headers" if len(data) > 1 << 20 else None
    headers: dict[str, str] = {}
    for line in data[:split].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "bad header line"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    size = headers.get("content-length", "")
    if not size.isdigit():
        return "no length"
    at, end = split + 4, split + 4 + int(size)
    if len(data) < end + 4:
        return None
    if data[end: end + 4] != b"\r\n\r\n":
        return "no record end"
    block = data[at:end]
    want = headers.get("warc-block-digest")
    if digests and want and want != f"sha1:{digest(block)}":
        return "wrong block digest"
    http = block.find(b"\r\n\r\n") + 4 if headers.get("content-type", "").startswith("application/http") else 0
    payload = block[http:]
    told = re.search(rb"(?i)\r\ncontent-length: *(\d+)\r\n", block[:http])
    want = headers.get("warc-payload-digest")
    if digests and want and headers.get("warc-type") != "revisit" and want != f"sha1:{digest(payload)}":
        return "wrong payload digest"
    return headers, payload, int(told[1]) if told else None, end + 4


def _at(view: View, start: int) -> Record | str:
    """The valid record that starts at ``start``, or what is wrong."""
    size = FIRST_LOOK
    while True:
        data = view.get(start, size)
        whole = start + len(data) >= view.limit
        if data.startswith(MAGIC):
            z = zlib.decompressobj(31)
            try:
                plain = z.decompress(data)
            except zlib.error:
                return "damaged member"
            if z.eof:
                got = parse_record(plain)
                if isinstance(got, tuple) and got[3] == len(plain):
                    return Record(start, start + len(data) - len(z.unused_data), *got[:3])
                return got if isinstance(got, str) else "member and record differ in length"
            if plain[:7] != b"WARC/1."[: len(plain[:7])]:
                return "no version line"
        else:
            got = parse_record(data)
            if isinstance(got, tuple):
                return Record(start, start + got[3], *got[:3])
            if isinstance(got, str):
                return got
        if whole:
            return "cut off"
        size *= 2


def salvage(file, size: int, start: int, stop: int) -> Iterator[Record | tuple[int, str]]:
    """The valid records that start in [start, stop) of a file of ``size`` bytes, and (offset, reason) of each failed check."""
    view = View(file, size)
    at = start
    while at < min(stop, size):
        got = _at(view, at)
        if isinstance(got, Record):
            yield got
            at = got.end
            continue
        yield at, got
        at += 1
        while at < min(stop, size):  # the next place that may start a member or a record
            data = view.get(at, STEP)
            hits = [x for x in (data.find(MAGIC), data.find(b"WARC/1.")) if x >= 0]
            if hits:
                at += min(hits)
                break
            at += max(1, len(data) - 6)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """A record for each row of ``pages`` (page_id, url, html); returns the archives that count: (path, bytes, records).

    Null html is an empty payload. Of equal payloads the rows with the smallest non-null page_id become responses (all
    of them, if that id repeats), others revisits; without any non-null id all are responses. Payloads are compressed
    before the shuffle that brings them to their group's first id, a join that splits hot groups. Each task attempt
    writes a file of its own; the returned table was written from the attempts that Spark took."""
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "utf-8"), F.lit(b""))
    rows = small_batches(pages).select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("page_id", "url", "payload", F.unhex(F.sha1("payload")).alias("sha"))
    first = keyed.groupBy("sha").agg(F.min("page_id").alias("first_id"))

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "payload"):
            made = [gzip_member(record(k, u, base64.b32encode(s).decode(), len(p), p)) for k, u, p, s in zip(*(batch.column(i).to_pylist() for i in range(4)))]
            sizes = pa.array([len(p) for p in batch.column(2).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(made, pa.binary()), batch.column(3), sizes], names=["page_id", "url", "member", "sha", "size"])

    members = keyed.mapInArrow(prepare, "page_id long, url string, member binary, sha binary, size long")
    joined = members.join(first, "sha")
    repeat = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    ready = joined.select("page_id", "url", F.when(~repeat, F.col("member")).alias("member"), "sha", "size", F.when(repeat, F.col("first_id")).alias("first_id"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, place = store(folder)
        name = f"archive-{uuid.uuid4().hex}.warc.gz"
        out, size, count = None, 0, 0
        for batch in batches:
            for k, u, m, s, n, f in zip(*(c.to_pylist() for c in batch.columns)):
                out = out or fs.open_output_stream(f"{place}/{name}", compression=None)
                if m is None:
                    m = gzip_member(record(k, u, base64.b32encode(s).decode(), n, first=f))
                out.write(m)
                size, count = size + len(m), count + 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size], "records": [count]}, schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))

    done = ready.mapInArrow(write, "path string, bytes long, records long")
    done.write.parquet(f"{folder}/archives")
    return spark.read.parquet(f"{folder}/archives")


def archives_in(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the archives under ``path``, to be read by read_archives()."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("bytes"))


FOUND = "path string, start long, end long, page_id long, url string, record_type string, payload_digest string, refers_to long, http_length long, payload binary, reason string"


def scan_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """What the salvage reader finds in the archives (path, bytes): a row for each valid record, and one with a reason for each failed check."""
    ranges = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("bytes") / range_bytes).cast("int") - 1))
    todo = archives.select("path", "bytes", F.explode(ranges).alias("k")).select("path", "bytes", (F.col("k").cast("long") * range_bytes).alias("from"))
    todo = todo.repartition(max(1, todo.count()), "path", "from")

    def rows_of(path: str, size: int, start: int) -> Iterator[tuple]:
        fs, place = store(path)
        with fs.open_input_file(place) as f:
            for got in salvage(f, size, start, start + range_bytes):
                if not isinstance(got, Record):
                    yield (path, got[0], *[None] * 8, got[1])
                    continue
                h = got.headers
                page, refers = (int(x) if x.lstrip("-").isdigit() else None for x in (h.get("x-page-id", ""), h.get("x-refers-to-page-id", "")))
                yield path, got.start, got.end, page, h.get("warc-target-uri"), h.get("warc-type"), h.get("warc-payload-digest", "").removeprefix("sha1:"), refers, got.http_length, got.payload, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        schema = pa.schema([(n, kinds[k]) for n, k in (x.split() for x in FOUND.split(", "))])
        for batch in batches:
            for todo in batch.to_pylist():
                out, held = [], 0
                for row in rows_of(todo["path"], todo["bytes"], todo["from"]):
                    out.append(row)
                    held += len(row[9] or b"") + 1000
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return todo.mapInArrow(run, FOUND)


def settle(found: DataFrame, archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, gaps) from scan_archives(): the valid records, and the quarantined bytes (path, start, end, reason) that belong to none.

    A record inside another valid one, as a range that begins there may find, doesn't count. A gap's reason is its first
    failed check. ``found`` is used several times: write it first (without the payload if that isn't needed)."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    marked = found.withColumn("before", F.coalesce(F.max("end").over(before), F.lit(0)))
    records = marked.filter(F.col("end").isNotNull() & (F.col("start") >= F.col("before"))).drop("before", "reason")
    spans = marked.filter(F.col("start") >= F.col("before"))
    gaps = spans.filter(F.col("end").isNotNull() & (F.col("start") > F.col("before"))).select("path", F.col("before").alias("start"), F.col("start").alias("end"))
    last = spans.groupBy("path").agg(F.max("end").alias("start"))
    tail = archives.join(last, "path", "left").select("path", F.coalesce("start", F.lit(0)).alias("start"), F.col("bytes").alias("end")).filter("start < end")
    why = spans.filter(F.col("reason").isNotNull()).groupBy("path", F.col("before").alias("start")).agg(F.min_by("reason", F.col("start")).alias("reason"))
    return records, gaps.union(tail).join(why, ["path", "start"], "left").select("path", "start", "end", F.coalesce("reason", F.lit("no record")).alias("reason"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for every page, read back from the archives by the salvage reader."""
    archives = write_archives(table(spark, sf_dir, "pages"), fresh_folder(spark, "warc"))
    found = scan_archives(archives).withColumn("payload", F.length("payload"))
    records, _ = settle(written(found, "found"), archives)
    revisit = F.col("record_type") == "revisit"
    return records.select("page_id", F.when(revisit, F.col("http_length")).otherwise(F.col("payload")).cast("long").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
