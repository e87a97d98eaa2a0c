"""Web archives (WARC) of pages, with copies replaced by revisit records.

``write_pages`` writes one response record per page.  ``deduplicate`` reads the archives' headers, shuffles them
by payload digest, joins each copy with the original it refers to, and rewrites the archives with fresh headers:
copies become revisit records without a payload.  Payloads are never shuffled: the decisions of ``REVISITS_AT_ONCE``
records at most are sent to the tasks that read those records' files, one group of files after the other, so what is sent
has a fixed bound and the number of groups grows with the archives.

Archives are written and read by Spark's own text and binary file sources, so they may lie in any store that
Spark reaches.  A file is one gzip stream.  Records are written by size, so that a file of small ones has many and one of large
ones few: at most 4,000 below 64 KB, 250 below 1 MB, and one beyond that, some 250 MB unless a page alone is larger.

Defined cases: null html is an empty payload; a page without an address has no target header; line breaks in an
address are percent-encoded; a null id is written as ``none`` and read back as null; of equal payloads the
largest id is the original, all rows that repeat it are responses, and null ids refer to it; an empty table
gives empty archives.  Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from .tiles import arrow_limits, parts

#: Records of a file by the size of their pages: (bytes below, records).
FILE_SIZES = ((1 << 16, 4_000), (1 << 20, 250), (None, 1))
REVISITS_AT_ONCE = 2_000_000
LEAST_BYTES = 1_000
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH_BYTES = 8 << 20


def _write(records: DataFrame, path: str, size: Column, classes: Sequence[tuple[int | None, int]] = FILE_SIZES) -> None:
    """One string column of records; the line separator is what ends a WARC record.  One pass per class of sizes."""
    least = 0
    for below, per_file in classes:
        chosen = records.filter((size >= least) & (F.lit(True) if below is None else size < below))
        writer = chosen.select("value").write.mode("append").option("lineSep", _END).option("compression", "gzip")
        writer.option("maxRecordsPerFile", per_file).text(path)
        least = below


def write_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Response records of all pages, from columns alone."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    url = F.replace(F.replace(F.col(url_col), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit(_END)
    )

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    page = F.concat(F.lit("<urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("none")), F.lit(">"))
    record = F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Date: {DATE}\r\n"),
        line("WARC-Record-ID", page),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(html))),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(html)).cast("string"),
        F.lit(_END),
        http,
        html,
    )
    _write(pages.select(record.alias("value"), F.octet_length(html).alias("size")), path, F.col("size"))


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, one record in memory at a time."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 20)
    while True:
        first = stream.readline()
        if not first:
            return
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {first[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").rstrip("\r\n").partition(": ")
            headers[name.lower()] = value
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != _END.encode():
            raise ValueError("a record does not end where its length says")
        yield headers, block


def page_of(value: str | None) -> int | None:
    name = (value or "")[len("<urn:page:") : -1]
    return int(name) if name and name != "none" else None


def http_parts(block: bytes) -> tuple[bytes, bytes, int]:
    """HTTP header, payload, and the payload length that the header states."""
    at = block.index(_END.encode()) + 4
    length = block[:at].lower().rpartition(b"content-length: ")[2].split(b"\r\n")[0]
    return block[:at], block[at:], int(length)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, place, page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["path", "place", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                name, content = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                rows = []
                for place, (head, block) in enumerate(records_in(content)):
                    _, payload, length = http_parts(block)
                    digest = head["warc-payload-digest"].partition(":")[2]
                    if head["warc-type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError(f"record {head['warc-record-id']}: payload and header differ")
                    rows.append((name, place, page_of(head["warc-record-id"]), length, digest, head["warc-type"], page_of(head.get("warc-refers-to"))))
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    schema = "path string, place long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return _files(spark, path).mapInArrow(run, schema)


def find_revisits(headers: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Records that repeat the payload of a larger page id, with that id and its address left to the header."""
    large = headers.filter(F.col("payload_bytes") >= least_bytes)
    originals = (
        large.groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    met = large.select("path", "place", "page_id", "payload_digest", "payload_bytes").join(originals, ["payload_digest", "payload_bytes"])
    return met.filter(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("path", "place", "refers_to")


def deduplicate(spark: SparkSession, source: str, target: str, least_bytes: int = LEAST_BYTES, at_once: int = REVISITS_AT_ONCE) -> None:
    """Rewrite the archives of ``source`` to ``target`` with revisit records in place of copies."""
    with arrow_limits(spark, 1):
        headers = materialise(read_headers(spark, source), "warc-headers")
        revisits = materialise(find_revisits(headers, least_bytes), "warc-revisits")
        groups = parts(revisits.count(), at_once)
        for group in range(groups):
            mine = F.pmod(F.xxhash64("path"), F.lit(groups)) == group
            # the names of one group's files
            paths = source if groups == 1 else [r["path"] for r in headers.filter(mine).select("path").distinct().toLocalIterator()]
            if paths:
                _rewrite(_files(spark, paths), revisits.filter(mine), target)


def _rewrite(files: DataFrame, revisits: DataFrame, target: str) -> None:
    """Append the files' records to the target.  ``revisits`` are bounded by the caller and sent to the tasks."""
    per_file = revisits.groupBy("path").agg(F.collect_list(F.struct("place", "refers_to")).alias("revisits"))
    files = files.join(F.broadcast(per_file), "path", "left").select("content", "revisits")

    def fresh(head: dict[str, str], block: bytes, original: int | None) -> bytes:
        http, payload, _ = http_parts(block)
        kind, body = ("response", http + payload) if original is None else ("revisit", http)
        lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {head['warc-date']}", f"WARC-Record-ID: {head['warc-record-id']}"]
        if "warc-target-uri" in head:
            lines.append(f"WARC-Target-URI: {head['warc-target-uri']}")
        if original is not None:
            lines += [f"WARC-Refers-To: <urn:page:{original}>", f"WARC-Profile: {_PROFILE}"]
        lines += [f"WARC-Payload-Digest: {head['warc-payload-digest']}", "Content-Type: application/http; msgtype=response"]
        return "\r\n".join([*lines, f"Content-Length: {len(body)}"]).encode("utf-8") + _END.encode() + body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                revisits = {r["place"]: r["refers_to"] for r in batch.column(1)[at].as_py() or ()}
                out, held = [], 0
                for place, (head, block) in enumerate(records_in(batch.column(0)[at].as_py())):
                    out.append(fresh(head, block, revisits.get(place)))
                    held += len(out[-1])
                    if held >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = files.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    # one pass: the files read are bounded, and so are those written by a task that read one of them
    _write(records, target, F.lit(0), [(None, FILE_SIZES[0][1])])


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write all pages, deduplicate the archives, and return the headers of the deduplicated ones."""
    spark = pages.sparkSession
    raw, deduplicated = scratch_path(spark, "warc-raw"), scratch_path(spark, "warc")
    write_pages(pages, raw, id_col, url_col, html_col)
    deduplicate(spark, raw, deduplicated, least_bytes)
    with arrow_limits(spark, 1):
        return materialise(read_headers(spark, deduplicated), "warc-clean-headers")
