"""WARC archives of web captures: writing them, and assembling a capture from its records.

A capture is a request, a response (or a revisit of an equal payload) and a metadata record; the
request and the metadata name the response in WARC-Concurrent-To. Archives are written by Spark's
text writer, whose line end is the record end, and read whole by its binary reader, so any store
that Spark reaches will do. Files hold a bounded number of captures.

Defined results: a null payload is empty; a null URI or id leaves its field out, and it reads back
as null; line ends in a URI are percent-encoded; rows that repeat an id are captures of their own,
and among equal payloads with equal ids one is the response; other columns are ignored; an empty
table gives an archive without records and an empty result.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweek.llm.shared import landed, numbered

#: The record format.
VERSION = "WARC/1.1"
LINE, RECORD_END = "\r\n", "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Smaller payloads are stored each time.
LEAST_SHARED = 1000
CAPTURES_PER_FILE = 2000
CAPTURED = "2026-01-01T00:00:00Z"


def _record_id(kind: str, row: str = "row") -> Column:
    digits = F.md5(F.concat_ws("/", F.lit(kind), F.col(row).cast("string")))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def _record(kind: str, block: Column, content_type: str, *fields: Column) -> Column:
    head = F.concat(
        F.lit(f"{VERSION}{LINE}WARC-Type: {kind}{LINE}WARC-Date: {CAPTURED}{LINE}Content-Type: {content_type}{LINE}"),
        *fields,
        _field("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(head, F.lit(LINE), block)


def _records(rows: DataFrame) -> DataFrame:
    """Three records of each row of (row, id, uri, payload, digest, first): the response's row in
    ``first`` makes it a revisit. The payload of a revisit isn't stored."""
    uri = _field("WARC-Target-URI", F.regexp_replace(F.regexp_replace("uri", "\r", "%0D"), "\n", "%0A"))
    own, first = _record_id("response"), F.col("first").isNotNull()
    digest = _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}"),
        _field("Content-Length", F.octet_length("payload").cast("string")),
        F.lit(LINE),
    )
    response = _record("response", F.concat(http, "payload"), "application/http; msgtype=response", _field("WARC-Record-ID", own), uri, digest)
    revisit = _record(
        "revisit", http, "application/http; msgtype=response", _field("WARC-Record-ID", own), uri, digest,
        _field("WARC-Profile", F.lit(REVISIT_PROFILE)), _field("WARC-Refers-To", _record_id("response", "first")),
    )
    to = _field("WARC-Concurrent-To", own)
    request = _record(
        "request", F.concat(F.lit(f"GET / HTTP/1.1{LINE}"), _field("Host", F.expr("try_parse_url(uri, 'HOST')")), F.lit(LINE)),
        "application/http; msgtype=request", _field("WARC-Record-ID", _record_id("request")), to, uri,
    )
    metadata = _record("metadata", _field("page-id", F.col("id").cast("string")), "application/warc-fields", _field("WARC-Record-ID", _record_id("metadata")), to, uri)
    return rows.select(F.explode(F.array(request, F.when(first, revisit).otherwise(response), metadata)).alias("record"))


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> None:
    """Write the captures of all rows as gzip-compressed WARC files into a new folder."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    rows = numbered(rows.withColumn("digest", F.sha1(F.col("payload").cast("binary"))), "captures-to-write")
    shared = F.octet_length("payload") >= LEAST_SHARED
    # Of equal payloads the one with the largest id is stored; counted before the shuffle, so many
    # copies of one payload are one row. Only payloads that repeat are looked up: where they are few,
    # Spark sends their list to the rows instead of moving every payload.
    stored = rows.where(shared).groupBy("digest").agg(F.max(F.struct("id", "row")).alias("r"), F.count(F.lit(1)).alias("n"))
    stored = landed(stored.where("n > 1").select("digest", F.col("r.row").alias("first")), "shared-payloads")
    both = rows.join(stored, "digest", "left").withColumn("first", F.when(F.col("first") != F.col("row"), F.col("first")))
    writer = _records(both).write.option("lineSep", RECORD_END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", 3 * CAPTURES_PER_FILE).text(folder)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record of an archive."""
    at = 0
    while (at := data.find(b"WARC/1.", at)) >= 0:
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        at = end + 4 + int(fields["content-length"])
        yield fields, data[end + 4 : at]


_FIELDS = ["warc-type", "warc-record-id", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-payload-digest"]
_PARSED = "type string, record_id string, concurrent_to string, refers_to string, uri string, stated_digest string, page_id string, payload binary, payload_bytes bigint, payload_digest string"
_PARSED_ARROW = pa.schema(
    [(n, pa.string()) for n in ("type", "record_id", "concurrent_to", "refers_to", "uri", "stated_digest", "page_id")]
    + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def _parsed(fields: dict[str, str], block: bytes) -> tuple:
    """A record's row. The size and digest of a revisit are those its headers state for the payload."""
    head, page, payload, size, digest = b"", None, None, None, None
    kind, stated = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size, digest = len(payload), sha1(payload).hexdigest()
        if kind == "revisit":
            length = [x.partition(b":")[2] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
            size, digest, payload = int(length[0]) if length else None, stated, None
    elif kind == "metadata":
        named = [x.partition(b":")[2].strip() for x in block.split(b"\r\n") if x.startswith(b"page-id:")]
        page = named[0].decode() if named else None
    return (*[fields.get(f) for f in _FIELDS[:5]], stated or None, page, payload, size, digest)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row for every record of the archives in a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [_parsed(*r) for r in parse_records(gzip.decompress(content.as_py()))]
                columns = zip(*rows) if rows else [()] * len(_PARSED_ARROW)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _PARSED_ARROW)], schema=_PARSED_ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(run, _PARSED)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit, its requests and its metadata, joined
    through the concurrent-to identifiers."""
    answers = records.where("type IN ('response', 'revisit')").select(
        "record_id", F.struct("type", "uri", "refers_to", "stated_digest", "payload_digest", "payload_bytes", "payload").alias("response")
    )
    others = records.where("concurrent_to IS NOT NULL AND type IN ('request', 'metadata')").groupBy(F.col("concurrent_to").alias("record_id")).agg(
        F.collect_list(F.when(F.col("type") == "request", F.struct(F.col("record_id").alias("id"), "uri"))).alias("requests"),
        F.collect_list(F.when(F.col("type") == "metadata", F.struct(F.col("record_id").alias("id"), "page_id"))).alias("metadata"),
    )
    return answers.join(others, "record_id", "left")
