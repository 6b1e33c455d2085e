"""Legacy archive converter: ARC files to WARC files.

ARC (versions 1 and 2): a file starts with a ``filedesc://`` record whose
body names the version and the fields of all header lines; a record is one
header line, whose last field is the declared length, and that many bytes.
The converter reads header lines by their version's fields, cuts contents by
declared length only, and synthesises for each record a WARC identifier (a
name-based UUID of file and offset), an ISO timestamp from the 14-digit
date, a type, and the payload's SHA-1 digest.

Of records with equal payloads of ``REVISIT_BYTES`` or more, the one with
the largest page id (then record id) stays a ``response``; the others become
``revisit`` records that hold the HTTP head only and refer to it.

Files are gzipped and committed by Spark's writer, one row per record; the
record separators of both formats are the writer's line separators.  Reading
is streaming: a task holds a compressed file and one record at a time.

Defined cases: a null page text is an empty payload, a null url becomes
``unknown:``, white space in urls is percent-encoded, a null page id leaves
the header field out (and sorts lowest); repeated pages are separate
records; extra columns are ignored; an empty table gives no files' records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts_for, with_defaults, written

REVISIT_BYTES = 1000
TARGET_BYTES = 16 << 20
CAPTURED = "20240101000000"

# fixed values: the two header line forms and the WARC revisit profile
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARC_RECORD = ("record_id string, page_id bigint, url string, ip string, date string, head binary, "
              "payload binary, n_bytes bigint, sha1 string, digest string")
WARC_RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _url(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "unknown:")


def arc_line(version: int, url: str, date: str, mime: str, status: int, offset: int, name: str, length: int) -> str:
    """A header line of the given version."""
    if version == 1:
        return f"{url} 0.0.0.0 {date} {mime} {length}\n"
    return f"{url} 0.0.0.0 {date} {mime} {status} - - {offset} {name} {length}\n"


def write_arc(pages: DataFrame, out_dir: str, *, target_bytes: int = TARGET_BYTES, captured: str = CAPTURED) -> None:
    """Write pages (page_id, url, html) as ARC files, versions 1 and 2 in turn."""
    pages = with_defaults(pages, page_id="bigint", url="string", html="string")
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name, offset = 1 + part % 2, f"pages-{part:06d}.arc", 0

        def line(url: str, mime: str, content: bytes) -> bytes:
            nonlocal offset
            out = arc_line(version, url, captured, mime, 200, offset, name, len(content)).encode() + content
            offset += len(out) + 1
            return out

        rows = [line(f"filedesc://{name}", "text/plain", f"{version} 0 crawler\n{ARC_FIELDS[version]}\n".encode())]
        held = 0
        for batch in batches:
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                body = (html or "").encode()
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {len(body)}\r\n\r\n"
                rows.append(line(_url(url), "text/html", head.encode() + body))
                held += len(body)
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    spread = pages.repartition(parts_for(total, target_bytes), "page_id", "url")
    (spread.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(out_dir))


def parse_arc(stream: io.BufferedIOBase, name: str) -> Iterator[tuple[str, dict, bytes]]:
    """(record id, header fields, content) of every record after the version
    block; header fields by the version's names."""
    offset, fields = 0, None
    while line := stream.readline():
        at, offset = offset, offset + len(line)
        if line == b"\n":
            continue
        values = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        length = int(values[-1])
        content = stream.read(length)
        if len(content) != length:
            raise ValueError(f"{name}: record at {at} is shorter than declared")
        offset += length
        if fields is None:
            first, _, rest = content.partition(b"\n")
            version = int(first.split(b" ")[0])
            fields = rest.split(b"\n")[0].decode().split(" ")
            if not line.startswith(b"filedesc://") or fields != ARC_FIELDS.get(version, "").split(" "):
                raise ValueError(f"{name}: no known ARC version block")
            continue
        if len(values) != len(fields):
            raise ValueError(f"{name}: header line at {at} does not have its version's fields")
        yield str(uuid.uuid5(uuid.NAMESPACE_URL, f"{name}#{at}")), dict(zip(fields, values)), content


def http_parts(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head, its fields (lower-cased names), and body of an HTTP response."""
    head, end, body = content.partition(b"\r\n\r\n")
    pairs = (x.split(b":", 1) for x in head.split(b"\r\n")[1:] if b":" in x)
    return head + end, {k.decode().strip().lower(): v.decode("utf-8", "replace").strip() for k, v in pairs}, body


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content"))


def arc_records(spark: SparkSession, arc_dir: str, with_payload: bool) -> DataFrame:
    """The records of all ARC files; without payloads, only what identifies them."""
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in ARC_RECORD.split(", ")]
        kinds = {"page_id": pa.int64(), "head": pa.binary(), "payload": pa.binary(), "n_bytes": pa.int64()}

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kinds.get(n, pa.string())) for n, x in zip(names, zip(*rows))], names)

        rows, held = [], 0
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                for rid, f, whole in parse_arc(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), name):
                    head, fields, body = http_parts(whole)
                    sha = hashlib.sha1(body)
                    page, d = fields.get("x-page-id"), f["Archive-date"]
                    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
                    rows.append((rid, int(page) if page else None, f["URL"], f["IP-address"], date,
                                 head if with_payload else None, body if with_payload else None, len(body),
                                 sha.hexdigest(), base64.b32encode(sha.digest()).decode()))
                    held += len(whole)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
        if rows:
            yield batch_of(rows)

    return _files(spark, arc_dir).mapInArrow(parsed, ARC_RECORD)


def convert(spark: SparkSession, arc_dir: str, warc_dir: str) -> None:
    """Write the WARC files equivalent to the ARC files below ``arc_dir``."""
    known = arc_records(spark, arc_dir, with_payload=False).where(F.col("n_bytes") >= REVISIT_BYTES)
    kept = (known.groupBy("sha1").agg(F.max(F.struct("page_id", "record_id")).alias("kept"), F.count("*").alias("n"))
            .where("n > 1").select(F.col("sha1").alias("k_sha1"), F.col("kept.record_id").alias("kept_id"),
                                   F.col("kept.page_id").alias("kept_page")))
    kept = written(kept, "warc-kept")
    records = arc_records(spark, arc_dir, with_payload=True).join(kept, F.col("sha1") == F.col("k_sha1"), "left")
    revisit = F.coalesce(F.col("kept_id") != F.col("record_id"), F.lit(False)) & (F.col("n_bytes") >= REVISIT_BYTES)
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "payload"))

    def field(name: str, value, when=None):
        line = F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
        return F.coalesce(line if when is None else F.when(when, line), F.lit(""))

    uri = lambda c: F.concat(F.lit("<urn:uuid:"), F.col(c), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", uri("record_id")), field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.col("url")), field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Profile", F.lit(REVISIT_PROFILE), revisit), field("WARC-Refers-To", uri("kept_id"), revisit),
        field("X-Refers-To-Page-Id", F.col("kept_page"), revisit),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", F.octet_length("block")), F.lit("\r\n"))
    (records.withColumn("block", block).select(F.concat(header.cast("binary"), F.col("block")).cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_dir))


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record, blocks by declared length."""
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.lower()] = value.strip()
        length = int(fields["content-length"])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError("a WARC record is shorter than declared")
        yield fields, block


def read_warc(spark: SparkSession, warc_dir: str) -> DataFrame:
    """Read the WARC files back: page_id, payload_bytes, payload_digest,
    record_type, refers_to; a response's figures come from its payload."""
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in WARC_RECORD.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        number = lambda x: int(x) if x else None
        for batch in batches:
            for content in batch.column(1):
                rows = []
                for fields, block in parse_warc(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))):
                    _, http, body = http_parts(block)
                    told = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                    page, kind = number(http.get("x-page-id")), fields["warc-type"]
                    if kind == "revisit":
                        rows.append((page, int(http["content-length"]), told, kind, number(fields.get("x-refers-to-page-id"))))
                        continue
                    sha = hashlib.sha1(body).hexdigest()
                    if sha != told:
                        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                    rows.append((page, len(body), sha, kind, None))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)

    return _files(spark, warc_dir).mapInArrow(parsed, WARC_RECORD)
