import gzip
import io
import os

import duckdb
import pytest

from eventlens.llm import archives as a
from eventlens.llm.queries import ORACLES, QUERIES
from eventlens.session import scratch_path

SF = "/root/testdata/sf0.001"


def _round_trip(spark, pages):
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    a.write_arc(pages, arc, target_bytes=20_000)
    a.convert(spark, arc, warc)
    return arc, warc, a.read_warc(spark, warc).collect()


def test_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    res = con.execute(ORACLES["op5_archives"])
    cols = [d[0] for d in res.description]
    got = QUERIES["op5_archives"](spark, SF).select(*cols).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(res.fetchall(), key=repr)


def test_revisits_nulls_and_odd_payloads(spark):
    big = "bé\r\n\r\n" * 400
    rows = [(1, "http://a/ b", big), (2, "http://b", big), (9, None, big), (None, "http://c", big), (9, "http://d", big),
            (3, "http://e", None), (4, "http://f", ""), (5, "x", "short"), (6, "x", "short"),
            (7, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (8, "u", "\n\nhttp://x 0.0.0.0 1 text/html 3\nabc\n")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int")
    arc, warc, got = _round_trip(spark, df)
    import hashlib
    want = [(p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for p, _, h in rows]
    assert sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got)) == sorted((p or 0, n, d) for p, n, d in want)
    large = [r for r in got if r.payload_bytes >= 1000]
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in large if r.record_type == "revisit") == [
        (0, "revisit", 9), (1, "revisit", 9), (2, "revisit", 9), (9, "revisit", 9)]
    assert all(r.record_type == "response" and r.refers_to is None for r in got if r.payload_bytes < 1000)
    versions, ids = set(), []
    for f in os.listdir(arc.removeprefix("file:")):
        if f.startswith("part-"):
            whole = gzip.open(f"{arc.removeprefix('file:')}/{f}").read()
            versions.add(whole.split(b"\n")[1][:1])
    for f in os.listdir(warc.removeprefix("file:")):
        if f.startswith("part-"):
            ids += [h["warc-record-id"] for h, _ in a.parse_warc(gzip.open(f"{warc.removeprefix('file:')}/{f}"))]
    assert versions <= {b"1", b"2"} and len(ids) == len(set(ids)) == len(rows)


def test_versions_and_declared_lengths():
    for version in (1, 2):
        info = f"{version} 0 crawler\n{a.ARC_FIELDS[version]}\n".encode()
        body = b"HTTP/1.1 200 OK\r\n\r\nline\nline"
        blob = (a.arc_line(version, "filedesc://f", "20240101000000", "text/plain", 200, 0, "f", len(info)).encode() + info
                + b"\n" + a.arc_line(version, "http://x", "20240203040506", "text/html", 200, 9, "f", len(body)).encode() + body + b"\n")
        (rid, fields, content), = a.parse_arc(io.BytesIO(blob), "f")
        assert content == body and fields["Archive-date"] == "20240203040506" and fields["URL"] == "http://x"
        with pytest.raises(ValueError):
            list(a.parse_arc(io.BytesIO(blob[:-9]), "f"))
    with pytest.raises(ValueError):
        list(a.parse_arc(io.BytesIO(b"filedesc://f 0 0 0 3\n3 0 \n\n"), "f"))


def test_empty(spark):
    assert _round_trip(spark, spark.createDataFrame([], "page_id long, url string, html string"))[2] == []
