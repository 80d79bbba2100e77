"""WARC archives: exact round trip, revisits against brute force, and the defined cases."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import parse_archive, read_archives, write_archives
from tidemark.session import fresh_dir

ROWS = [
    (1, "http://a/\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "a\r\n\r\nWARC/1.1\r\n\r\nb"),
    (6, "u", "é" * 70_000), (7, "ü", "é" * 70_000), (8, "u", "alone"), (None, "u", "<p>one</p>"), (None, "u", "nobody"), (None, "u", "nobody"), (9, "u", "twice"), (9, "u", "twice"),
]


def brute(rows, min_bytes=0):
    pages = [(i, (h or "").encode()) for i, _, h in rows]
    top = {}
    for i, p in pages:
        if i is not None and len(p) >= min_bytes:
            top[p] = max(i, top.get(p, i))
    out = []
    for i, p in pages:
        first = top.get(p, i)
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=repr)


def check(spark, df, **options):
    rows = [(r["page_id"], r["url"], r["html"]) for r in df.select("page_id", "url", "html").collect()]
    path = fresh_dir(spark, "test-warc")
    write_archives(df, path, **options)
    assert sorted((tuple(r) for r in read_archives(spark, path).collect()), key=repr) == brute(rows, options.get("min_bytes", 0))
    return rows, path


def test_pages_match_brute_force(spark):
    check(spark, spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_defined_cases_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    more = df.withColumns({c: F.lit("x") for c in ("payload", "original", "n", "__hex", "record_type", "value")})
    check(spark, more)
    check(spark, more, min_bytes=10)
    check(spark, more, archive_bytes=1)
    check(spark, df.limit(0))


def test_payloads_come_back_byte_by_byte(spark):
    df = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    rows, path = check(spark, df, archive_bytes=100)
    payloads = {(i, (h or "").encode()) for i, _, h in rows}
    files = list(Path(path.removeprefix("file:")).glob("part-*"))
    found = [r for f in files for r in parse_archive(gzip.decompress(f.read_bytes()))]
    assert len(files) > 3 and len(found) == len(rows)
    for page_id, length, _digest, kind, refers, payload in found:
        assert (page_id, payload) in payloads if kind == "response" else payload == b"" and refers is not None
        assert kind == "revisit" or length == len(payload)


def test_damage_is_found():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Payload-Digest: sha1:"
            + base64.b32encode(hashlib.sha1(b"x").digest()) + b"\r\nContent-Length: 40\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\n")
    assert [r[5] for r in parse_archive(good.replace(b"40\r\n", b"39\r\n") + b"x\r\n\r\n")] == [b"x"]
    for bad in (good.replace(b"40\r\n", b"39\r\n") + b"y\r\n\r\n", b"WARC/9\r\n\r\n"):
        with pytest.raises(ValueError):
            list(parse_archive(bad))
