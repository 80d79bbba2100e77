"""WARC (operator 7): revisit resolution.

Only headers (page_id, payload digest, length) are shuffled by digest; of the pages with one
payload the one with the largest page_id is the response. Revisit records are joined to that
original, and the archives are written with fresh headers: responses with their payload, revisits
with a reference and no payload. An archive is one part file: Spark's text writer ends each record
with the two line ends that WARC asks for, compressed as a whole. Archives are read back
record by record by their Content-Length, and each response's digest is recomputed.

Defined results: a null payload is an empty one; a null url leaves out WARC-Target-URI; line ends
in urls are removed. A null page_id is never the original, unless no page of the payload has one
(then all are responses). Rows that repeat the original's page_id and payload are responses too.
An empty table gives empty archives and an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import attach, map_arrow, stage

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Payload bytes that an archive is planned to hold (each holds at least one record).
ARCHIVE_BYTES = 16 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32(column: str) -> Column:
    """Base32 of a 40-digit hexadecimal SHA-1: five digits make four characters."""
    group = f"cast(conv(substring({column}, 1 + 5 * int(i div 4), 5), 16, 10) as int)"
    return F.expr(f"array_join(transform(sequence(0, 31), i -> substring('{ALPHABET}', "
                  f"1 + (shiftright({group}, 15 - 5 * int(i % 4)) & 31), 1)), '')")


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages as records: page_id, url, payload (null for revisits), payload_bytes, payload_digest,
    record_type, refers_to."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    records = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    records = records.withColumn("__hex", F.sha1(F.col("payload").cast("binary"))).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    heads = records.select("page_id", "__hex", "payload_bytes").filter(F.col("payload_bytes") >= min_bytes)
    originals = heads.groupBy("__hex").agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1")
    found = attach(records, stage(originals, "warc-originals"), "__hex", "n", pages.count())
    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("page_id"))
    return found.select("page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes",
                        base32("__hex").alias("payload_digest"),
                        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
                        F.when(revisit, F.col("original")).alias("refers_to"))


def record_text(date: str = DATE) -> Column:
    """The record of a resolved page, without the line ends after it."""
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END))
    length = F.octet_length(head) + F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    lines = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"), field("WARC-Type", F.col("record_type")), field("WARC-Record-ID", urn("page_id")),
        field("WARC-Date", F.lit(date)), field("WARC-Target-URI", F.translate("url", "\r\n", "")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(F.col("refers_to").isNotNull(), field("WARC-Refers-To", urn("refers_to"))),
        F.when(F.col("refers_to").isNotNull(), F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"), field("Content-Length", length.cast("string")))
    return F.concat(lines, F.lit(END), head, F.coalesce("payload", F.lit("")))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write deduplicated archives of ``pages`` (page_id, url, html) into the folder ``path``."""
    size = pages.agg(F.avg(F.octet_length(F.col("html").cast("string")) + 600)).first()[0] or 600
    (resolve(pages, min_bytes).select(record_text().alias("value")).write.option("lineSep", END)
     .option("maxRecordsPerFile", max(1, int(archive_bytes // size))).option("compression", "gzip").text(path))


def parse_archive(raw: bytes) -> Iterator[tuple]:
    """Records of an archive: page_id, payload_bytes, payload_digest, record_type, refers_to, payload."""
    def number(urn: str | None) -> int | None:
        inner = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(inner) if inner not in ("", "none") else None

    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        fields = dict(x.split(": ", 1) for x in lines)
        block = raw[end + 4:end + 4 + int(fields["Content-Length"])]
        head, _, payload = block.partition(b"\r\n\r\n")
        length = next(int(x.split(b": ")[1]) for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response" and (len(payload) != length or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        at = end + 4 + len(block)
        if raw[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is not closed")
        at += 4
        yield number(fields["WARC-Record-ID"]), length, digest, kind, number(fields.get("WARC-Refers-To")), payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = [r[:5] for r in parse_archive(gzip.decompress(b.column(0)[i].as_py()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return map_arrow(files, run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")
