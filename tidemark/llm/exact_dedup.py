"""Exact dedup (operator 2): Grace hash deduplication.

Every task first merges the equal texts of its own input (so a hot text crosses the network once
per task, not once per copy). What is left is dealt by a hash into buckets; the shuffle files are
the first spill files. Each bucket is read into an open-addressing table that compares complete
contents. When the table has reached its byte budget, records that match no resident text are
passed on to a spill table in the shared folder, and the next round deals those by other hash
bits into buckets of their own, until nothing is passed on. A resident text is complete: all its
records are in its bucket and are matched against it; a text that was once passed on never
becomes resident later in the round.

Defined results: a null text is an empty one. Rows with a null doc_id count in group_size; the
kept id is the largest non-null one (null if there is none). Repeated rows with the kept doc_id
are all ``kept``. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, attach, keep_rows, map_arrow, numbered, raw_bytes, stage

#: Bytes of text that one open-addressing table holds before records are passed on.
TABLE_BYTES = 48 << 20
#: Bytes of text a first-round bucket is planned to get.
BUCKET_BYTES = 24 << 20
#: Bytes of one output batch.
BATCH_BYTES = 8 << 20

PARTIAL = "digest binary, content binary, n bigint, max_id bigint"


class ContentTable:
    """Open addressing with linear probing over the first 8 digest bytes; a slot matches only if
    the complete contents are equal."""

    def __init__(self, budget: int):
        self.budget, self.held = budget, 0
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.counts: list[int] = []
        self.ids: list[int | None] = []
        self.held = 0

    def _probe(self, digest: bytes, content: bytes) -> tuple[int, int]:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[8:16], "little") & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.digests[entry][:8] == digest[:8] and self.contents[entry] == content:
                return at, entry
            at = (at + 1) & mask
        return at, -1

    def add(self, digest: bytes, content: bytes, n: int, max_id: int | None) -> bool:
        """False if the text is not resident and the table is full."""
        at, entry = self._probe(digest, content)
        if entry >= 0:
            self.counts[entry] += n
            if max_id is not None and (self.ids[entry] is None or max_id > self.ids[entry]):
                self.ids[entry] = max_id
            return True
        if self.contents and self.held + len(content) > self.budget:
            return False
        self.slots[at] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.counts.append(n)
        self.ids.append(max_id)
        self.held += len(content) + 200
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        self.slots = np.full(4 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, digest in enumerate(self.digests):
            at = int.from_bytes(digest[8:16], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows (digest, content, n, max_id) as batches of bounded bytes."""
    out, held = [], 0

    def flush() -> pa.RecordBatch:
        d, c, n, i = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(d, pa.binary()), pa.array(c, pa.binary()), pa.array(n, pa.int64()), pa.array(i, pa.int64())],
            names=["digest", "content", "n", "max_id"])

    for row in rows:
        out.append(row)
        held += len(row[1] or b"") + 100
        if held >= BATCH_BYTES:
            yield flush()
            out, held = [], 0
    if out:
        yield flush()


def _combine(budget: int):
    """Per task: equal texts merged; the table is emptied whenever it is full."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            table = ContentTable(budget)

            def drain():
                yield from zip(table.digests, table.contents, table.counts, table.ids, strict=True)
                table.clear()

            for b in batches:
                for doc_id, raw in zip(b.column(0).to_pylist(), raw_bytes(b.column(1)), strict=True):
                    content = (raw or b"").lower()   # of bytes: A-Z only
                    digest = hashlib.sha256(content).digest()
                    if not table.add(digest, content, 1, doc_id):
                        yield from drain()
                        table.add(digest, content, 1, doc_id)
            yield from drain()

        yield from _batches(rows())
    return run


def _settle(budget: int):
    """Per bucket: settled groups leave without content, passed-on records with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            table = ContentTable(budget)
            for b in batches:
                for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                    if not table.add(*row):
                        yield row
            for d, n, i in zip(table.digests, table.counts, table.ids, strict=True):
                yield d, None, n, i

        yield from _batches(rows())
    return run


def text_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per distinct normalised text: ``(digest, n, max_id)``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    records = map_arrow(texts, _combine(table_bytes), PARTIAL)
    done, level = None, 0
    while True:
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")) if level == 0 else 1, -(-total // bucket_bytes), 1)
        # other bits at every level: the hash is taken over digest and level
        dealt = records.repartition(n, F.xxhash64("digest", F.lit(level)))
        spill = stage(map_arrow(dealt, _settle(table_bytes), PARTIAL), f"grace-{level}")
        settled = spill.filter("content is null").select("digest", "n", "max_id")
        done = settled if done is None else done.unionByName(settled)
        records = spill.filter("content is not null")
        total = records.agg(F.sum(F.octet_length("content") + 1)).first()[0] or 0
        if not total:
            return done
        level += 1


def exact_dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and the columns to ``carry``."""
    groups = text_groups(docs, table_bytes, bucket_bytes)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), upper, upper.lower())
    rows = stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"), *carry), "digests")
    # singles keep themselves; only repeated texts are joined
    many = groups.filter("n > 1").select(F.lower(F.hex("digest")).alias("text_sha256"), F.col("max_id").alias("keep"),
                                         F.col("n").alias("size"))
    out = attach(rows, many, "text_sha256", "size", rows.count())
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"),
                      keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256", *carry)


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text: one with the largest doc_id (rows with a null doc_id only
    where no other has the text; of rows that share text and doc_id, any one)."""
    rows = numbered(docs)
    kept = exact_dedup(rows, carry=(ROW,)).filter("kept").groupBy("text_sha256").agg(F.max(ROW).alias(ROW))
    return keep_rows(rows, kept.select(ROW), "left_semi")
