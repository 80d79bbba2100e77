"""Line dedup (operator 1): overlapping three-line windows.

Every run of three consecutive lines is hashed to 128 bits. A window that occurs in several
documents stays only in the one with the smallest doc_id; within a document only its first place
stays. The line positions that later occurrences cover are merged and removed, and the rest of the
text is joined again. Windows are counted once per document and merged per key before the
shuffle; windows that only one document has are not looked at again, and a window shared by a
large part of all documents is handled by ``attach``.

Defined results: lines end at a line feed. A null text stays null with no lines; an empty text is
one empty line. Windows of three blank lines are not looked at. Texts of under three lines have
no window. Rows that share a doc_id are one document: what they repeat of each other stays. Rows
with a null doc_id come last, ordered by a hash of their text; those of equal text are one document. An empty table gives an empty result. ``line_dedup`` keeps extra
columns; its own results replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, map_arrow, raw_bytes, stage

WINDOW = 3
BATCH_ROWS = 50_000


def window_hashes(lines: list[bytes], window: int = WINDOW) -> list[bytes | None]:
    """Hash of the window at each start; None for windows of blank lines."""
    blank = [not x.strip() for x in lines]
    return [None if all(blank[i:i + window]) else xxhash.xxh3_128_digest(b"\n".join(lines[i:i + window]))
            for i in range(len(lines) - window + 1)]


def covered(hashes: list[bytes | None], elsewhere: set[bytes], window: int = WINDOW) -> list[tuple[int, int]]:
    """Merged line ranges (start, end) of windows that an earlier document has or that repeat an
    earlier place of this one."""
    seen: set[bytes] = set()
    out: list[tuple[int, int]] = []
    for i, h in enumerate(hashes):
        if h is None:
            continue
        if h in elsewhere or h in seen:
            if out and i <= out[-1][1]:
                out[-1] = out[-1][0], i + window
            else:
                out.append((i, i + window))
        seen.add(h)
    return out


def document(docs: DataFrame) -> tuple[Column, Column]:
    """Which document a row belongs to, in order: ``late`` (without a doc_id), then its doc_id or a hash of its text."""
    doc_id = F.col("doc_id").cast("bigint")
    return doc_id.isNull(), F.coalesce(doc_id, F.xxhash64(F.col("text").cast("string")))


def document_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(late, doc, hash)``: the distinct window hashes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, late, hashes = [], [], []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(late, pa.bool_()), pa.array(ids, pa.int64()), pa.array(hashes, pa.binary())], names=["late", "doc", "hash"])

        for b in batches:
            for last, doc, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), raw_bytes(b.column(2)), strict=True):
                if raw is None:
                    continue
                own = {h for h in window_hashes(raw.split(b"\n"), window) if h}
                hashes.extend(own)
                ids.extend([doc] * len(own))
                late.extend([last] * len(own))
                if len(ids) >= BATCH_ROWS:
                    yield flush()
                    ids, late, hashes = [], [], []
        yield flush()

    late, doc = document(docs)
    return map_arrow(docs.select(late.alias("late"), doc.alias("doc"), F.col("text").cast("string").alias("text")), run, "late boolean, doc bigint, hash binary")


def repeated_elsewhere(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(late, doc, hashes)``: the windows of each document that a document before it has."""
    windows = stage(document_windows(docs, window), "line-windows")
    early, late = F.when(~F.col("late"), F.col("doc")), F.when(F.col("late"), F.col("doc"))
    first = (windows.groupBy("hash").agg(F.min(early).alias("first"), F.max(early).alias("last"), F.min(late).alias("first_late"),
                                         F.max(late).alias("last_late"), F.count("*").alias("n"))
             .filter("first < last or first_late < last_late or (first is not null and first_late is not null)")
             .select("hash", "first", "first_late", "n"))
    later = (attach(windows, stage(first, "line-repeats"), "hash", "n", windows.count(), how="inner")
             .filter(F.when(F.col("late"), F.col("first").isNotNull() | (F.col("doc") > F.col("first_late"))).otherwise(F.col("doc") > F.col("first"))))
    return later.groupBy("late", "doc").agg(F.collect_set("hash").alias("hashes"))   # bounded by a document's lines


def line_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``text`` cleaned, and n_lines and n_removed (long)."""
    docs = docs.select(*(c for c in docs.columns if c not in ("n_lines", "n_removed")))
    rest = [c for c in docs.columns if c != "text"]
    late, doc = document(docs)
    repeats = repeated_elsewhere(docs, window).toDF("__late", "__doc", "__hashes")
    joined = (docs.withColumn("text", F.col("text").cast("string")).join(repeats, (late == F.col("__late")) & (doc == F.col("__doc")), "left")
              .select(F.struct(*rest).alias("rest"), "text", "__hashes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_removed = [], [], []
            for raw, hashes in zip(raw_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                lines = [] if raw is None else raw.split(b"\n")
                gone = covered(window_hashes(lines, window), set(hashes or ()), window)
                n_lines.append(len(lines))
                n_removed.append(sum(e - s for s, e in gone))
                if gone:
                    kept, at = [], 0
                    for s, e in gone:
                        kept += lines[at:s]
                        at = e
                    raw = b"\n".join(kept + lines[at:])
                texts.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).view(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())],
                                             names=["rest", "text", "n_lines", "n_removed"])

    kinds = joined.schema["rest"].dataType.simpleString()
    out = map_arrow(joined, run, f"rest {kinds}, text string, n_lines bigint, n_removed bigint")
    return out.select(*(F.col("rest")[c].alias(c) if c != "text" else F.col("text") for c in docs.columns), "n_lines", "n_removed")
