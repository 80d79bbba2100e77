"""License scans (operator 3): diagonal voting.

All rolling word k-gram hashes of the documents are joined in Spark to the positions that the same
hashes have in the license templates (a fixed list, broadcast after a size check). A hit at word i of the document
and word j of the template votes for the diagonal i - j. Votes are added up per document, template
and diagonal (partial sums before the shuffle); neighbouring diagonals of a template are merged
into one region, so that inserted or missing words do not split a match. Spans are then verified on the
document's own words: base phrases must stand there exactly, notices by their longest common subsequence.

Defined results: a null text is an empty one and has no words. Votes are kept by doc_id and a hash of the text, so rows
that share a doc_id, or have none, keep their own results, and no group is larger than one text; the votes of rows alike in
both are divided by their number. Ties (regions equally alike) are settled by the label. Texts of any
length are scanned whole. Phrases that overlap or repeat all count. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, raw_bytes
from tidemark.llm.decontaminate import lcs, words

K = 2
#: Phrases that count wherever their words stand consecutively: the base labels.
PHRASES = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
#: License notices that add labels of their own.
NOTICES = {
    "apache-2.0": ["Licensed under the Apache License, Version 2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution NonCommercial 4.0 International License"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution ShareAlike 4.0 International License"],
    "cc0": ["CC0 1.0 Universal Public Domain Dedication"],
    "gpl-3.0": ["This work is licensed under the GNU General Public License, version 3",
                "either version 3 of the License, or at your option any later version"],
    "isc": ["Permission to use, copy, modify, and or distribute this software for any purpose with or without fee is hereby granted"],
    "mit": ["Released under the MIT License",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}
SIMILARITY = 0.8
#: Merged diagonals lie at most so far apart; a region is verified from this share of its template's k-grams on.
SLACK, MIN_VOTES = 3, 0.4
#: Template positions are broadcast; a larger list is refused.
MAX_POSITIONS = 200_000


def templates(phrases: dict | None = None, notices: dict | None = None) -> list[tuple[str, bool, list[bytes]]]:
    """(label, is a base phrase, words); a template's number is its place here."""
    out = [(label, True, words(p.encode())) for label, p in (phrases or PHRASES).items()]
    out += [(label, False, words(t.encode())) for label, ts in (notices or NOTICES).items() for t in ts]
    for label, _base, w in out:
        if len(w) < K:
            raise ValueError(f"{label}: a template needs {K} words")
    return out


def gram_hashes(w: list[bytes], k: int = K) -> np.ndarray:
    """32-bit hashes of the k-grams starting at each word."""
    n = len(w) - k + 1
    if n < 1:
        return np.zeros(0, np.int32)
    each = np.fromiter(map(zlib.crc32, w), np.uint64, len(w))
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out ^ each[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def template_positions(spark: SparkSession, known: list) -> DataFrame:
    rows = [(int(h), t, j) for t, (_l, _b, w) in enumerate(known) for j, h in enumerate(gram_hashes(w))]
    if len(rows) > MAX_POSITIONS:
        raise ValueError(f"{len(rows)} template positions; at most {MAX_POSITIONS} can be broadcast")
    return spark.createDataFrame(rows, "hash int, template int, j int")


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, text_hash)``: what tells texts apart where doc_ids do not."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def diagonals(docs: DataFrame, known: list) -> DataFrame:
    """``(doc_id, text_hash, template, diagonal, votes, low, high)``: votes, and first and last hit in the document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                each = [gram_hashes(words(t)) for t in raw_bytes(part.column(1))]
                ends = np.cumsum([0] + [len(x) for x in each]).astype(np.int32)
                hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(each) if each else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), hashes, part.column(2)], names=["doc_id", "hashes", "text_hash"])

    texts = keyed(docs)
    grams = (map_arrow(texts, run, "doc_id bigint, hashes array<int>, text_hash bigint")
             .select("doc_id", "text_hash", F.posexplode("hashes").alias("i", "hash")))
    hits = grams.join(F.broadcast(template_positions(docs.sparkSession, known)), "hash")
    return (hits.groupBy("doc_id", "text_hash", "template", (F.col("i") - F.col("j")).alias("diagonal"))
            .agg(F.count("*").alias("votes"), F.min("i").alias("low"), F.max("i").alias("high")))


def merge_diagonals(found: list[tuple[int, int, int, int, int]], slack: int = SLACK) -> list[tuple[int, int, int, int]]:
    """Regions (template, votes, low, high) of neighbouring diagonals whose spans meet."""
    out: list[list[int]] = []
    for t, d, votes, low, high in sorted(found):
        last = out[-1] if out else None
        if last and last[0] == t and d - last[4] <= slack and low <= last[3] + slack + K and high >= last[2] - slack - K:
            last[1] += votes
            last[2], last[3], last[4] = min(last[2], low), max(last[3], high), d
        else:
            out.append([t, votes, low, high, d])
    return [tuple(x[:4]) for x in out]


def verify(w: list[bytes], found: list[tuple[int, int, int, int, int]], known: list) -> tuple[list[tuple[int, str]], dict[str, float]]:
    """Places (word, label) of base phrases, and notices' labels with their similarity."""
    places = sorted({(d, known[t][0]) for t, d, *_ in found if known[t][1] and d >= 0 and w[d:d + len(known[t][2])] == known[t][2]})
    near: list[tuple[float, str, int, int]] = []
    for t, votes, low, high in merge_diagonals([x for x in found if not known[x[0]][1]]):
        label, _base, template = known[t]
        if votes < MIN_VOTES * (len(template) - K + 1):
            continue
        code = {x: i for i, x in enumerate(dict.fromkeys(template), 1)}
        region = w[max(0, low - SLACK):high + K + SLACK]
        got, _end = lcs(np.array([code[x] for x in template]), np.array([code.get(x, 0) for x in region]))
        if got >= SIMILARITY * len(template):
            near.append((got / len(template), label, low, high))
    # where notices overlap, the more similar ones name the span
    notices: dict[str, float] = {}
    spans: list[tuple[float, int, int]] = []
    for similarity, label, low, high in sorted(near, key=lambda x: (-x[0], x[1])):
        if all(similarity == s or high < a or low > b for s, a, b in spans):
            spans.append((similarity, low, high))
            notices[label] = max(notices.get(label, 0.0), similarity)
    return places, notices


def license_scan(docs: DataFrame, phrases: dict | None = None, notices: dict | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, notices."""
    known = templates(phrases, notices)
    per_doc = (diagonals(docs, known).groupBy(F.col("doc_id").alias("at"), F.col("text_hash").alias("at_hash"))   # bounded by a text's words
               .agg(F.collect_list(F.struct("template", "diagonal", "votes", "low", "high")).alias("found")))
    texts = keyed(docs)
    alike = (texts.groupBy(F.col("doc_id").alias("rep"), F.col("text_hash").alias("rep_hash")).agg(F.count("*").alias("rows")).filter("rows > 1"))
    per_doc = per_doc.join(alike, F.col("at").eqNullSafe(F.col("rep")) & (F.col("at_hash") == F.col("rep_hash")), "left")
    own = F.transform("found", lambda x: x.withField("votes", F.floor(x["votes"] / F.coalesce("rows", F.lit(1)))))
    joined = (texts.join(per_doc.select("at", "at_hash", own.alias("found")), F.col("doc_id").eqNullSafe(F.col("at")) & (F.col("text_hash") == F.col("at_hash")), "left")
              .select("doc_id", "text", "found"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for raw, found in zip(raw_bytes(b.column(1)), b.column(2).to_pylist(), strict=True):
                w = words(raw)
                places, near = verify(w, [tuple(x.values()) for x in found], known) if found else ([], {})
                base = sorted({label for _, label in places})
                out.append((len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                            ",".join(base), ",".join(sorted({*base, *near})), 1.0 if places else max(near.values(), default=0.0),
                            ",".join(f"{k}:{v:.3f}" for k, v in sorted(near.items()))))
            kinds = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[j] for r in out], t) for j, t in enumerate(kinds))],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"])

    return map_arrow(joined, run, "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                                  "base_labels string, labels string, score double, notices string")
