"""SimHash near-dedup (operator 10): pivot distance tables.

Fingerprints are computed per whole text. Distinct fingerprints get a table of Hamming distances
to reference fingerprints (pivots), taken block by block: d(x, p) is the sum of the distances in
four blocks of 16 bits. Two fingerprints at most two bits apart agree in at least two blocks, and
so in all block distances there: the six block pairs, each with its block distances to the
pivots, are join keys that lose no link. Pairs that share a key are discarded if any full
distance to a pivot differs by more than the bit limit (triangle inequality), and survivors are
verified on the fingerprints themselves.

A key shared by more than ``max_bucket`` distinct fingerprints is not paired: every fingerprint of
such a key is filed under itself and its 64 one-bit neighbours instead. Two fingerprints within
two bits share such a point and everything filed under one point is within two bits (at most 65
fingerprints), so this exact path is linear and links each to the smallest.

Defined results: null and empty texts have fingerprint zero and link like any other. Rows with a
null doc_id take part; component_id is the smallest non-null doc_id reachable. Repeated rows share
a fingerprint. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, attach, components, keep_rows, map_arrow, numbered, raw_bytes, stage

SHINGLE, SEED, MAX_BITS = 3, 42, 2
BLOCK_BITS = 16
N_PIVOTS = 12
MAX_BUCKET = 64
HASH_BLOCK = 1 << 16


def pivots(n: int = N_PIVOTS, seed: int = 7) -> list[int]:
    """Reference fingerprints, as signed 64-bit integers."""
    return [int(x) for x in np.random.default_rng(seed).integers(-2**63, 2**63, n, dtype=np.int64)]


def fingerprint(raw: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text: a bit is one if set in over half the hashes."""
    words = (raw or b"").lower().split()   # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)), strict=False))
    ones = np.zeros(64, np.int64)
    while block := b"".join(map(xxhash.xxh64_digest, islice(joined, HASH_BLOCK), repeat(seed))):
        ones += np.unpackbits(np.frombuffer(block, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    bits = ones * 2 > len(words) - shingle + 1
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)``: fp is the fingerprint as a signed bigint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle, seed) for t in raw_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id bigint, fp bigint")


def _distance(fp: Column, pivot: int, mask: int = -1) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(pivot)).bitwiseAND(F.lit(mask)))


def pivot_table(distinct: DataFrame, refs: list[int]) -> DataFrame:
    """``fp`` with ``full``: distances to each pivot, and ``key``: one row for each pair of blocks,
    holding the pair and its block distances to the pivots."""
    blocks = []
    for i in range(64 // BLOCK_BITS):
        mask = ((1 << BLOCK_BITS) - 1) << (i * BLOCK_BITS)
        mask -= (mask >> 63) << 64
        blocks.append(mask)
    per = {i: [_distance(F.col("fp"), p, m) for p in refs] for i, m in enumerate(blocks)}
    keys = [F.xxhash64(F.lit(10 * i + j), *per[i], *per[j]) for i, j in combinations(range(len(blocks)), 2)]
    return distinct.select("fp", F.array(*(_distance(F.col("fp"), p).cast("tinyint") for p in refs)).alias("full"),
                           F.explode(F.array(*keys)).alias("key"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET, n_pivots: int = N_PIVOTS) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that connect exactly the pairs within
    ``max_bits`` (at most 2: two of four blocks must agree)."""
    if max_bits > 2:
        raise ValueError("two of four blocks agree for at most two differing bits")
    table = stage(pivot_table(distinct, pivots(n_pivots)), "pivot-table")
    shared = table.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    keyed = stage(table.join(shared, "key"), "pivot-shared")
    left = keyed.filter(F.col("members") <= max_bucket).select("key", F.col("fp").alias("a"), F.col("full").alias("fa"))
    right = left.select("key", F.col("a").alias("b"), F.col("fa").alias("fb"))
    near = F.lit(True)
    for i in range(n_pivots):
        near = near & (F.abs(F.col("fa")[i] - F.col("fb")[i]) <= max_bits)
    pairs = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & near
                      & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b")
    hot = keyed.filter(F.col("members") > max_bucket).select("fp").distinct()
    if max_bits == 2:
        flips = [F.lit(0)] + [F.lit((1 << i) - ((1 << 64) if i == 63 else 0)) for i in range(64)]
        ball = hot.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(f.cast("bigint")) for f in flips))).alias("point"))
        near_one = ball.groupBy("point").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    else:   # 0 or 1 bits: a point is filed under its own fingerprint, and linked to that only
        flips = [F.lit((1 << i) - ((1 << 64) if i == 63 else 0)) for i in range(64)] if max_bits else []
        own = hot.select("fp", F.col("fp").alias("point"))
        flipped = hot.select("fp", F.explode(F.array(*(F.col("fp").bitwiseXOR(f.cast("bigint")) for f in flips))).alias("point")) if flips else own
        near_one = (flipped.join(own.select("point"), "point").groupBy("point")
                    .agg(F.array_union(F.collect_set("fp"), F.array("point")).alias("fps")).filter(F.size("fps") > 1))
    stars = near_one.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a <> b")
    return pairs.unionByName(stars)


def simhash_dedup(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 lowercase hex digits), component_id."""
    rows, groups = simhash_groups(docs, max_bits, shingle, max_bucket)
    out = attach(rows, groups, "fp", "n", rows.count())
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_groups(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, max_bucket: int = MAX_BUCKET) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, fp)`` per row, and per fingerprint ``(fp, n, component, component_id)``: the smallest
    fingerprint and the smallest doc_id of its component."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "distinct-fp")
    comp = stage(components(links(distinct.select("fp"), max_bits, max_bucket)), "components")
    linked = distinct.join(comp.withColumnRenamed("node", "fp"), "fp")
    lowest = linked.groupBy("component").agg(F.min("low").alias("component_id"))
    linked = linked.join(lowest, "component").select("fp", "component", "component_id")
    groups = stage(distinct.join(linked, "fp", "left")
                   .select("fp", "n", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "low").alias("component_id")), "fp-groups")
    return rows, groups


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest doc_id, of rows that share it any one, a row
    without doc_id only where no other is in the component."""
    numbers = numbered(docs)
    rows, groups = simhash_groups(numbers.select(F.col(ROW).alias("doc_id"), "text"))
    # each row's order within its component; the smallest stays, by partial aggregation
    ids = numbers.select(ROW, F.col("doc_id").cast("bigint").alias("id"))
    of = attach(rows, groups.select("fp", "n", "component"), "fp", "n", rows.count())
    kept = (of.join(ids, F.col("doc_id") == F.col(ROW)).groupBy("component")
            .agg(F.min(F.struct(F.col("id").isNull(), "id", ROW)).alias("first")).select(F.col("first")[ROW].alias(ROW)))
    return keep_rows(numbers, kept, "left_semi")
