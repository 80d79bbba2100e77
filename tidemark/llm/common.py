"""Helpers shared by the operators: staged tables, skew-safe joins, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_dir

#: A group with more than one row in HEAVY_SHARE is heavy; there are at most HEAVY_SHARE of them.
HEAVY_SHARE = 1000
#: ASCII bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir`` and read it back: lineage ends
    there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def raw_bytes(column: pa.Array) -> list:
    """Values of a string column as UTF-8 bytes (None stays None), without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.view(kind).to_pylist() if not pa.types.is_binary(column.type) else column.to_pylist()


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int,
           share: int = HEAVY_SHARE, how: str = "left") -> DataFrame:
    """``rows`` ⟕ ``groups`` (or an inner join) on ``key`` (unique in groups), safe against hot keys.

    ``size`` counts the rows of a key. Keys with more than ``total / share`` rows number fewer
    than ``share``: they are joined by broadcast, which that arithmetic bounds. No key of the
    remaining, shuffled join then has more than ``total / share`` rows. Both inputs are read
    twice, so they should be staged or cheap.
    """
    hot = F.col(size) * F.lit(share) > F.lit(total)
    heavy, light = groups.filter(hot), groups.filter(~hot)
    keys = F.broadcast(heavy.select(key))
    return (rows.join(F.broadcast(heavy), key, "inner")
            .unionByName(rows.join(keys, key, "left_anti").join(light, key, how)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (long) as ``(node, component)``, where component is
    the smallest node: alternating large-star and small-star steps, each a group-min and a
    skew-safe join, until the star forest stands still. Nodes without an edge to another node
    are absent."""
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .filter("u <> v").distinct(), "edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        star = (attach(both, stage(low, "low"), "u", "n", 2 * seen[0]).filter("v > u and v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        star = stage(star, "large-star")
        low = star.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        rest = star.join(low.filter("n > 1"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = mark(e)
        if now == seen:
            break
        seen = now
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(ends.select(F.col("component").alias("node"), "component").distinct())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW = "__row"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of each row in ``ROW`` that stays the same: what is decided about a row can be carried out
    on that row, whether its doc_id is null, repeated or neither. Where the doc_ids tell the rows apart (they are
    counted), they are the numbers; else the rows are numbered and staged."""
    doc_id = F.col("doc_id").cast("bigint")
    if docs.select(doc_id.alias("id")).groupBy("id").agg(F.count("*").alias("rows")).filter("rows > 1 or id is null").isEmpty():
        return docs.withColumn(ROW, doc_id)
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def keep_rows(rows: DataFrame, decided: DataFrame, how: str) -> DataFrame:
    """Rows of ``numbered`` documents whose number is (``left_semi``) or is not (``left_anti``) in the one column of
    ``decided``, without the number."""
    found = decided.select(F.col(decided.columns[0]).alias("__only_row"))
    return rows.join(found, F.col(ROW) == F.col("__only_row"), how).drop(ROW)
