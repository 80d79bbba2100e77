"""Mixing sources to target weights (operator 8): hash-threshold histograms. DataFrame code only.

Sizes are summed by source and by the leading bits of a hash of doc_id. A source's target asks for
``passes`` whole copies of it and a budget of words beyond them; the running sum over the buckets
shows where that budget ends. Buckets before that boundary are taken whole, later ones not at all,
and only the boundary bucket is summed again by the next hash bits, until the boundary falls
on one hash value. Its document is taken if the sum is then nearer the budget than without it, so a source
misses its target by at most half of one document, however long that is. The thresholds are nested: a larger budget keeps every document that a
smaller one takes. Documents are then filtered by comparing their hash with their source's
threshold; nothing is sorted.

Defined results: the size of a null text is 0. Sources are ordered by code point, null last, and a
null source is a source. A null doc_id has a hash of its own. Rows with one doc_id and source
share a hash and are taken together or not at all. An empty table gives an empty result. Extra
columns are kept by ``mix`` unless their names are those of its results, which replace them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
HASH_HEX, LEVEL_HEX = 15, 3     # 60 hash bits, 12 at a time
#: Thresholds of at most this many sources are broadcast; more are joined with salt.
MAX_BROADCAST_SOURCES = 20_000
SALTS = 64


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    parts = F.size(F.split(text, SPACES)) - text.rlike(r"\A[\x20\x09-\x0D]").cast("int") - text.rlike(r"[\x20\x09-\x0D]\z").cast("int")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0)).otherwise(parts).cast("bigint")


def hash_digits(doc_id: Column) -> Column:
    """Hash of a doc_id as ``HASH_HEX`` hexadecimal digits (their order is the hash's order)."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")), 1, HASH_HEX)


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: source, source_size, target. ``sizes`` has one row per source.

    ``share`` times all sizes is dealt by weight; a target stops at ``cap`` times its source's
    size and the excess is dealt again by weight, until no target is above its cap. Sources in
    the order of cap / weight fill up one after another, so this is a prefix of that order: with
    the prefix at its cap, the rest shares what is left in proportion to weight. (``share`` must
    not exceed ``cap``.) The two windows run over one row per source.
    """
    if share > cap:
        raise ValueError("the caps cannot hold the share")
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    number = (F.row_number().over(order) - 1) % len(weights)
    s = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (number + 1).cast("int")).cast("double"))
    s = s.withColumn("full", F.col("source_size") * F.lit(float(cap)))
    # before a source: what is capped and what weighs from there on, in the order of filling up
    fill = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    whole = Window.partitionBy()
    s = (s.withColumn("pool", F.sum("source_size").over(whole) * F.lit(float(share)))
         .withColumn("before", F.sum("full").over(fill.rowsBetween(Window.unboundedPreceding, -1)))
         .withColumn("heavier", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("rate", (F.col("pool") - F.coalesce("before", F.lit(0.0))) / F.col("heavier")))
    # the first source that does not reach its cap sets the rate of all later ones
    s = s.withColumn("level", F.min(F.when(F.col("rate") * F.col("weight") <= F.col("full"), F.struct(F.col("full") / F.col("weight"), F.col("rate")))).over(whole))
    free = F.col("full") / F.col("weight") >= F.col("level")["col1"]
    rate = F.col("level")["rate"]
    target = F.when(F.col("level").isNull() | ~free, F.col("full")).otherwise(F.least(F.col("weight") * rate, F.col("full")))
    return s.select("source", "source_size", target.alias("target"))


def thresholds(narrow: DataFrame, goal: DataFrame) -> DataFrame:
    """``goal`` with ``passes`` (whole copies of the source) and ``below``: documents whose hash
    digits are smaller are taken once more (null: none beyond the whole copies).

    ``narrow`` has source, size and digits of every document, ``goal`` source, source_size, target.
    """
    goal = goal.withColumn("passes", F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))).cast("bigint"))
    state = stage(goal.withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
                  .withColumn("prefix", F.lit("")).withColumn("open", F.col("source_size") > 0), "mix-goal")
    for level in range(LEVEL_HEX, HASH_HEX + 1, LEVEL_HEX):
        ask = state.filter("open").select(F.col("source").alias("s"), "prefix", "left")
        inside = narrow.join(_small(ask), narrow["source"].eqNullSafe(F.col("s")) & narrow["digits"].startswith(F.col("prefix")))
        sums = inside.groupBy("s", "left", F.substring("digits", 1, level).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("digits").alias("lo"), F.max("digits").alias("hi"))
        order = Window.partitionBy("s").orderBy("bucket")
        # the boundary: the first bucket that the budget does not hold whole
        sums = sums.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        edge = (sums.filter("upto > left").groupBy("s").agg(F.min_by(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), "words", "lo", "hi"), "bucket").alias("e"))
                .select(F.col("s").alias("es"), "e.*", F.lit(True).alias("found")).withColumnRenamed("left", "rest"))
        state = state.join(edge, F.col("source").eqNullSafe(F.col("es")), "left")
        # settled: no boundary (the budget holds all that is left), or one hash value in the boundary bucket
        found = F.coalesce("found", F.lit(False))
        nearer = (F.col("lo") == F.col("hi")) & (F.col("words") < 2 * F.col("rest"))     # with the boundary's rows than without
        state = stage(state.select(
            "source", "source_size", "target", "passes",
            F.when(F.col("open") & found, F.col("rest")).otherwise(F.col("left")).alias("left"),
            F.when(F.col("open") & found & nearer, F.concat("bucket", F.lit("g"))).when(F.col("open") & found, F.col("bucket")).when(F.col("open"), F.concat("prefix", F.lit("g"))).otherwise(F.col("prefix")).alias("prefix"),
            (F.col("open") & found & (F.col("lo") != F.col("hi"))).alias("open")), f"mix-level-{level}")
        if state.filter("open").isEmpty():
            break
    # a document below the boundary prefix is taken; "g" follows every hexadecimal digit
    return state.select("source", "source_size", "target", "passes", F.col("prefix").alias("below"))


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST_SOURCES else rows


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``: how often the mix takes the row."""
    own = ("size", "source_size", "target", "copies")
    docs = docs.select(*(c for c in docs.columns if c not in own))
    size, digits = word_count(F.col("text").cast("string")), hash_digits(F.col("doc_id"))
    narrow = stage(docs.select("source", size.alias("size"), digits.alias("digits")), "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    at = thresholds(narrow, targets(sizes, weights, share, cap))
    limits = at.select(F.col("source").alias("__source"), "source_size", "target", F.col("passes").alias("__passes"), F.col("below").alias("__below"))
    named = docs.withColumn("size", size).withColumn("__digits", digits)
    same = F.col("source").eqNullSafe(F.col("__source"))
    if limits.count() <= MAX_BROADCAST_SOURCES:
        out = named.join(F.broadcast(limits), same)
    else:
        salt = F.pmod(F.hash("__digits"), F.lit(SALTS))
        spread = limits.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = named.withColumn("__mine", salt).join(spread, same & (F.col("__mine") == F.col("__salt"))).drop("__mine", "__salt")
    more = (F.col("__digits") < F.col("__below")).cast("bigint")
    return out.withColumn("copies", F.col("__passes") + more).drop("__source", "__passes", "__below", "__digits")
