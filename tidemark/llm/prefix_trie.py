"""Conversation prefix trie (operator 11): truncation peeling.

Each distinct sequence of a conversation's first d turns is a node of depth d; the root is the
textless one. Nodes come into being from the deepest up: at depth d the conversations that end there
meet the nodes that survived from d + 1 without their last turn, rows of equal sequences are merged,
the merged row is a node with all its figures final, and its last turn is stripped for the next
round. No node is looked for beforehand, and none is visited again.

``running`` sorts the turns once over the cluster (by conversation, turn, digest) and gives every turn
its place; a conversation may lie across any number of partitions, their totals being carried over by a
table of two rows a partition. A sequence's key is the exclusive-or of 128-bit hashes of (place, digest of
role and text), so the key without the last turn is at hand at every depth. Texts are left where they are:
only digests, lengths and keys are shuffled. Conversations with equal sequences are one item with a count.

Peeling goes by bands of depth, the widths growing by ``GROWTH``. An item of a band lies below one node at the
band's foot, and items below different feet never meet, so each foot takes the cheapest exact way:

* one item alone: its nodes follow from its running sums, without any merging;
* at most ``task_turns`` turns in the band: several feet share a task, which peels them there;
* more: a round of Spark grouping per depth, map-side combined, so that a node that a third of all
  conversations share costs a row per task.

The rounds of the top band are eight; the others are needed only where many different conversations stay
together that far.

Defined results: turns are ordered by number, null first, then by digest; a null role or text counts as
empty. Rows with a null conv_id belong to no conversation. Repeated rows are turns of their own.
Conversations that only ``conversations`` names have no turn and end at the root; without any
conversation there is no node. Texts of any length are digested whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import attach, stage

TOP, GROWTH = 8, 4
TASK_TURNS = 4096
#: Pieces of an id list end at this many characters.
PIECE_CHARS = 1 << 16
#: Key of the root: the exclusive-or of nothing.
ROOT = bytes(16)
#: What an item or node is: its sequence (depth, key, code points of its last text and of all texts) and what lies below.
SUMS = ["n", "children", "leaves", "saved"]
ITEM = ["depth", "key", "chars", "upto", "conv_id", *SUMS]
NODE = [*ITEM, "parent"]
NODE_SCHEMA = ", ".join(f"{c} {'binary' if c in ('key', 'parent') else 'bigint'}" for c in NODE)
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}


# -- the turns ------------------------------------------------------------------------------

def light(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, digest, chars)`` of each turn that belongs to a conversation."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    return (turns.filter("conv_id is not null")
            .select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("turn"),
                    F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
                    F.length(text).cast("bigint").alias("chars")))


def running(rows: DataFrame, order: list[str], sums: list[str], xors: list[str], purpose: str) -> DataFrame:
    """``rows`` plus, for each column c of ``sums`` and ``xors`` (bigint, not null), ``run_c``: its sum or
    exclusive-or over the conversation up to and including the row, in ``order``."""
    summed = [*sums, *xors]
    made = [f"run_{c}" for c in summed]
    kinds = {**{f.name: f.dataType.simpleString() for f in rows.schema.fields}, **dict.fromkeys(made, "bigint"), "part": "int", "edge": "boolean"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        head = last = None                 # (conversation, totals within this partition)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv_id").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(conv)]))
            same = last is not None and last[0] == conv[0]
            if last is not None and not same and head is None:
                head = last
            out = []
            for k, c in enumerate(summed):
                x = batch.column(c).to_numpy(zero_copy_only=False)
                before = last[1][k] if same else 0
                if c in sums:
                    total = np.cumsum(x)
                    base = (total - x)[starts]
                    base[0] -= before
                    out.append(total - base[group])
                else:
                    total = np.bitwise_xor.accumulate(x)
                    base = (total ^ x)[starts]
                    base[0] ^= before
                    out.append(total ^ base[group])
            if len(starts) > 1 and head is None:
                head = int(conv[0]), [int(x[starts[1] - 1]) for x in out]
            last = int(conv[-1]), [int(x[-1]) for x in out]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(x) for x in out), pa.array(np.full(len(conv), part, dtype=np.int32)), pa.array(np.zeros(len(conv), dtype=bool))],
                list(kinds))
        for conv_id, totals in [x for x in (head, last) if x is not None]:
            known = {"conv_id": conv_id, "part": part, "edge": True, **dict(zip(made, totals))}
            yield pa.RecordBatch.from_arrays([pa.array([known.get(c)], ARROW[kind]) for c, kind in kinds.items()], list(kinds))

    dealt = rows.repartitionByRange("conv_id", *order).sortWithinPartitions("conv_id", *order)
    held = stage(dealt.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in kinds.items())), purpose)
    # at most two rows a partition: what earlier partitions hold of the conversations at this one's ends
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = [(F.sum if c in sums else F.bit_xor)(f"run_{c}").over(earlier).alias(f"before_{c}") for c in summed]
    edges = held.filter("edge").select(F.col("conv_id").alias("e_conv"), F.col("part").alias("e_part"), *carried)
    found = held.filter("not edge").join(F.broadcast(edges), (F.col("conv_id") == F.col("e_conv")) & (F.col("part") == F.col("e_part")), "left")
    before = {c: F.coalesce(f"before_{c}", F.lit(0)) for c in summed}
    whole = [(F.col(f"run_{c}") + before[c] if c in sums else F.col(f"run_{c}").bitwiseXOR(before[c])).alias(f"run_{c}") for c in summed]
    return found.select(*rows.columns, *whole)


def placed(rows: DataFrame) -> DataFrame:
    """``light`` rows plus ``place``, the turn's number in its conversation from 0."""
    counted = running(rows.withColumn("one", F.lit(1).cast("bigint")), ["turn", "digest"], ["one"], [], "trie-places")
    return counted.select("conv_id", (F.col("run_one") - 1).alias("place"), "digest", "chars")


def paths(turns: DataFrame) -> DataFrame:
    """One row per conversation and depth: ``(conv_id, depth, key, parent, chars, upto)``, the keys of
    its first depth turns and of one turn less, the code points of the last text and of all up to it."""
    def key(a: Column, b: Column) -> Column:
        return F.unhex(F.concat(*(F.lpad(F.hex(x), 16, "0") for x in (a, b))))

    at = turns.select("conv_id", "place", "chars", F.lit(1).cast("bigint").alias("one"),
                      F.xxhash64("place", "digest").alias("x1"), F.xxhash64(F.lit("second"), "digest", "place").alias("x2"))
    keyed = running(at, ["place"], ["one", "chars"], ["x1", "x2"], "trie-paths")
    a, b = F.col("run_x1"), F.col("run_x2")
    return keyed.select("conv_id", F.col("run_one").alias("depth"), key(a, b).alias("key"),
                        key(a.bitwiseXOR(F.col("x1")), b.bitwiseXOR(F.col("x2"))).alias("parent"), "chars", F.col("run_chars").alias("upto"))


# -- peeling --------------------------------------------------------------------------------

def bands(deepest: int, top: int = TOP, growth: int = GROWTH) -> list[tuple[int, int]]:
    """Bands (foot, head] from the deepest one up to that of the root."""
    edges = [0, top]
    while edges[-1] < deepest:
        edges.append(edges[-1] * growth)
    return list(zip(edges[:-1], edges[1:]))[::-1]


def merged(rows: DataFrame) -> DataFrame:
    """Nodes of one depth from what ends or survives there (children, leaves and saved are those below)."""
    return rows.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("children").alias("children"),
        F.when(F.sum("children") == 0, 1).otherwise(F.sum("leaves")).alias("leaves"),
        (F.sum("saved") + (F.sum("n") - 1) * F.any_value("chars")).alias("saved"), F.any_value("turns").alias("turns"))


def survivors(nodes: DataFrame) -> DataFrame:
    """Items that ``nodes`` leave behind when their last turn is stripped (``chars`` is then unknown)."""
    return nodes.select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key"), F.lit(None).cast("bigint").alias("chars"),
                        (F.col("upto") - F.col("chars")).alias("upto"), "conv_id", "n", F.lit(1).cast("bigint").alias("children"), "leaves", "saved")


def peel_alone(rows: DataFrame) -> DataFrame:
    """Nodes of items that meet no other one in the band: their sums are differences of running ones."""
    at_end = F.col("depth") == F.col("end")
    return rows.select(
        "depth", "key", "chars", "upto", "conv_id", "n", F.when(at_end, F.col("children")).otherwise(1).alias("children"),
        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * (F.col("end_upto") - F.col("upto") + F.col("chars"))).alias("saved"), "parent")


def peel_task(rows: pd.DataFrame) -> pd.DataFrame:
    """Nodes of the items of a few feet. Rows are turns of items; the last one of an item carries its figures."""
    turns: dict[bytes, tuple] = {}                 # key -> (chars, upto, parent)
    levels: dict[int, dict[bytes, list]] = {}      # depth -> key -> [conv_id, n, children, leaves, saved]

    def add(depth: int, key: bytes, conv_id: int, *sums: int) -> None:
        found = levels.setdefault(depth, {}).setdefault(key, [conv_id, 0, 0, 0, 0])
        found[0] = min(found[0], conv_id)
        for i, x in enumerate(sums, 1):
            found[i] += x

    for r in rows.itertuples(index=False):
        turns[r.key] = r.chars, r.upto, r.parent
        if r.depth == r.end:
            add(r.depth, r.key, r.conv_id, r.n, r.children, r.leaves, r.saved)
    out, foot = [], int(rows["foot"].iloc[0])
    for depth in range(max(levels), foot, -1):
        for key, (conv_id, n, children, leaves, saved) in levels.pop(depth).items():
            chars, upto, parent = turns[key]
            leaves, saved = leaves if children else 1, saved + (n - 1) * chars
            out.append((depth, key, chars, upto, conv_id, n, children, leaves, saved, parent))
            if depth - 1 > foot:
                add(depth - 1, parent, conv_id, n, 1, leaves, saved)
    return pd.DataFrame(out, columns=NODE)


def peel_rounds(items: DataFrame, foot: int, head: int) -> list[DataFrame]:
    """One grouping per depth. ``items`` (staged) carry ``turns``, the band's part of their sequence,
    whose last entry is the item's node. Returns the staged nodes of each depth."""
    out, above = [], None
    for depth in range(head, foot, -1):
        cols = ["key", "chars", "conv_id", *SUMS, "turns"]
        here = items.filter(F.col("depth") == depth).select(cols)
        if above is not None:
            here = here.unionByName(above.select(
                *(F.element_at("turns", -2)[c].alias(c) for c in ("key", "chars")), "conv_id", "n", F.lit(1).cast("bigint").alias("children"),
                "leaves", "saved", F.slice("turns", F.lit(1), F.size("turns") - 1).alias("turns")))
        above = stage(merged(here), f"trie-level-{depth}")
        out.append(above.withColumn("last", F.element_at("turns", -1)).select(
            "last.depth", "key", "last.chars", "last.upto", "conv_id", *SUMS, "last.parent"))
    return out


def peel(path: DataFrame, items: DataFrame, foot: int, head: int, task_turns: int) -> DataFrame:
    """Nodes of the band (staged): ``items`` (staged) end in it or survive at its head; ``path`` has the
    turns of all conversations."""
    below = path.filter(F.col("depth") == foot + 1).select("conv_id", F.col("parent").alias("foot_key"))
    own = items.select(F.col("depth").alias("end"), F.col("upto").alias("end_upto"), "conv_id", *SUMS)
    own = stage(own.join(below, "conv_id") if foot else own.withColumn("foot_key", F.lit(ROOT)), "trie-items")
    size = F.col("end") - foot
    way = F.when(F.col("items") == 1, "alone").when(F.col("turns") <= task_turns, "task").otherwise("rounds")
    feet = stage(own.groupBy("foot_key").agg(F.count("*").alias("items"), F.sum(size).alias("turns")).withColumn("way", way), "trie-feet")
    ways = {r["way"]: r for r in feet.groupBy("way").agg(F.sum("items").alias("items"), F.sum("turns").alias("turns")).collect()}     # three rows
    own = attach(own, feet.select("foot_key", "items", "way"), "foot_key", "items", sum(r["items"] for r in ways.values()))
    band = path.filter((F.col("depth") > foot) & (F.col("depth") <= head)).select("conv_id", "depth", "key", "parent", "chars", "upto")
    rows = stage(band.join(own, "conv_id").filter(F.col("depth") <= F.col("end")), "trie-band")
    out = []
    if "alone" in ways:
        out.append(peel_alone(rows.filter("way = 'alone'")))
    if "task" in ways:
        tasks = -(-4 * ways["task"]["turns"] // task_turns)
        few = rows.filter("way = 'task'").select("depth", "key", "parent", "chars", "upto", "conv_id", *SUMS, "end", F.lit(foot).alias("foot"),
                                                 F.pmod(F.xxhash64("foot_key"), F.lit(tasks)).alias("bucket"))
        out.append(few.groupBy("bucket").applyInPandas(peel_task, NODE_SCHEMA))
    if "rounds" in ways:
        many = rows.filter("way = 'rounds'").groupBy("conv_id").agg(
            F.sort_array(F.collect_list(F.struct("depth", "key", "parent", "chars", "upto"))).alias("turns"),     # at most head - foot entries
            F.any_value("end").alias("depth"), *(F.any_value(c).alias(c) for c in SUMS))
        last = F.element_at("turns", -1)
        many = stage(many.withColumns({c: last[c] for c in ("key", "chars", "upto")}), "trie-rounds")
        out += peel_rounds(many, foot, head)
    return stage(reduce(DataFrame.unionByName, [x.select(NODE) for x in out]), "trie-nodes")


# -- the conversations that end at a node -----------------------------------------------------

def end_hashes(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of ``ends(key, conv_id)``: the SHA-256 of a key's ids in ascending order,
    comma-joined. Sorted over the cluster and joined to pieces first, so the one task that must read all
    of a key reads few rows and holds one of them."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done), (pa.binary(), pa.int64(), pa.string()))], ["key", "first", "ids"])

        key, ids, size, done = None, [], 0, []
        for b in batches:
            for k, i in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
                if ids and (k != key or size >= PIECE_CHARS):
                    done.append((key, ids[0], ",".join(map(str, ids))))
                    ids, size = [], 0
                key = k
                ids.append(i)
                size += len(str(i)) + 1
            if len(done) > 10_000:
                yield batch(done)
                done = []
        if ids:
            done.append((key, ids[0], ",".join(map(str, ids))))
        if done:
            yield batch(done)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, done = None, None, []
        for b in batches:
            for k, text in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k == key:
                    sha.update(b",")
                else:
                    if key is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                sha.update(text.encode())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done), (pa.binary(), pa.string()))], ["key", "ends_sha256"])
                done = []
        if key is not None:
            done.append((key, sha.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*done), (pa.binary(), pa.string()))], ["key", "ends_sha256"])

    joined = (ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(pieces, "key binary, first bigint, ids string"))
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends_sha256 string")


# -- the trie -------------------------------------------------------------------------------

def trie(turns: DataFrame, conversations: DataFrame, task_turns: int = TASK_TURNS, top: int = TOP) -> DataFrame:
    """The nodes of ``turns(conv_id, place, digest, chars)``, places from 0 without gaps, and of the
    turnless ones of ``conversations(conv_id)`` (distinct)."""
    path = stage(paths(turns), "trie-path")
    ends = stage(path.groupBy("conv_id").agg(F.max_by(F.struct("depth", "key", "chars", "upto"), "depth").alias("last"))
                 .select("conv_id", "last.*"), "trie-ends")
    turnless = conversations.select("conv_id").join(ends.select("conv_id"), "conv_id", "left_anti").withColumn("key", F.lit(ROOT))
    turnless = stage(turnless, "trie-turnless")
    zero = F.lit(0).cast("bigint")
    items = stage(ends.groupBy("depth", "key").agg(F.any_value("chars").alias("chars"), F.any_value("upto").alias("upto"), F.min("conv_id").alias("conv_id"),
                                                   F.count("*").alias("n")).withColumns({c: zero for c in SUMS[1:]}), "trie-ended")
    deepest = items.agg(F.max("depth")).first()[0] or 0
    nodes, left = [], None
    for foot, head in bands(deepest, top) if deepest else []:
        here = items.filter((F.col("depth") > foot) & (F.col("depth") <= head)).select(ITEM)
        nodes.append(peel(path, here if left is None else stage(here.unionByName(left), "trie-here"), foot, head, task_turns))
        left = survivors(nodes[-1].filter(F.col("depth") == foot + 1))
    at_root = turnless.select("conv_id", F.lit(1).cast("bigint").alias("n"), *(zero.alias(c) for c in SUMS[1:]))
    if left is not None:
        at_root = at_root.unionByName(left.select("conv_id", *SUMS))
    root = (at_root.agg(F.min("conv_id").alias("conv_id"), *(F.coalesce(F.sum(c), zero).alias(c) for c in SUMS)).filter("n > 0")
            .withColumn("leaves", F.greatest("leaves", F.lit(1).cast("bigint")))
            .select(zero.alias("depth"), F.lit(ROOT).alias("key"), zero.alias("chars"), zero.alias("upto"), "conv_id", *SUMS, F.lit(None).cast("binary").alias("parent")))
    all_nodes = reduce(DataFrame.unionByName, [root, *nodes])
    named = stage(all_nodes.join(end_hashes(ends.select("key", "conv_id").unionByName(turnless.select("key", "conv_id"))), "key", "left"), "trie-named")
    parents = named.filter("children > 0").select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("children").alias("siblings"))
    found = attach(named, parents, "parent", "siblings", named.count())
    return found.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, task_turns: int = TASK_TURNS, top: int = TOP) -> DataFrame:
    """The nodes of ``turns(conv_id, turn, role, text)``: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (code points that members share, summed over the
    subtree) and ends_sha256. ``(conv_id, depth)`` names a node: the first depth turns of that conversation."""
    rows = placed(light(turns))
    known = rows if conversations is None else rows.select("conv_id").unionByName(conversations.select(F.col("conv_id").cast("bigint")).filter("conv_id is not null"))
    return trie(rows, known.select("conv_id").distinct(), task_turns, top)
