"""Conversation prefix trie: nodes against a plain Python trie, by each way of peeling."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.prefix_trie import bands, end_hashes, light, placed, prefix_trie, running, trie
from tidemark.llm.queries import rebuilt

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sequences(rows):
    """conv_id -> [(role, text)] in order; rows are (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            out.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    return {c: [x for _, x in sorted(v, key=lambda p: p[0])] for c, v in out.items()}


def brute(seqs):
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in own) if own else 1
        saved[node] = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(saved[x] for x in own)
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(children.get(k, [])), leaves[k], saved[k],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(k)).encode()).hexdigest())
                   for k, m in members.items()), key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shared(n_conv, longest, seed=5):
    """Conversations that copy a stretch of an earlier one and go on by themselves."""
    random.seed(seed)
    seqs = [[]]
    for _ in range(n_conv):
        first = random.choice(seqs)
        keep = random.randint(0, len(first))
        more = [(random.choice("us"), random.choice(["é", "bb", "c" * 9, ""])) for _ in range(random.randint(0, longest) * (random.random() < 0.8))]
        seqs.append((first[:keep] + more)[:longest])
    return [(i * 7 - 50, t * 3 - 4, r, x) for i, s in enumerate(seqs[1:]) for t, (r, x) in enumerate(s)], [i * 7 - 50 for i in range(n_conv)]


@pytest.mark.parametrize("task_turns, top", [(10**6, 8), (1, 2), (40, 1)])
def test_every_way_of_peeling(spark, task_turns, top):
    """All in one task; all by rounds but lone ones; and a mixture of the three."""
    rows, ids = shared(120, 14)
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    convs = spark.createDataFrame([(i,) for i in ids], "conv_id bigint")
    seqs = {**{i: [] for i in ids}, **sequences(rows)}
    assert got(prefix_trie(df, convs, task_turns, top)) == brute(seqs)


def test_long_conversations(spark):
    """A lone one of 700 turns, two that part after 300, and copies of one of 90."""
    rows = [(1, t, "user", f"lone {t}") for t in range(700)]
    rows += [(c, t, "user", f"pair {t}" + (f" {c}" if t >= 300 else "")) for c in (2, 3) for t in range(320)]
    rows += [(c, t, "user", "same") for c in range(10, 40) for t in range(90)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    assert got(prefix_trie(df)) == brute(sequences(rows))


def test_one_conversation_over_many_partitions(spark):
    """Places and keys of a conversation that the range partitioning cuts; order by turn, null first."""
    random.seed(2)
    rows = [(5 if random.random() < 0.7 else random.randint(0, 9), random.choice([None, *range(40)]), "r", str(random.randint(0, 5))) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = stage(placed(light(df)), "test-places")
        for c, seq in sequences(rows).items():
            want = [hashlib.md5(f"1:r{x}".encode()).digest() for _, x in seq]
            assert [bytes(r["digest"]) for r in held.filter(F.col("conv_id") == c).orderBy("place").collect()] == want
        numbers = spark.range(3_000).select((F.col("id") % 3).alias("conv_id"), "id", F.col("id").alias("x"), (F.col("id") * 977).alias("y"))
        made = running(numbers, ["id"], ["x"], ["y"], "test-running")
        for c in range(3):
            total = xor = 0
            for r in made.filter(F.col("conv_id") == c).orderBy("id").collect():
                total, xor = total + r["x"], xor ^ r["y"]
                assert (r["run_x"], r["run_y"]) == (total, xor)
        assert made.select("run_x").count() == 3_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


ODD = [(1, None, None, None), (1, 0, "", ""), (1, 0, "", ""), (2, None, "", None), (None, 0, "user", "nobody"), (3, 5, "user", "x" * 400_000),
       (4, 5, "user", "x" * 400_000), (4, 6, "a:b", "c"), (5, 0, "user", "t"), (5, 0, "assistant", "t"), (6, 2**62, "assistant", "t"), (6, -1, "user", "t"),
       (-2**63, 0, "user", "t"), (2**63 - 1, 0, "user", "t")]


def test_defined_cases_and_clashing_columns(spark):
    df = spark.createDataFrame(ODD, "conv_id bigint, turn bigint, role string, text string")
    convs = spark.createDataFrame([(77,), (None,), (1,), (77,)], "conv_id bigint")
    seqs = sequences(ODD)
    more = df.withColumns({c: F.lit(1) for c in ("place", "digest", "key", "depth", "n", "parent", "chars")})
    assert got(prefix_trie(more)) == brute(seqs)
    assert got(prefix_trie(df, convs, 1)) == brute({**seqs, 77: []})
    assert got(prefix_trie(df.limit(0))) == []
    assert got(prefix_trie(df.limit(0), convs)) == brute({77: [], 1: []})
    assert got(prefix_trie(df.filter("conv_id = 2"))) == brute({2: seqs[2]})


def test_ids_of_a_large_group(spark):
    ends = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(b"hot")).otherwise(F.col("id").cast("string").cast("binary")).alias("key"),
                                      (F.col("id") - 30_000).alias("conv_id"))
    want = hashlib.sha256(",".join(str(i - 30_000) for i in range(0, 60_000, 3)).encode()).hexdigest()
    found = end_hashes(ends.repartition(5))
    assert found.count() == 40_001 and found.filter(F.col("key") == F.lit(b"hot")).first()["ends_sha256"] == want
    assert found.filter(F.col("key") == F.lit(b"31")).first()["ends_sha256"] == hashlib.sha256(b"-29969").hexdigest()


def rebuild(seqs):
    out = {}
    for c, seq in seqs.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seqs.get(base, [])[:h] + seq[h:]
    return out


def test_rebuilt_conversations_match_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in df.collect()] + [(c, t, "user", "few") for c in (-5, -100, -101, 9_999, 12_345) for t in range(2)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert got(trie(*rebuilt(placed(light(table))))) == brute(rebuild(sequences(rows)))


def test_bands():
    assert bands(3) == [(0, 8)] and bands(8) == [(0, 8)] and bands(33) == [(32, 128), (8, 32), (0, 8)]
