"""Exact dedup, line dedup and SimHash against brute force, and the defined cases."""

import hashlib

import numpy as np
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.exact_dedup import ContentTable, drop_exact_copies, exact_dedup, text_groups
from tidemark.llm.line_dedup import covered, line_dedup
from tidemark.llm.simhash import drop_near_copies, fingerprint, links, simhash_dedup

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "Same Text", "a", "x"), (2, "same text", None, "y"), (2, "same text", None, "y"), (3, None, "a", None), (4, "", "b", "z"),
    (None, "SAME TEXT", "c", "x"), (None, None, None, None), (5, "É same", "c", "x"), (6, "é same", "c", "x"),
    (7, "w " * 60_000 + "end", "c", "x"), (8, " \t\n", "c", "x"), (9, "one two", None, "x"), (10, "l1\nl2\nl3\nl4", "a", "x"),
    (11, "l0\nl1\nl2\nl3\nl5", "a", "x"), (12, "l1\nl2\nl3\nl1\nl2\nl3", "a", "x"), (13, "\n\n\n\n", "a", "x"),
]
SCHEMA = "doc_id bigint, text string, source string, keep_id string"


def odd(spark, more: str = "fp"):
    """Awkward rows, with extra columns named as results or helpers are."""
    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit("extra") for c in (more, "key", "n", "size", "digest", "component_id", "kept", "doc", "hashes")})


def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def empty(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]))


def lower(text):
    return (text or "").encode().lower()


def check_exact(df, **sizes):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    want = []
    for i, t in rows:
        g = groups[lower(t)]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), keep == i, hashlib.sha256(lower(t)).hexdigest()))
    got = [tuple(r) for r in exact_dedup(df, **sizes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_dedup_matches_brute_force(spark):
    check_exact(small(spark))
    check_exact(odd(spark))
    assert exact_dedup(empty(spark)).count() == 0


def test_exact_dedup_recurses_when_tables_are_full(spark):
    check_exact(small(spark).limit(60), table_bytes=4000, bucket_bytes=100_000)
    # nothing resident but one text for each bucket and round
    df = spark.createDataFrame([(i, f"text {i % 7}") for i in range(40)], "doc_id bigint, text string")
    assert text_groups(df, table_bytes=1, bucket_bytes=1 << 20).count() == 7


def test_content_table_compares_contents():
    t = ContentTable(1 << 20)
    same = b"\0" * 32      # one digest for all: only contents tell them apart
    for i in range(3000):
        assert t.add(same, b"%d" % (i % 1500), 1, i)
    assert len(t.contents) == 1500 and set(t.counts) == {2} and t.ids[0] == 1500


def test_drop_exact_copies_keeps_columns(spark):
    df = odd(spark)
    out = drop_exact_copies(df)
    assert out.columns == df.columns
    # one row of each text, whatever the ids: of the two rows 2 one stays, and none without a doc_id
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]


def brute_fingerprint(text):
    w = lower(text).split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, near):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                x, y = find(a), find(b)
                low[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def check_simhash(df, max_bucket):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(sorted(set(fps)), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for (i, _), f in zip(rows, fps, strict=True):
        if i is not None:
            low[comp[f]] = min(i, low.get(comp[f], i))
    want = [(i, f"{f:016x}", low.get(comp[f])) for (i, _), f in zip(rows, fps, strict=True)]
    got = [tuple(r) for r in simhash_dedup(df, max_bucket=max_bucket).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_simhash_matches_brute_force(spark):
    check_simhash(small(spark), 64)
    check_simhash(odd(spark), 64)
    assert simhash_dedup(empty(spark)).count() == 0


def test_fingerprint_of_long_text_is_not_blockwise():
    text = " ".join(f"w{i % 997}" for i in range(70_000))
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_links_lose_nothing_on_either_path(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-2**63, 2**63, 5, dtype=np.int64)
    fps = {int(x) for x in centres}
    for _ in range(400):
        x = np.uint64(centres[rng.integers(5)].view(np.uint64))
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            x ^= np.uint64(1) << np.uint64(bit)
        fps.add(int(x.view(np.int64)))
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp bigint")
    want = brute_components(fps, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    for max_bucket in (1000, 2, 1):
        edges = [(r["a"], r["b"]) for r in links(df, max_bucket=max_bucket).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in edges)
        have = set(edges) | {(b, a) for a, b in edges}
        assert brute_components(fps, lambda a, b, have=have: (a, b) in have) == want


def test_drop_near_copies_keeps_one_of_each_group(spark):
    df = odd(spark)
    out = drop_near_copies(df)
    assert out.columns == df.columns
    comp = simhash_dedup(df)
    ids = sorted(r[0] for r in comp.select("component_id").filter("component_id is not null").distinct().collect())
    assert sorted({r["doc_id"] for r in out.filter("doc_id is not null").collect()}) == ids


def brute_lines(rows):
    """Rows (doc_id, text) with distinct ids."""
    docs = {(2**63 - 1 if i is None else i): t for i, t in rows}
    windows = {}
    for i in sorted(docs):
        lines = docs[i].split("\n") if docs[i] is not None else []
        for p in range(len(lines) - 2):
            w = tuple(lines[p:p + 3])
            if any(x.encode().strip() for x in w):
                windows.setdefault(w, []).append((i, p))
    gone = {(i, p + k) for places in windows.values() for i, p in places[1:] for k in range(3)}
    out = {}
    for i, t in docs.items():
        lines = t.split("\n") if t is not None else []
        out[i] = (len(lines), sum((i, p) in gone for p in range(len(lines))),
                  None if t is None else "\n".join(x for p, x in enumerate(lines) if (i, p) not in gone))
    return out


def test_line_dedup_matches_brute_force(spark):
    for df in (small(spark), odd(spark).dropDuplicates(["doc_id"]), odd(spark, "n_lines").dropDuplicates(["doc_id"])):
        want = brute_lines([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()])
        out = line_dedup(df)
        assert out.columns == [c for c in df.columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
        got = {(2**63 - 1 if r["doc_id"] is None else r["doc_id"]): (r["n_lines"], r["n_removed"], r["text"]) for r in out.collect()}
        assert got == want
    assert line_dedup(odd(spark)).count() == len(ODD)
    assert line_dedup(empty(spark)).count() == 0


def test_lines_of_rows_without_id(spark):
    """A third of the rows has no doc_id: each is a document of its own, after all others, in the order of its hash."""
    rows = [(None if i % 3 == 0 else i, "\n".join(f"line {(i * k) % 61}" for k in range(1, 9))) for i in range(1, 400)] + [(2**63 - 1, "line 1\nline 2\nline 3")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    order = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    docs = sorted({(i is None, order[t] if i is None else i, t) for i, t in rows})
    brute = brute_lines([(n, t) for n, (_, _, t) in enumerate(docs)])
    want = sorted(((None if late else i, *brute[n]) for n, (late, i, _) in enumerate(docs)), key=repr)
    got = {(r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in line_dedup(df).collect()}
    assert sorted(got, key=repr) == sorted(set(want), key=repr)
    pooled = line_dedup(df).filter("doc_id is null").agg(F.sum("n_removed")).first()[0]
    assert pooled > 0


def test_covered_positions_are_merged():
    a, b = b"a" * 16, b"b" * 16
    assert covered([a, b, None, a, b], set()) == [(3, 7)]
    assert covered([a, b, a], {a, b}) == [(0, 5)]
