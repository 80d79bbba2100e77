"""Source mixing against a direct computation, and the defined cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm.mixing import hash_digits, mix, targets, word_count
from tests.llm.test_dedup import empty, odd, small


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, pool = {}, list(order), share * sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if pool * w[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: pool * w[s] / total for s in open_}
        out |= {s: cap * sizes[s] for s in over}
        pool -= sum(cap * sizes[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def brute_mix(rows):
    """(doc_id, size, source_size, target, copies) for rows (doc_id, text, source)."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = {}
    for (_, _, s), n in zip(rows, size, strict=True):
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    out = []
    for s in sizes:
        mine = sorted((hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], n, i)
                      for (i, _, x), n in zip(rows, size, strict=True) if x == s)
        passes = int(target[s] // sizes[s]) if sizes[s] else 0
        left = target[s] - passes * sizes[s]
        for h, n, i in mine:
            upto = sum(m for g, m, _ in mine if g <= h)
            before = sum(m for g, m, _ in mine if g < h)
            nearer = before <= left and abs(upto - left) < abs(before - left)      # the boundary's row, if the sum is then nearer
            out.append((i, n, sizes[s], target[s], n * (passes + (upto <= left or nearer))))
    return out


def check(df):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in df.select("doc_id", "text", "source").collect()]
    got = [tuple(r) for r in mix(df).select("doc_id", "size", "source_size", "target", F.col("size") * F.col("copies")).collect()]
    key = lambda r: (repr(r[0]), r[1], r[2], r[4])
    for g, w in zip(sorted(got, key=key), sorted(brute_mix(rows), key=key), strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-9)
    return rows, got


def test_mix_matches_direct_computation(spark):
    rows, got = check(small(spark))
    by = {s: [0, 0.0, 0] for _, _, s in rows}
    source = {i: s for i, _, s in rows}
    for i, n, _size, target, taken in got:
        by[source[i]][0] += taken
        by[source[i]][1] = target
        by[source[i]][2] = max(by[source[i]][2], n)
        assert taken <= 2 * n
    assert all(abs(taken - t) <= largest / 2 for taken, t, largest in by.values())


def test_mix_defined_cases(spark):
    df = odd(spark, "copies")
    check(df)
    out = mix(df)
    assert out.columns == [c for c in df.columns if c not in ("size", "copies")] + ["size", "source_size", "target", "copies"]
    assert mix(empty(spark)).count() == 0
    first = sorted(mix(df).select("doc_id", "source", "copies").collect(), key=repr)
    assert first == sorted(mix(df.repartition(7)).select("doc_id", "source", "copies").collect(), key=repr)


def test_a_larger_budget_keeps_what_a_smaller_takes(spark):
    docs = small(spark).select("doc_id", "text", "source")
    less = {r["doc_id"] for r in mix(docs, share=0.4).filter("copies > 0").collect()}
    more = {r["doc_id"] for r in mix(docs, share=0.8).filter("copies > 0").collect()}
    assert less < more


def test_targets_fill_up_one_after_another(spark):
    sizes = {"a": 10, "b": 10_000, "c": 3, "d": 0, None: 500}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_word_count(spark):
    texts = ["", None, " ", "a", " a", "a ", "a  b", "\ta\nb\r\n", "\x0b\x0c", "a b", "é ü"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    got = [r[0] for r in df.orderBy("i").select(word_count(F.col("text"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_no_python_in_the_plan(spark):
    plan = mix(small(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert spark.range(1).select(hash_digits(F.col("id"))).first()[0] == hashlib.md5(b"0").hexdigest()[:15]


def test_a_very_long_document_at_the_boundary(spark):
    """Its source comes as near its target as whole documents allow: within half of it, by code and by hand."""
    for seed in range(6):
        df = spark.createDataFrame([(100 * seed + i, "w " * (4_000 if i == 0 else 10), "abc"[i % 3]) for i in range(60)], "doc_id bigint, text string, source string")
        rows, got = check(df)
        taken = {}
        for i, _n, _size, target, words in got:
            s = "abc"[(i - 100 * seed) % 3]
            taken[s] = taken.get(s, (0, target))[0] + words, target
        assert all(abs(t - target) <= (2_000 if s == "a" else 5) for s, (t, target) in taken.items())
