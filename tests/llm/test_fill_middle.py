"""Fill-in-the-middle: cuts, forms and restored texts against slicing of whole texts."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm.fill_middle import Cutter, Markers, descend, fenwick, fill_middle, restore

TEXTS = st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab <PSM>é漢😀\n", max_size=200)


def plain_cuts(text: str, pattern: str | None) -> list[int]:
    """Code point where the text after u units begins, for every u."""
    if pattern is None:
        return list(range(len(text) + 1))
    starts = [m.start() for m in re.finditer(pattern, text) if m.end() > m.start()]
    return [0, *starts[1:], len(text)] if starts else [0]


def brute(doc_id, text, pattern=None, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    cuts = plain_cuts(text, pattern)
    n = len(cuts) - 1
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in marks) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    u, v = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = (len(text) if n == 0 and w else cuts[w] for w in (u, v))
    if n == 0:
        a = b = 0
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = marks[1] + s + marks[0] + p + marks[2] + m if form == "spm" else marks[0] + p + marks[1] + s + marks[2] + m
    return n, form, a, b - a, out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=40))
def test_descent_finds_the_block_of_a_unit(counts):
    counts = np.array(counts, dtype=np.int64).reshape(-1, 2)
    tree = fenwick(counts)
    owners = [b for b, (units, _) in enumerate(counts) for _ in range(units)]
    for rank, block in enumerate(owners):
        assert descend(tree, rank) == (block, counts[:block, 0].sum(), counts[:block, 1].sum())


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([None, r"\S+\s*", r"[^\n]*\n?"]), st.sampled_from([1, 3, 64]))
def test_cuts_match_slices(text, pattern, block):
    cutter = Cutter(text.encode(), pattern and re.compile(pattern), block)
    cuts = plain_cuts(text, pattern)
    if len(cuts) == 1:
        assert cutter.units == 0 and cutter.cut(0) == ((0, 0))
        return
    assert cutter.units == len(cuts) - 1 and cutter.chars == len(text)
    for u, chars in enumerate(cuts):
        byte, found = cutter.cut(u)
        assert found == chars and text.encode()[:byte] == text[:chars].encode()


def check(df, rows, pattern=None, markers=Markers(), **options):
    marks = (markers.prefix, markers.suffix, markers.middle)
    out = fill_middle(df, markers, unit=pattern, **options).withColumn("restored", restore(markers=markers))
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"])
                  for r in out.collect()), key=repr)
    assert got == sorted(((i, *brute(i, t, pattern, marks), t or "") for i, t in rows), key=repr)


@pytest.mark.parametrize("pattern", [None, r"\S+\s*"])
def test_documents_match_brute_force(spark, pattern):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(df.select("doc_id", "text"), [tuple(r) for r in df.select("doc_id", "text").collect()], pattern)


ROWS = [(1, None), (2, ""), (3, "a"), (4, "has <S> in it"), (5, "<P"), (6, "<"), (7, "S>é<"), (None, "no id 漢字"), (None, None),
        (8, "twice"), (8, "twice"), (8, "other"), (9, "😀" * 300_000), (-4, "x\0y"), (10, "   "), (2**63 - 1, "last")]


@pytest.mark.parametrize("pattern", [None, r"\w+\s*"])
def test_defined_cases_and_clashing_columns(spark, pattern):
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string")
    check(df, ROWS, pattern)
    more = df.withColumns({c: F.lit("x") for c in ("n", "form", "output", "prefix_chars", "seed", "lang")})
    check(more, ROWS, pattern)
    assert {"seed", "lang"} <= set(fill_middle(more).columns) and len(set(fill_middle(more).columns)) == len(fill_middle(more).columns)
    check(df.limit(0), [], pattern)
    check(df, ROWS, pattern, Markers("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>"), block_bytes=7)


def test_forms_keep_their_shares(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("some words here").alias("text"))
    n = {r["form"]: r["count"] for r in fill_middle(df).groupBy("form").count().collect()}
    assert abs(n["plain"] / 20_000 - 0.1) < 0.01 and abs(n["spm"] / 18_000 - 0.2) < 0.015
