"""License scans against brute force, and the defined cases."""

import re

from pyspark.sql import functions as F

from tidemark.llm.license_scan import NOTICES, PHRASES, diagonals, license_scan, merge_diagonals, templates, verify
from tests.llm.test_dedup import empty, odd

BASE = ("n_words", "n_base", "first_word", "last_word", "base_labels")
TEXTS = [
    None, "", "cc", "cc by", "CC-BY", "cc by cc by cc by", "x All Rights Reserved. all rights reserved", "all rights, all rights reserved",
    "GNU General Public License version 3", "general\npublic\nlicense", "É cc by é", "ccby", "cc 1by", "all rights reserve",
    "Released under the MIT License.", "Released under the the MIT Licence", "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "word " * 50_000 + "cc by", "under the by cc rights all",
    "Permission is hereby granted, free of all charge, to any person obtaining a copy of this software and the associated documentation files",
]


def brute(text):
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    places = sorted((p, label) for label, phrase in PHRASES.items() for p in range(len(w))
                    if w[p:p + len(phrase.split())] == phrase.encode().split())
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted({x for _, x in places})))


def check(df):
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in df.select("doc_id", "text").collect()), key=repr)
    rows = license_scan(df).collect()
    assert sorted(((r["doc_id"], *(r[c] for c in BASE)) for r in rows), key=repr) == want
    for r in rows:
        base, labels = set(filter(None, r["base_labels"].split(","))), set(filter(None, r["labels"].split(",")))
        assert base <= labels <= base | set(NOTICES) and r["labels"] == ",".join(sorted(labels))
        assert (r["score"] == 1.0) if base else (0.8 <= r["score"] <= 1) if labels else r["score"] == 0
    return rows


def test_base_places_match_brute_force(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    check(odd(spark, "hash"))
    assert license_scan(empty(spark)).count() == 0


def test_notices_and_phrases(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("template", "i", "at", "found")})
    labels = {TEXTS[r["doc_id"]]: r["labels"] for r in check(df)}
    assert labels["Released under the MIT License."] == "mit" and labels["Released under the the MIT Licence"] == "mit"
    assert labels["Licensed under CC BY-NC 4.0."] == "cc-by,cc-by-nc" and labels["Licensed under CC BY-SA 4.0."] == "cc-by,cc-by-sa"
    assert labels[TEXTS[16]] == "apache-2.0" and labels[TEXTS[21]] == "mit" and labels["under the by cc rights all"] == ""


def test_rows_that_share_a_doc_id_keep_their_own_results(spark):
    check(spark.createDataFrame([(1, "cc by"), (1, "x cc by"), (1, "cc by"), (None, "all rights reserved"), (None, "no")], "doc_id bigint, text string"))


def test_votes_add_up_along_diagonals(spark):
    known = templates()
    t = next(i for i, (label, base, _) in enumerate(known) if label == "mit" and not base)
    df = spark.createDataFrame([(1, "so: released under the MIT license")], "doc_id bigint, text string")
    row = diagonals(df, known).filter(F.col("template") == t).first()
    assert (row["diagonal"], row["votes"], row["low"], row["high"]) == (1, 4, 1, 4)
    assert merge_diagonals([(t, 1, 2, 1, 2), (t, 3, 2, 6, 7), (t, 40, 1, 44, 44)]) == [(t, 4, 1, 7), (t, 1, 44, 44)]
    assert verify([b"cc"], [(0, -1, 1, 0, 0)], known) == ([], {})


def test_rows_without_id_and_repeated_rows_keep_their_own_results(spark):
    """A third of the rows has no doc_id, some share one, and some are alike: as each alone."""
    texts = ["some words " * i + t for i, t in enumerate(["under cc by here", "general public license", "nothing of it", "all rights reserved " * 3] * 6)]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    rows = [(None if i % 3 == 0 else i // 2, t) for i, t in enumerate(texts)] * 2
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
    single = spark.createDataFrame([(i, t) for i, t in enumerate(dict.fromkeys(texts))], "doc_id bigint, text string")
    by_id = {r["doc_id"]: tuple(r[c] for c in cols) for r in license_scan(single).collect()}
    alone = {t: by_id[i] for i, t in enumerate(dict.fromkeys(texts))}
    got = sorted(((r["doc_id"], *(r[c] for c in cols)) for r in license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=repr)
    assert got == sorted(((i, *alone[t]) for i, t in rows), key=repr)
