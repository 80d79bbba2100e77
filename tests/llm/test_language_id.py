"""Language ID: held-out accuracy, the binding itself, and the defined cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.language_id import DIMENSIONS, SEED, bundle, drop_unidentified, language_id, letter_classes, sequences
from tests.llm.test_dedup import empty, odd


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    judged = [r for r in out if r["held_out"] and r["lang"]]
    assert len(judged) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in judged]) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in out)


def test_bundle_is_the_sum_of_permuted_products():
    letters = (np.random.default_rng(SEED).integers(0, 2, (64, DIMENSIONS)) * 2 - 1).astype(int)
    text = "Ab, cÉ 9 x"
    c = [0]
    for ch in text.lower():
        k = int(letter_classes()[ord(ch)])
        if k or c[-1]:
            c.append(k)
    if c[-1]:
        c.append(0)
    want = sum(np.roll(letters[a], 2) * np.roll(letters[b], 1) * letters[d] for a, b, d in zip(c, c[1:], c[2:], strict=False))
    u, n = np.unique(sequences(text), return_counts=True)
    assert (bundle(u, n, DIMENSIONS) == want).all()


def test_defined_cases(spark):
    df = odd(spark, "lang").withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 3 == 0, "de"))
    out = {(r["doc_id"]): r for r in language_id(df).collect()}
    assert out[3]["lang_pred"] == out[4]["lang_pred"] == out[8]["lang_pred"] == "und" and out[3]["score"] == 0
    assert out[7]["lang_pred"] in ("en", "de")
    assert language_id(df).count() == df.count()
    kept = drop_unidentified(df)
    assert kept.columns == df.columns and {3, 4, 8}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert language_id(empty(spark).withColumn("lang", F.lit(None).cast("string"))).count() == 0
    none = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id(none).collect()} == {"und"}


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    other = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    key = lambda r: r["doc_id"]
    assert sorted(language_id(docs).collect(), key=key) == sorted(language_id(other).collect(), key=key)
