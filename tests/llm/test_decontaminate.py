"""Benchmark decontamination against brute force, recall of the candidate search, and the defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import tidemark.llm.decontaminate as decontaminate_module
from tidemark.llm.decontaminate import (ITEM_MASS, Benchmark, decontaminate, document_frequency, drop_contaminated, encode, item_gram, latent_basis, least_cosines,
                                        lcs, search, sketch, term_weights, words)
from tests.llm.test_dedup import empty, odd

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")


def plain_lcs(a, b):
    t = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1, j + 1] = t[i, j] + 1 if x == y else max(t[i, j + 1], t[i + 1, j])
    return int(t[-1, -1])


def test_lcs_matches_the_table():
    rng = np.random.default_rng(0)
    for _ in range(100):
        a, b = rng.integers(1, 6, rng.integers(1, 90)), rng.integers(1, 6, rng.integers(0, 120))
        assert lcs(a, b)[0] == plain_lcs(a, b)


def test_verbatim_items_are_found_and_others_are_not(spark):
    docs, bench = tables(spark)
    texts = [(r["doc_id"], b" " + b" ".join(words(r["text"].encode())) + b" ") for r in docs.collect()]
    items = [(r["item_id"], b" " + b" ".join(words(r["text"].encode())) + b" ") for r in bench.collect()]
    want = {(d, i) for d, t in texts for i, s in items if s in t}
    got = decontaminate(docs, bench).collect()
    assert want and {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all(r["similarity"] == 1.0 for r in got)
    clean = drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.select("doc_id").collect()} == {d for d, _ in texts} - {d for d, _ in want}


def edited(spark, docs, bench, change):
    """Each benchmark item, changed, in the middle of a document of its own."""
    hosts = [r["text"] for r in docs.filter(F.length("text").between(400, 1500)).orderBy("doc_id").limit(40).collect()]
    rows = []
    for k, r in enumerate(bench.orderBy("item_id").collect()):
        w = r["text"].split()
        h = hosts[k].split()
        rows.append((10_000 + k, " ".join(h[:30] + change(w) + h[30:]), r["item_id"]))
    return spark.createDataFrame(rows, "doc_id bigint, text string, item_id bigint")


def test_near_copies_and_paraphrases_are_found(spark):
    docs, bench = tables(spark)
    def tenth(w):
        return [x for i, x in enumerate(w) if i % 10 != 3]
    def third(w):      # a quarter of the words differ, the answer stands
        return [("other%d" % i if i % 3 == 0 and i < len(w) - 8 else x) for i, x in enumerate(w)]
    for change, least in ((tenth, 0.95), (third, 0.8)):
        added = edited(spark, docs, bench, change)
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate(docs.select("doc_id", "text").union(added.select("doc_id", "text")), bench).collect()}
        want = {(r["doc_id"], r["item_id"]) for r in added.collect()}
        assert len(want & got) >= least * len(want)


def test_recall_of_the_latent_search(spark):
    """Candidates against brute force over all windows: those whose subsequence verifies."""
    docs, bench = tables(spark)
    def change(w):
        return [x for i, x in enumerate(w) if i % 8 != 3]
    all_docs = docs.select("doc_id", "text").union(edited(spark, docs, bench, change).select("doc_id", "text")).cache()
    b = next(Benchmark.slices(bench, 1 << 30, 1 << 30))
    want = set()
    for r in all_docs.collect():
        codes = np.array([b.vocabulary.get(w, 0) for w in words(r["text"].encode())])
        for i, item in zip(b.ids, b.items, strict=True):
            if len(codes) and lcs(item, codes[codes > 0])[0] >= 0.8 * len(item) and any(
                    lcs(item, codes[s:s + 2 * len(item)])[0] >= 0.8 * len(item) for s in range(0, len(codes), max(1, len(item) // 2))):
                want.add((r["doc_id"], i))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate(all_docs, bench).collect()}
    assert len(want) >= 40 and len(want & got) >= 0.9 * len(want)


def item_matrix(b, weight):
    rows = np.zeros((len(b.items), len(weight)))
    for i, item in enumerate(b.items):
        np.add.at(rows[i], item, weight[item])
    return rows


def test_sketch_is_the_gram_matrix(spark):
    docs, bench = tables(spark)
    docs, b = docs.limit(50), next(Benchmark.slices(bench, 1 << 30, 1 << 30))
    encoded = encode(docs, b).cache()
    size = len(b.vocabulary)
    df, passages = document_frequency(encoded, size, np.uint16)
    weight = term_weights(df, passages, b)
    rows, seen, blocks = [], np.zeros(size + 1, int), 0
    for r in encoded.collect():
        codes = np.frombuffer(bytes(r["codes"]), np.uint16)
        n = max(1, -(-len(codes) // 32))
        blocks += n
        for i in range(n):
            seen[np.unique(codes[i * 32:(i + 1) * 32])] += 1
            row = np.zeros(size + 1)
            np.add.at(row, codes[i * 32:(i + 2) * 32], 1)
            rows.append(row * weight)
    assert passages == blocks and (df[1:] == seen[1:]).all()
    a = np.array(rows)
    basis = np.random.default_rng(0).standard_normal((size + 1, 5)) * (weight > 0)[:, None]
    assert np.allclose(sketch(encoded, weight, basis, np.uint16), a.T @ (a @ basis), rtol=1e-3, atol=1e-2)
    m = item_matrix(b, weight)
    assert np.allclose(item_gram(b, weight, basis), m.T @ (m @ basis))
    # the basis holds nearly as much of the matrix as the exact singular vectors
    m = np.concatenate((a, np.sqrt(ITEM_MASS * passages / len(b.items)) * item_matrix(b, weight)))
    found = latent_basis(encoded, b, weight, passages, np.uint16, 32)
    exact = np.linalg.svd(m, full_matrices=False)[2][:32].T
    assert np.allclose(found.T @ found, np.eye(32))
    assert np.linalg.norm(m @ found) >= 0.9 * np.linalg.norm(m @ exact)


def test_long_items_and_long_texts(spark, monkeypatch):
    docs, bench = tables(spark)
    monkeypatch.setattr(decontaminate_module, "SLAB", 256)      # long texts are cut into pieces
    texts = [r["text"] for r in docs.filter(F.length("text") > 3000).orderBy("doc_id").limit(4).collect()]
    w = texts[0].split()
    items = spark.createDataFrame([(1, " ".join(w[40:340])), (2, " ".join(w[100:130])), (3, " ".join(texts[1].split()[:90]))], "item_id bigint, text string")
    host = spark.createDataFrame([(7, texts[2] + " " + " ".join(w)), (8, texts[3]), (9, " ".join(texts[1].split()[:90]) + " " + texts[3])], "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate(host, items).collect()} == {(7, 1), (7, 2), (9, 3)}


def test_defined_cases(spark):
    _docs, bench = tables(spark)
    df = odd(spark, "item_id")
    text = bench.first()["text"]
    more = df.withColumn("text", F.when(F.col("doc_id") == 9, F.lit("intro " + text)).otherwise(F.col("text")))
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate(more, bench).collect()} == {(9, bench.first()["item_id"])}
    assert drop_contaminated(more, bench).columns == more.columns and drop_contaminated(more, bench).count() == more.count() - 1
    assert decontaminate(empty(spark), bench).count() == 0
    assert decontaminate(df, bench.limit(0)).count() == 0
    odd_items = spark.createDataFrame([(1, None, None), (2, "", "x"), (3, "a b", None), (None, text, "yes"), (5, text, None)], "item_id bigint, text string, answer string")
    assert {r["item_id"] for r in decontaminate(more, odd_items).collect()} == {None, 5}


def test_a_large_benchmark_is_looked_for_in_slices(spark):
    docs, bench = tables(spark)
    want = {(r["doc_id"], r["item_id"]) for r in decontaminate(docs, bench).collect()}
    for limits in ((2_000, 1 << 30), (1 << 30, 150)):
        parts = list(Benchmark.slices(bench, *limits))
        assert len(parts) > 2 and sorted(i for p in parts for i in p.ids) == sorted(r["item_id"] for r in bench.collect())
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate(docs, bench, max_bytes=4_000).collect()} == want


def test_short_items_are_found_as_phrases(spark):
    docs, bench = tables(spark)
    texts = [(r["doc_id"], b" " + b" ".join(words(r["text"].encode())) + b" ") for r in docs.collect()]
    w = words(texts[3][1])
    items = [(1, w[5:9]), (2, w[20:22]), (3, [w[1], b"zzz"]), (4, w[7:8]), (5, w[5:9])]
    table = spark.createDataFrame([(i, b"-".join(x).decode()) for i, x in items], "item_id bigint, text string")
    want = {(d, i) for d, t in texts for i, x in items if b" " + b" ".join(x) + b" " in t}
    assert (texts[3][0], 1) in want and {(r["doc_id"], r["item_id"]) for r in decontaminate(docs, table).collect()} == want
    both = table.unionByName(bench)
    long_ones = {(r["doc_id"], r["item_id"]) for r in decontaminate(docs, bench).collect()}
    got = decontaminate(docs, both).select("doc_id", "item_id").collect()
    assert {tuple(r) for r in got} >= want | long_ones


def test_edits_over_the_whole_item(spark):
    """Recall by the share of words kept, the edits spread over the whole item, answer words included. Below 0.8
    an item is known by its last or its rarest words, of which it must keep 7 of 8."""
    docs, bench = tables(spark)
    for share, least in ((0.85, 0.95), (0.72, 0.15)):
        rng = np.random.default_rng(4)

        def change(w):
            gone = set(rng.choice(len(w), len(w) - int(np.ceil(share * len(w))), replace=False).tolist())
            return ["other%d" % i if i in gone else x for i, x in enumerate(w)]
        added = edited(spark, docs, bench, change)
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate(docs.select("doc_id", "text").union(added.select("doc_id", "text")), bench).collect()}
        want = {(r["doc_id"], r["item_id"]) for r in added.collect()}
        print(f"kept {share}: {len(want & got)} of {len(want)}")
        assert len(want & got) >= least * len(want)


def test_the_cosine_selects(spark):
    """Of all pairs of window and item, before any words are counted."""
    docs, bench = tables(spark)
    b = next(Benchmark.slices(bench, 1 << 30, 1 << 30))
    encoded = encode(docs, b).cache()
    df, passages = document_frequency(encoded, len(b.vocabulary), np.uint16)
    weight = term_weights(df, passages, b)
    basis = latent_basis(encoded, b, weight, passages, np.uint16)
    queries = np.array([weight[i] @ basis[i] for i in b.items])
    queries /= np.linalg.norm(queries, axis=1, keepdims=True)
    floor, passed, pairs = least_cosines(b), 0, 0
    for r in encoded.collect():
        codes = np.frombuffer(bytes(r["codes"]), np.uint16)
        for at in range(0, max(1, len(codes)), 32):
            some = codes[at:at + 64]
            v = weight[some] @ basis[some]
            passed += int((queries @ v >= floor * max(np.linalg.norm(v), 1e-12)).sum()) if len(some) else 0
            pairs += len(floor)
    print(f"{passed / pairs:.4f} of pairs pass")
    assert passed < 0.05 * pairs


def test_unverified_candidates_are_a_small_part(spark):
    docs, bench = tables(spark)
    b = next(Benchmark.slices(bench, 1 << 30, 1 << 30))
    encoded = encode(docs, b).cache()
    df, passages = document_frequency(encoded, len(b.vocabulary), np.uint16)
    weight = term_weights(df, passages, b)
    b.set_answers(weight)
    basis = latent_basis(encoded, b, weight, passages, np.uint16)
    assert search(encoded, b, weight, basis, np.uint16, verify=False).count() < 0.2 * docs.count() * len(b.items)


@pytest.mark.parametrize("which", [0, 7, "shortest"])
def test_an_item_in_a_third_of_the_documents_is_found_in_all(spark, which):
    """Against brute force: its words are then common ones, and it lies anywhere in its documents."""
    docs, bench = tables(spark)
    items = sorted((r["item_id"], r["text"]) for r in bench.collect())
    item_id, text = min(items, key=lambda r: len(r[1].split())) if which == "shortest" else items[which]
    rng, rows = np.random.default_rng(2), []
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        w = (r["text"] or "").split()
        at = int(rng.integers(0, len(w) + 1))
        rows.append((r["doc_id"], " ".join(w[:at] + text.split() + w[at:]) if r["doc_id"] % 3 == 0 else r["text"]))
    planted = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"] for r in decontaminate(planted, bench).filter(F.col("item_id") == item_id).collect()}
    item = b" " + b" ".join(words(text.encode())) + b" "
    want = {d for d, t in rows if item in b" " + b" ".join(words((t or "").encode())) + b" "}
    assert len(want) >= len(rows) // 3 and want <= found


def test_the_index_is_fitted_on_every_document(spark, monkeypatch):
    """However many passages there are, the sketch takes all documents; their and the items' weights stay in proportion."""
    docs, bench = tables(spark)
    b = next(Benchmark.slices(bench, 1 << 20, 1 << 20))
    encoded = encode(docs.limit(40), b).localCheckpoint()
    weight = np.concatenate(([0.0], np.ones(len(b.vocabulary))))
    taken = []
    monkeypatch.setattr(decontaminate_module, "sketch", lambda e, w, basis, kind: taken.append(e.count()) or basis)
    latent_basis(encoded, b, weight, 1 << 24, np.uint16, 8)
    assert taken == [40]
