"""LM scoring: base score and counts against brute force, gradients, whole-document state, and held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lm_scoring as lm
from tests.llm.test_dedup import empty, odd


def check_base(df):
    rows = [(r["doc_id"], (r["text"] or "").encode().lower().split() + [b""]) for r in df.select("doc_id", "text").collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    c = Counter(x for (_, w), h in zip(rows, held, strict=True) if not h for x in w)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, h, len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
                   for (i, w), h in zip(rows, held, strict=True)), key=repr)
    out = lm.lm_score(df).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=repr)
    key = lambda r: (repr(r[0]), r[2], r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    return out


def test_base_score_and_held_out_gain(spark):
    out = check_base(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    held = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_rare_words_are_looked_up_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_SHARE", 50)      # nearly all words are rare
    check_base(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


def test_defined_cases(spark):
    check_base(odd(spark, "word"))
    assert lm.lm_score(empty(spark)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    check_base(spark.createDataFrame([(held, "only held out"), (held, None)], "doc_id bigint, text string"))


def tiny(seed=0):
    counts = np.arange(9000, 0, -2)
    stats = lm.Statistics(int(counts.sum()), len(counts), {}, counts)
    model = {k: v.astype(np.float64) for k, v in lm.initial_model(stats).items()}
    rng = np.random.default_rng(seed)
    for k in ("wc", "ww"):
        model[k] = rng.standard_normal(model[k].shape) * 0.2
    return model, rng


def test_gradients_match_finite_differences(monkeypatch):
    model, rng = tiny()
    x, y = rng.integers(0, lm.VOCABULARY, (3, 6)), rng.integers(0, 300, (3, 6))
    x[1, 3] = 7      # an end: the state is cleared there
    h = rng.standard_normal((3, lm.HIDDEN)) * 0.3
    seen = {}

    def grab(m):      # an Adagrad step of rate 1 from a unit square is nearly the gradient
        square = {k: np.full_like(v, 1e12) for k, v in m.items()}
        before = {k: v.copy() for k, v in m.items()}
        _, logp = lm.train_window(m, x, y, h, 7, square, rate=1e6)
        seen.update({k: before[k] - m[k] for k in m})
        return logp

    def loss(m):
        copy = {k: v.copy() for k, v in m.items()}
        return -lm.train_window(copy, x, y, h, 7, {k: np.full_like(v, 1e12) for k, v in m.items()}, rate=0.0)[1] / x.size

    grab({k: v.copy() for k, v in model.items()})
    for k in model:
        flat = np.abs(seen[k]).ravel()
        for at in np.argsort(-flat)[:4]:
            for sign in (1,):
                m = {n: v.copy() for n, v in model.items()}
                m[k].ravel()[at] += sign * 1e-3
                up = loss(m)
                m[k].ravel()[at] -= 2e-3
                down = loss(m)
            assert (up - down) / 2e-3 == pytest.approx(seen[k].ravel()[at], rel=2e-2, abs=2e-4), k


def test_scoring_carries_the_state_over_windows(monkeypatch):
    model, rng = tiny(1)
    docs = [rng.integers(0, lm.VOCABULARY, n) for n in (1, 40, 7, 300, 7)]
    whole = lm.score_documents(model, docs, 7)
    monkeypatch.setattr(lm, "SCORE_TOKENS", 5)
    assert lm.score_documents(model, docs, 7) == pytest.approx(whole, rel=1e-5)
    # one at a time, step by step, normalised over all words
    for doc, got in zip(docs, whole, strict=True):
        h, last, total = np.zeros((1, lm.HIDDEN)), 7, 0.0
        for w in doc:
            h = lm.step(model, model["embed"][[last]] @ model["wx"] + model["b"], h)[0]
            pc = np.exp(h @ model["wc"] + model["bc"])[0]
            pw = np.exp(np.einsum("h,chw->cw", h[0], model["ww"]) + model["bw"])
            p = (pc / pc.sum())[:, None] * pw / pw.sum(1, keepdims=True)
            assert p.sum() == pytest.approx(1)
            total += math.log(p.ravel()[w])
            last = w
        assert got == pytest.approx(total, rel=1e-4)


def test_training_learns_a_repeating_text():
    counts = np.array([500] * 8)
    model = lm.initial_model(lm.Statistics(4000, 8, {}, counts))
    stream = np.tile(np.arange(8), 3000)
    before = lm.score_documents(model, [stream[:80]], 7)[0]
    lm.train_stream(model, stream, 7, {k: np.full_like(v, 1e-6) for k, v in model.items()})
    assert lm.score_documents(model, [stream[:80]], 7)[0] > before / 4


def test_every_training_document_reaches_the_weights(spark):
    text = "the cat sat on the mat and the dog sat on the cat " * 20
    for i in range(8):
        training = spark.createDataFrame([(i, text)], "doc_id bigint, text string")
        stats = lm.statistics(lm.word_counts(training))
        start, model = lm.initial_model(stats), lm.train(training, stats)
        assert any(not np.allclose(model[k], start[k], atol=1e-4) for k in ("wh", "wx", "wc")), i


def test_scores_of_unknown_and_rare_words_step_by_step(spark, monkeypatch):
    """``score`` of every row against a plain computation: words of the model, rare words and words never seen."""
    monkeypatch.setattr(lm, "HEAD_SHARE", 30)      # most words are looked up by the join
    rng = np.random.default_rng(3)
    words = ["w%d" % min(int(z), 400) for z in rng.zipf(1.3, 3_000)]
    docs = [(i, " ".join(words[40 * i:40 * i + 40 - i % 7])) for i in range(75)] + [(75, "never seen w1"), (76, ""), (77, None), (78, "W1 w1 w399")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = {}
    train = lm.train
    monkeypatch.setattr(lm, "train", lambda t, s: kept.setdefault("model", train(t, s)))
    got = {r["doc_id"]: r for r in lm.lm_score(df).collect()}
    model = {k: v.astype(float) for k, v in kept["model"].items()}
    seqs = {i: [*(t or "").lower().split(), ""] for i, t in docs}
    counts = Counter(w for i, s in seqs.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in s)
    n, v = sum(counts.values()), len(counts)
    head = sorted((w for w, c in counts.items() if c * 30 > n or w == ""), key=lambda w: (-counts[w], w))
    rank = {w: k for k, w in enumerate(head)}
    rest = n - sum(counts[w] for w in head) + v - len(head) + 1
    assert 3 < len(head) < v and any(w not in counts for s in seqs.values() for w in s)
    pc_of = lambda x: np.exp(x) / np.exp(x).sum()
    for i, seq in seqs.items():
        h, last, total = np.zeros((1, lm.HIDDEN)), rank[""], 0.0
        for w in seq:
            k = rank.get(w, lm.VOCABULARY - 1)
            h = lm.step(model, model["embed"][[last]] @ model["wx"] + model["b"], h)[0]
            c = k // lm.PER_CLASS
            total += math.log10(pc_of((h @ model["wc"] + model["bc"])[0])[c]) + math.log10(pc_of((h @ model["ww"][c] + model["bw"][c])[0])[k % lm.PER_CLASS])
            total += 0.0 if w in rank else math.log10((counts[w] + 1) / rest)
            last = k
        assert got[i]["score"] == pytest.approx(total, rel=1e-4), i


def test_a_model_is_trained_however_rare_the_end_is(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_SHARE", 8)
    text = "the cat sat on the mat and the dog sat on the cat " * 20
    training = spark.createDataFrame([(0, text)], "doc_id bigint, text string")
    stats = lm.statistics(lm.word_counts(training))
    assert lm.END in stats.rank
    start, model = lm.initial_model(stats), lm.train(training, stats)
    assert not np.allclose(model["wc"], start["wc"], atol=1e-4)


def test_words_are_split_and_numbered_as_plain_python_does():
    texts = ["", None, " A b\tB ", "\x0b\x0c", "É\x1cé\xa0x\u2003y z\r\n", "one"]
    words, n_words = lm.split_words(pa.array([*["cut off"] * 2, *texts], pa.string()).slice(2))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert words.to_pylist() == sum(plain, []) and n_words.tolist() == [len(w) for w in plain]
    assert lm.with_ends(np.arange(len(words)), n_words, -1).tolist() == [-1, -1, 0, 1, 2, -1, -1, *range(3, 3 + n_words[4]), -1, len(words) - 1, -1]
    column = pa.array(["x" * lm.PIECE_BYTES, None, "y", "z"])
    assert list(lm.pieces(column)) == [(0, 1), (1, 3)] and not list(lm.pieces(column[:0]))


def test_a_rare_word_is_looked_up_once_for_all_rows_it_stands_in(spark, monkeypatch):
    """Not once for each place, which made the lookup's rows and its sort the size of the corpus."""
    monkeypatch.setattr(lm, "HEAD_SHARE", 8)
    docs = [(i, "never never again w%d" % i) for i in range(40)] + [(40, None)]
    kept, stage = {}, lm.stage
    monkeypatch.setattr(lm, "stage", lambda df, purpose: kept.setdefault(purpose, stage(df, purpose)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    check_base(df)
    tail = {bytes(r["word"]): sorted(r["rows"]) for r in kept["lm-scored"].filter("word is not null").collect()}
    assert kept["lm-scored"].filter("word is not null").count() == len(tail)
    row = {r["doc_id"]: r["row"] for r in kept["lm-scored"].filter("word is null").collect()}
    assert tail[b"w7"] == [row[7]] and len(row) == 41
    again = tail.get(b"again")      # rare or not by its count
    assert again is None or again == sorted(row[i] for i in range(40))
    assert "ShuffledHashJoin" in lm.lm_score(df)._jdf.queryExecution().executedPlan().toString()


def test_large_logits_do_not_overflow():
    model, rng = tiny(2)
    for size in (1, 400):
        model["wc"] *= size
        hs, target = rng.uniform(-1, 1, (50, lm.HIDDEN)), rng.integers(0, lm.VOCABULARY, 50)
        logp, back, _ = lm.output(model, hs, target, 1.0, lm.Room())
        got = lm.log_probability(lm._biased(model, "wc", "bc"), lm._biased(model, "ww", "bw"), hs, target, lm.Room())
        assert math.isfinite(logp) and np.isfinite(back).all() and got.sum() == pytest.approx(logp)
