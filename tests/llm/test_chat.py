"""Chat formatting: exact Viterbi over blocks, held-out accuracy, rendering, and the defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat
from tidemark.llm.chat import START, STATES, S, chat_format, decode, features, fit, marker, raw_lines, turns

SF = "/root/testdata/sf0.01"


def conversations(spark):
    return spark.read.parquet(f"{SF}/conversations.parquet")


@pytest.fixture(scope="module")
def model(spark):
    return fit(raw_lines(conversations(spark)))


def plain_viterbi(model, obs):
    score = model.moves[START] + model.emit[:, obs[0]]
    for o in obs[1:]:
        score = (score[:, None] + model.moves[:S]).max(axis=0) + model.emit[:, o]
    return score.max()


def path_score(model, obs, states):
    before = [START, *states[:-1]]
    return sum(model.moves[a, b] + model.emit[b, o] for a, b, o in zip(before, states, obs, strict=True))


def test_markers():
    assert marker("User: hello") == (2, "hello") and marker("[ai] x") == (3, "x") and marker("**Q**: x") == (2, "x")
    assert marker("### System: x") == (1, "x") and marker("Bob: hi there") == (4, "hi there") and marker("Bob:") == (0, "Bob:")
    assert marker("no marker here") == (0, "no marker here") and marker("") == (0, "")


def test_block_decoding_is_exact(spark, model, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_SHIFT", 2)
    monkeypatch.setattr(chat, "FAN", 3)
    rng = np.random.default_rng(0)
    words = ["User: hi?", "Assistant: well", "plain words here", "", "System: be kind", "Bob: yes sir", "is it?", "word " * 30, "word " * 80]
    data = [(c, i, words[rng.integers(len(words))]) for c, n in ((1, 1), (2, 4), (3, 5), (4, 37), (5, 130)) for i in range(n)]
    lines = spark.createDataFrame(data, "conv_id bigint, seq bigint, line string")
    got = {}
    for r in decode(lines, model).orderBy("conv_id", "seq").collect():
        got.setdefault(r["conv_id"], []).append(r["state"])
    for c, states in got.items():
        obs = [features(x) for k, _, x in data if k == c]
        assert len(states) == len(obs)
        assert path_score(model, obs, states) == pytest.approx(plain_viterbi(model, obs))


def test_roles_are_recovered_on_held_out_transcripts(spark):
    raw = raw_lines(conversations(spark)).cache()
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(chat.STYLES)))
    held = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 5 == 0
    found = decode(raw.filter(held).select("conv_id", "seq", "line"), fit(raw.filter(~held)))
    rows = found.join(raw.select("conv_id", "seq", "role", "begin", style.alias("style")), ["conv_id", "seq"]).collect()
    ok = [(STATES[r["state"]] == (r["role"], "begin" if r["begin"] else "inside"), r["style"]) for r in rows]
    marked = [x for x, s in ok if s < len(chat.STYLES) - 1]
    assert len(marked) > 100 and np.mean(marked) >= 0.97
    assert np.mean([x for x, _ in ok]) >= 0.8


def test_turns_are_rendered_whole(spark, model):
    lines = [(1, 0, "System: be brief"), (1, 1, "User: what is it?"), (1, 2, "second line"), (1, 3, "Assistant: a thing"), (1, 4, "User: thanks")]
    df = spark.createDataFrame(lines, "conv_id bigint, seq bigint, line string")
    out = [(r["turn"], r["role"], r["n_lines"], r["text"]) for r in turns(decode(df, model)).orderBy("turn").collect()]
    assert out == [(1, "system", 1, "<|system|>\nbe brief\n<|end|>"), (2, "user", 2, "<|user|>\nwhat is it?\nsecond line\n<|end|>"),
                   (3, "assistant", 1, "<|assistant|>\na thing\n<|end|>"), (4, "user", 1, "<|user|>\nthanks\n<|end|>")]


def test_no_line_is_lost(spark):
    conv = conversations(spark)
    assert chat_format(conv).agg(F.sum("n_lines")).first()[0] == raw_lines(conv).count()


def test_defined_cases(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (None, 0, "user", "x"), (None, None, None, ""), (2, 0, "tool", "odd role"), (3, 5, "assistant", "a\n\nb" * 3000),
            (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    more = df.withColumns({c: F.lit("x") for c in ("conv", "idx", "seq", "line", "state", "lines", "own", "last", "at", "sums")})
    out = chat_format(more).collect()
    assert sum(r["n_lines"] for r in out) == raw_lines(df).count()
    assert {r["conv_id"] for r in out} == {1, 2, 3, 4, None}
    assert chat_format(df.limit(0)).count() == 0
