"""LM scoring (operator 6): a gated recurrent language model.

Counts of all words of all training documents give the base score, the model's vocabulary and the
probability of words outside it. Words with more than one token in ``HEAD_SHARE`` number at most
``HEAD_SHARE``; they are sent to every task, that arithmetic being the bound. All rarer words are looked up
by a shuffled join, each once for a piece of the documents, with the rows that it stands in.

The model is a gated recurrent unit over the ``VOCABULARY`` most frequent words, with a softmax factored into
word classes by frequency rank. Its output biases start at the words' training frequencies. Every task
trains a copy on its share of the training documents (no document is left out) by truncated backpropagation in
numpy over windows of ``STEPS`` tokens, the state being carried from window to window; Spark averages the copies, weighted by tokens (each
copy is one binary block a parameter, summed in two steps). So the weights depend on how the documents are dealt to tasks; the counts and the
base score do not. A word outside the vocabulary costs the unknown
word's probability times its share (c + 1) / (tokens + words + 1) of the rest.

Scoring runs ``SCORE_LANES`` documents of similar length side by side; their state is carried across windows from the first
word to the end, so the whole document is scored and memory is bounded by the window.

Defined results: null and empty texts are one end token. A null doc_id is not held out. Repeated rows are
scored alike. With no training document the counts are 0 and the model is uniform. An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, stage

HOLD_OUT, HELD = 7, 2
HEAD_SHARE = 1 << 17
CLASSES, PER_CLASS = 64, 64
VOCABULARY = CLASSES * PER_CLASS
EMBED, HIDDEN = 16, 24
LANES, WINDOWS, STEPS, RATE = 128, 48, 32, 0.1
CHUNK_TOKENS = 1 << 17
PIECE_BYTES, SCORE_DOCS = 1 << 25, 10_000
SCORE_LANES, SCORE_TOKENS = 512, 1 << 12      # sizes that stay in a core's cache
END = b""      # no word is empty
FLUSH_TOKENS = 1 << 22


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == HELD, F.lit(False))


def pieces(column: pa.Array) -> Iterator[tuple[int, int]]:
    """``(first row, rows)`` of consecutive pieces of a text column, each of about ``PIECE_BYTES`` and at most ``SCORE_DOCS`` rows."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    piece = (np.cumsum(size) - size) // PIECE_BYTES + np.arange(len(size)) // SCORE_DOCS
    first = np.flatnonzero(np.diff(piece, prepend=-1))
    yield from zip(first.tolist(), np.diff(first, append=len(size)).tolist(), strict=True)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of the lower-cased texts (A-Z only), one row's after the other's, and each row's number of them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    words, at = lists.flatten(), np.asarray(lists.offsets)
    full = np.asarray(pc.binary_length(words)) > 0      # blanks at the ends of a text give empty words
    before = np.concatenate(([0], np.cumsum(full)))
    words = words if full.all() else words.filter(pa.array(full))
    return words.view(pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()), np.diff(before[at])


def with_ends(numbers: np.ndarray, n_words: np.ndarray, end: int) -> np.ndarray:
    """The numbers of all rows' words, with the end's after each row."""
    out = np.full(len(numbers) + len(n_words), end, numbers.dtype)
    out[np.arange(len(numbers)) + np.repeat(np.arange(len(n_words)), n_words)] = numbers
    return out


def word_counts(training: DataFrame) -> DataFrame:
    """``(word binary, c)`` over all training rows, counted per task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, ends = [], 0, 0

        def flush() -> pa.RecordBatch:
            found = pa.chunked_array(held, pa.binary()).value_counts()
            return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "c"])

        for b in batches:
            for lo, rows in pieces(b.column(0)):
                words, n_words = split_words(b.column(0).slice(lo, rows))
                held.append(words.cast(pa.binary()))
                n, ends = n + len(words), ends + len(n_words)
                if n > FLUSH_TOKENS:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "c"])

    return map_arrow(training.select(F.col("text").cast("string")), run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Statistics:
    """Corpus counts: N tokens, V words, and the head (word to rank, counts by rank)."""
    n: int
    v: int
    rank: dict[bytes, int]
    counts: np.ndarray

    @property
    def head(self) -> pa.Array:
        """The words by rank."""
        return pa.array(list(self.rank), pa.binary())

    @property
    def known(self) -> int:
        """Words of the model besides the unknown one, which is its last."""
        return min(len(self.counts), VOCABULARY - 1)

    @property
    def rest(self) -> float:
        """log10 of the denominator for words outside the model."""
        return math.log10(self.n - int(self.counts[:self.known].sum()) + self.v - self.known + 1)


def _in_head(n: int) -> Column:
    """Frequent words, and the end however long the documents are: without it there is nothing to start from."""
    return (F.col("c") * HEAD_SHARE > n) | (F.col("word") == F.lit(END))


def statistics(counts: DataFrame) -> Statistics:
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    n = n or 0
    head = counts.filter(_in_head(n)).collect()   # at most HEAD_SHARE rows and the end
    head = sorted(((-r["c"], bytes(r["word"])) for r in head))
    return Statistics(n, v, {w: i for i, (_, w) in enumerate(head)}, np.array([-c for c, _ in head], np.int64))


def initial_model(stats: Statistics) -> dict[str, np.ndarray]:
    """Small random weights; output biases from the training frequencies, so that an untrained model is
    the frequency model. Vocabulary numbers are ranks, the unknown word has the last."""
    rng = np.random.default_rng(6)
    mass = np.zeros(VOCABULARY)
    mass[:stats.known] = stats.counts[:stats.known]
    mass[-1] = max(stats.n - mass.sum(), 0)
    mass = mass + 0.1
    by_class = mass.reshape(CLASSES, PER_CLASS)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {"embed": small(VOCABULARY, EMBED), "wx": small(EMBED, 3 * HIDDEN), "wh": small(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32),
            "wc": np.zeros((HIDDEN, CLASSES), np.float32), "bc": np.log(by_class.sum(1) / mass.sum()).astype(np.float32),
            "ww": np.zeros((CLASSES, HIDDEN, PER_CLASS), np.float32), "bw": np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32)}


def gates(w: np.ndarray) -> np.ndarray:
    """The weights (or biases) of the update gate, the reset gate and the new state as three blocks, each in one piece."""
    return np.ascontiguousarray(w.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))


def halved(blocks: np.ndarray) -> np.ndarray:
    """Blocks with those of the two gates halved, as ``recur`` takes them: the sigmoid of x is tanh(x / 2) / 2 + 1 / 2."""
    return blocks * np.array([0.5, 0.5, 1], blocks.dtype)[:, None, None]


def recur(wh: np.ndarray, xw: np.ndarray, before: np.ndarray, hw: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """One recurrent step for all lanes: the states after it. ``wh`` and ``xw`` (the input's share) are halved blocks; ``xw``
    becomes the two gates and the new state, ``hw`` is room for the state's share, ``reset`` gets what the reset gate lets pass of it."""
    np.matmul(before, wh, out=hw)
    zr, new = xw[:2], xw[2]
    zr += hw[:2]
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    np.multiply(zr[1], hw[2], out=reset)
    new += reset
    np.tanh(new, out=new)
    h = before - new
    h *= zr[0]
    h += new
    return h


def step(model: dict, xw: np.ndarray, h: np.ndarray) -> tuple:
    """One recurrent step for all lanes, with the gates and the new state; xw is the input's share of the three gates."""
    xw = halved(gates(xw))
    hw = np.empty(xw.shape, np.result_type(xw, h))
    return recur(halved(gates(model["wh"])), xw, h, hw, hw[2]), *xw


class Room:
    """Arrays by name that are used again: to get new memory for each window would cost more than much that is done in it."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, kind: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, kind)
        return self.held[name][:size].reshape(shape)


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The targets' order by class, the classes present, and where each begins (and the last ends)."""
    cls = (target // PER_CLASS).astype(np.uint16)
    order = np.argsort(cls, kind="stable")
    present, first = np.unique(cls[order], return_index=True)
    return order, present, np.append(first, len(target))


def _biased(model: dict, w: str, b: str) -> np.ndarray:
    """Weights with their biases as the last row, the weights of an input that is always 1."""
    return np.concatenate((model[w], model[b][..., None, :]), axis=-2)


def _ordered(hs: np.ndarray, order: np.ndarray, room: Room) -> np.ndarray:
    """The states in that order, and an input that is always 1."""
    out = room("ordered", hs.dtype, len(order), HIDDEN + 1)
    out[:, :HIDDEN] = hs[order]
    out[:, HIDDEN] = 1
    return out


def _class_logits(ww: np.ndarray, wide: np.ndarray, present: np.ndarray, at: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Logits of the words of each state's own class."""
    for c, lo, hi in zip(present.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        np.matmul(wide[lo:hi], ww[c], out=out[lo:hi])
    return out


def _log_softmax(logits: np.ndarray, pick: np.ndarray, share: float = 0) -> np.ndarray:
    """Log probability of each row's pick. With a share, logits become the loss's gradient, times that share."""
    rows = np.arange(len(pick))
    if not -80 < logits.min() <= logits.max() < 80:      # exp could overflow, or be zero in a whole row
        logits -= logits.max(axis=1)[:, None]
    own = logits[rows, pick]
    total = np.exp(logits, out=logits) @ np.ones(logits.shape[1], logits.dtype)
    if share:
        logits *= (share / total)[:, None]
        logits[rows, pick] -= share
    return own - np.log(total)


def output(model: dict, hs: np.ndarray, target: np.ndarray, share: float, room: Room) -> tuple[float, np.ndarray, dict]:
    """Natural log probability of all targets, by class and by word in its class; times the share, the gradient of the
    states and the weights' gradients (of the classes present only, which are given with them)."""
    order, present, at = _by_class(target)
    wide, target, kind = _ordered(hs, order, room), target[order], hs.dtype
    wc, ww = _biased(model, "wc", "bc"), np.concatenate((model["ww"], model["bw"][:, None]), axis=1, out=room("ww", kind, CLASSES, HIDDEN + 1, PER_CLASS))
    p = np.matmul(wide, wc, out=room("classes", kind, len(wide), CLASSES))
    logp = _log_softmax(p, target // PER_CLASS, share).sum(dtype=np.float64)
    gc, near = wide.T @ p, np.matmul(p, wc[:HIDDEN].T, out=room("near", kind, len(wide), HIDDEN))
    p = _class_logits(ww, wide, present, at, room("words", kind, len(wide), PER_CLASS))
    logp += _log_softmax(p, target % PER_CLASS, share).sum(dtype=np.float64)
    by_word, gb = room("by_word", kind, len(wide), HIDDEN), np.add.reduceat(p, at[:-1], axis=0)
    gw, hs = room("gw", kind, len(present), HIDDEN, PER_CLASS), wide[:, :HIDDEN]
    for k, (c, lo, hi) in enumerate(zip(present.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)):
        np.matmul(hs[lo:hi].T, p[lo:hi], out=gw[k])
        np.matmul(p[lo:hi], ww[c, :HIDDEN].T, out=by_word[lo:hi])
    near += by_word
    back = room("back", kind, len(wide), HIDDEN)
    back[order] = near
    some = ... if len(present) == CLASSES else present
    return float(logp), back, {"wc": (..., gc[:HIDDEN]), "bc": (..., gc[HIDDEN]), "ww": (some, gw), "bw": (some, gb)}


def log_probability(wc: np.ndarray, ww: np.ndarray, hs: np.ndarray, target: np.ndarray, room: Room) -> np.ndarray:
    """Natural log probability of each target, by weights with their biases."""
    order, present, at = _by_class(target)
    wide, target = _ordered(hs, order, room), target[order]
    p = room("logits", hs.dtype, len(wide), CLASSES)
    logp = _log_softmax(np.matmul(wide, wc, out=p), target // PER_CLASS).astype(np.float64)
    p = room("logits", hs.dtype, len(wide), PER_CLASS)
    logp += _log_softmax(_class_logits(ww, wide, present, at, p), target % PER_CLASS)
    out = np.empty_like(logp)
    out[order] = logp
    return out


def adagrad(weights: np.ndarray, square: np.ndarray, g: np.ndarray, rows: np.ndarray | type(...), rate: float) -> None:
    """One step by the gradient g of those rows. A zero gradient changes nothing."""
    by = g * g
    if rows is ...:
        square += by
        np.sqrt(square, out=by)
    else:
        by += square[rows]
        square[rows] = by
        np.sqrt(by, out=by)
    by += 1e-4
    np.divide(g, by, out=by)
    by *= rate
    weights[rows] -= by


def train_window(model: dict, x: np.ndarray, y: np.ndarray, h: np.ndarray, end: int, square: dict, rate: float = RATE,
                 room: Room | None = None) -> tuple[np.ndarray, float]:
    """One window (lanes x steps): forward, backpropagation within the window, an Adagrad step of the weights that the window
    touches. The state is cleared where the input is an end. Returns the state after the window."""
    lanes, n = x.shape
    room, kind, words = room or Room(), model["wh"].dtype, np.ascontiguousarray(x.T).ravel()
    wx, wh = gates(model["wx"]), gates(model["wh"])
    blocks = lambda name, *of: room(name, kind, *of, n, lanes, HIDDEN)
    inputs = model["embed"][words]
    xw = blocks("xw", 3)
    np.matmul(inputs, halved(wx), out=xw.reshape(3, -1, HIDDEN))
    xw += halved(gates(model["b"]))[:, :, None]
    keep = (words != end).astype(kind).reshape(n, lanes, 1)
    before, states, reset, hw, half = blocks("before"), blocks("states"), blocks("reset"), np.empty((3, lanes, HIDDEN), kind), halved(wh)
    for t in range(n):
        np.multiply(h, keep[t], out=before[t])
        h = states[t] = recur(half, xw[:, t], before[t], hw, reset[t])
    logp, back, grads = output(model, states.reshape(-1, HIDDEN), np.ascontiguousarray(y.T).ravel(), 1 / (lanes * n), room)
    back = back.reshape(n, lanes, HIDDEN)
    # what the gradient of a state is multiplied by: for the state's share of the new state, for the gates, for the new state
    z, r, new = xw
    d, rest = blocks("d", 4), np.subtract(1, z, out=blocks("rest"))
    np.subtract(states, new, out=d[1])
    d[1] *= rest
    np.multiply(new, new, out=d[3])
    np.subtract(1, d[3], out=d[3])
    d[3] *= rest
    np.multiply(d[3], r, out=d[0])
    np.subtract(1, r, out=d[2])
    d[2] *= reset
    d[2] *= d[3]
    to_state, dh, shares = np.ascontiguousarray(wh[[2, 0, 1]].transpose(0, 2, 1)), np.zeros((lanes, HIDDEN), kind), np.empty((3, lanes, HIDDEN), kind)
    for t in reversed(range(n)):
        dh += back[t]
        d[:, t] *= dh
        np.matmul(d[:3, t], to_state, out=shares)
        dh *= z[t]
        for share in shares:
            dh += share
        dh *= keep[t]
    d = d.reshape(4, -1, HIDDEN)
    flat = lambda three: three.transpose(1, 0, 2).reshape(-1, 3 * HIDDEN)
    grads["wh"] = ..., flat(np.matmul(before.reshape(-1, HIDDEN).T, d[:3])[[1, 2, 0]])
    grads["wx"] = ..., flat(np.matmul(inputs.T, d[1:]))
    grads["b"] = ..., np.matmul(np.ones((1, lanes * n), kind), d[1:]).ravel()
    by_gate = np.matmul(d[1:], wx.transpose(0, 2, 1), out=room("by_gate", kind, 3, lanes * n, EMBED))
    by_gate[0] += by_gate[1]
    by_gate[0] += by_gate[2]
    order = np.argsort(words.astype(np.uint16), kind="stable")      # VOCABULARY is far below 1 << 16
    touched, first = np.unique(words[order], return_index=True)
    grads["embed"] = touched, np.add.reduceat(by_gate[0][order], first, axis=0)
    for k, (rows, g) in grads.items():
        adagrad(model[k], square[k], g, rows, rate)
    return h, logp


def train_stream(model: dict, stream: np.ndarray, end: int, square: dict, room: Room | None = None) -> None:
    """Train on one stream of vocabulary numbers, laid out in lanes (fewer for short streams, so that
    these too get about ``WINDOWS`` steps)."""
    lanes = min(LANES, max(1, len(stream) // (WINDOWS * STEPS)))
    length = len(stream) // lanes
    y = stream[:lanes * length].reshape(lanes, length)
    x = np.concatenate((np.full((lanes, 1), end, stream.dtype), y[:, :-1]), axis=1)
    h, room = np.zeros((lanes, HIDDEN), np.float32), room or Room()
    for t in range(0, length, STEPS):
        h, _ = train_window(model, x[:, t:t + STEPS], y[:, t:t + STEPS], h, end, square, room=room)


def _ranks(words: pa.Array, head: pa.Array) -> np.ndarray:
    """Rank of each word, -1 outside the head."""
    return np.asarray(pc.fill_null(pc.index_in(words, value_set=head.cast(words.type)), -1))


def _vocabulary(ranks: np.ndarray, stats: Statistics) -> np.ndarray:
    return np.where((ranks >= 0) & (ranks < stats.known), ranks, VOCABULARY - 1)


def train(training: DataFrame, stats: Statistics) -> dict[str, np.ndarray]:
    """The model, averaged over all tasks' copies by tokens."""
    start = initial_model(stats)
    if END not in stats.rank:
        return start
    end = int(_vocabulary(np.array([stats.rank[END]]), stats)[0])
    names = list(start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, square, seen = {k: v.copy() for k, v in start.items()}, {k: np.full_like(v, 1e-6) for k, v in start.items()}, 0
        pending, held, head, room = [], 0, stats.head, Room()

        def learn() -> None:
            train_stream(model, np.concatenate(pending), end, square, room)

        for b in batches:
            for lo, rows in pieces(b.column(0)):
                words, n_words = split_words(b.column(0).slice(lo, rows))
                numbers = with_ends(_vocabulary(_ranks(words, head), stats), n_words, end)
                for ids in np.split(numbers, np.cumsum(n_words + 1)[:-1]):
                    pending.append(ids)
                    held += len(ids)
                    seen += len(ids)
                    if held >= CHUNK_TOKENS:
                        learn()
                        pending, held = [], 0
        if pending:
            learn()
        if seen:
            yield _blocks({name: model[name].astype(np.float64).ravel() * seen for name in names}, seen)

    copies = map_arrow(training.select(F.col("text").cast("string")), run, BLOCKS)
    # in two steps, so that neither reads more than about the root of the number of tasks
    tasks = training.rdd.getNumPartitions()
    for parts in (math.isqrt(max(1, tasks)) + 1, 1):
        copies = map_arrow(copies.repartition(parts), _add_blocks, BLOCKS)
    model = {k: v.copy() for k, v in start.items()}
    for r in copies.collect():      # one model
        model[r["name"]].ravel()[:] = np.round(np.frombuffer(r["block"], np.float64) / r["weight"], 6)
    return model


BLOCKS = "name string, block binary, weight bigint"


def _blocks(sums: dict[str, np.ndarray], weight: int) -> pa.RecordBatch:
    """One row per parameter: the weighted sum of its copies, and the weight."""
    return pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([x.tobytes() for x in sums.values()], pa.binary()),
                                       pa.array([weight] * len(sums), pa.int64())], names=["name", "block", "weight"])


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a partition's blocks; one model is held, however many there are."""
    sums: dict[str, np.ndarray] = {}
    weights: Counter = Counter()
    for b in batches:
        for name, block, weight in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            sums[name] = sums.get(name, 0.0) + np.frombuffer(block, np.float64)
            weights[name] += weight
    for name, x in sums.items():
        yield _blocks({name: x}, weights[name])


def score_documents(model: dict, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log probability of each whole sequence of vocabulary numbers. Documents of similar length run side by
    side, longest first; their state is carried from window to window."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    kind, room = model["wh"].dtype, Room()
    table = halved(gates(model["embed"] @ model["wx"] + model["b"])).astype(kind)
    wh, wc, ww = halved(gates(model["wh"])), _biased(model, "wc", "bc"), _biased(model, "ww", "bw")
    out = np.zeros(len(docs))
    for lo in range(0, len(docs), SCORE_LANES):
        own = order[lo:lo + SCORE_LANES]
        lengths = np.array([len(docs[i]) for i in own])
        flat = np.concatenate([docs[i] for i in own])
        begin = np.cumsum(lengths) - lengths
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")      # documents with a token at each step
        h, last, total, t = np.zeros((len(own), HIDDEN), kind), np.full(len(own), end), np.zeros(len(own)), 0
        while t < lengths[0]:
            m = int(alive[t])
            n = int(min(max(1, SCORE_TOKENS // m), lengths[0] - t))
            at = t + np.arange(n)[:, None]
            now = at < lengths[:m]
            target = flat[np.minimum(begin[:m] + at, len(flat) - 1)]
            xw = np.take(table, np.concatenate((last[None, :m], target[:-1])), axis=1, out=room("xw", kind, 3, n, m, HIDDEN), mode="clip")
            states, hw = room("states", kind, n, m, HIDDEN), room("hw", kind, 3, m, HIDDEN)
            for s, k in enumerate(alive[t:t + n].tolist()):
                h = states[s, :k] = recur(wh, xw[:, s, :k], h[:k], hw[:, :k], hw[2, :k])
            last = target[-1]
            if now.all():
                total[:m] += log_probability(wc, ww, states.reshape(-1, HIDDEN), target.ravel(), room).reshape(n, m).sum(0)
            else:
                total[:m] += np.bincount(np.nonzero(now)[1], log_probability(wc, ww, states[now], target[now], room), m)
            t += n
        out[own] = total
    return out


SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_head bigint, head_base double, head_score double, word binary, rows array<bigint>"


def by_word(words: pa.Array, rows: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The distinct words, and for each a list of the rows it stands in, a row once for each time."""
    coded = words.cast(pa.binary()).dictionary_encode()
    codes = np.asarray(coded.indices)
    at = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=len(coded.dictionary)))))
    return coded.dictionary, pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(rows[np.argsort(codes, kind="stable")], pa.int64()))


def lm_score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    training = docs.filter(~held_out(F.col("doc_id")))
    counts = stage(word_counts(training), "word-counts")
    stats = statistics(counts)
    model = train(training, stats)
    end = int(_vocabulary(np.array([stats.rank.get(END, -1)]), stats)[0])
    log_c = np.log10(stats.counts + 1.0)
    shared = docs.sparkSession.sparkContext.broadcast((stats, model, log_c))   # at most HEAD_SHARE words

    names = [field.split()[0] for field in SCORED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, model, log_c = shared.value
        head_words = stats.head
        for b in batches:
            for lo, rows in pieces(b.column(2)):
                part = b.slice(lo, rows)
                words, n_words = split_words(part.column(2))
                ranks = _ranks(words, head_words)
                rare = ranks < 0
                tail, tail_rows = by_word(words.filter(pa.array(rare)), np.repeat(np.asarray(part.column(0)), n_words)[rare])
                ranks = with_ends(ranks, n_words, stats.rank.get(END, -1))
                head, outside = ranks >= 0, ranks >= stats.known
                first = np.cumsum(n_words + 1) - n_words - 1
                logs = np.append(log_c, 0.0)[ranks]      # 0 outside the head
                per_row = lambda x: np.add.reduceat(x, first)
                n_outside = per_row((outside | ~head).astype(np.int64))
                logp = score_documents(model, np.split(_vocabulary(ranks, stats), first[1:]), end) / math.log(10)
                found = [part.column(0), part.column(1), pa.array(n_words + 1, pa.int64()), pa.array(per_row(head.astype(np.int64))), pa.array(per_row(logs)),
                         pa.array(logp + per_row(logs * outside) - n_outside * stats.rest)]
                yield pa.RecordBatch.from_arrays([*found, pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.list_(pa.int64()))], names=names)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(tail), x.type) for x in found), tail, tail_rows], names=names)

    # rows, and beside them each piece's rare words with the rows that they stand in
    scored = stage(map_arrow(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), run, SCORED), "lm-scored")
    tail = scored.filter("word is not null").select("word", "rows")
    rare = counts.filter(~_in_head(stats.n)).select("word", F.log10(F.col("c") + 1.0).alias("log_c"))
    # words are distinct on the counts' side, so that a partition's hash table is a share of the vocabulary
    found = (tail.join(rare.hint("shuffle_hash"), "word").select("log_c", F.explode("rows").alias("row"))
             .groupBy("row").agg(F.sum("log_c").alias("tail_log"), F.count("*").alias("n_tail")))
    out = scored.filter("word is null").drop("word", "rows").join(found, "row", "left")
    none = F.lit(0.0)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_head") + F.coalesce("n_tail", F.lit(0))).alias("n_known"),
        F.lit(stats.n).cast("bigint").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_log", none) - F.col("n_tokens") * math.log10(stats.n + stats.v + 1)).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_log", none)).alias("score"))
