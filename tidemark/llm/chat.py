"""Chat formatting (operator 4): transcript parsing with a hidden Markov model.

A transcript is its lines ``(conv_id, seq, line)``, ordered by seq. The hidden state of a line is a
role and whether the line begins a turn; it emits the speaker marker in front of the line and
line features (blank, question, length) as independent categories. Parameters are counted by
Spark on labelled lines, with add-``SMOOTH`` smoothing. Viterbi finds the most probable states; turns
run from one beginning to the next and are rendered as ``<|role|>``, the text without markers, ``<|end|>``.

A transcript of any length is decoded exactly and in bounded memory. Lines are cut into blocks by
seq; a block is summed up as the best log probability from each state before it to each state at
its end (a max-plus product); blocks are combined in groups of ``FAN`` up to one per transcript,
whose best end state is then handed down: within a group with given ends, Viterbi over the children's
sums fixes each child's ends, down to the lines of a block. No transcript is collected in one task.

Defined results: a null line is an empty one; lines with a null conv_id form one transcript; lines
that share a seq are ordered by their text. Ties go to the state first in ``STATES``. Lines before the first turn
that is marked as beginning belong to turn 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow, stage

ROLES = ("system", "user", "assistant")
STATES = tuple((r, b) for r in ROLES for b in ("begin", "inside"))
S = len(STATES)
START = S
#: Speaker names that stand for a role.
NAMES = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "customer", "q", "question", "prompter", "me"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "agent", "model"),
}
_CLASS = {n: 1 + ROLES.index(r) for r, ns in NAMES.items() for n in ns}
N_MARKERS = 2 + len(ROLES)      # none, one for each role, another speaker
_MARKER = re.compile(r"\s*(?:[#>*\-]{1,4}\s*)?(?:<\|(\w{1,20})\|>|\[(\w{1,20})\]|\*{0,2}([^\W\d_]\w{0,19})\*{0,2}\s?:)(?:\*\*)?[ \t]*")
N_QUESTION, N_LENGTH = 2, 5
SMOOTH = 0.5
#: Blocks are ``seq >> BLOCK_SHIFT``; FAN of them are combined at each level.
BLOCK_SHIFT, FAN = 30, 64
NEVER = -1e18


def marker(line: str) -> tuple[int, str]:
    """Class of the speaker marker in front of a line, and the line without it."""
    m = _MARKER.match(line)
    if not m:
        return 0, line
    name = (m[1] or m[2] or m[3]).lower()
    kind = _CLASS.get(name, N_MARKERS - 1)
    if kind == N_MARKERS - 1 and len(line[m.end():].split()) < 1:
        return 0, line      # an unknown name alone on its line is text
    return kind, line[m.end():]


def features(line: str | None) -> int:
    """The line's observation as one number: marker, question, length."""
    kind, rest = marker(line or "")
    n = len(rest.split())
    length = 0 if n == 0 else 1 if n < 8 else 2 if n < 24 else 3 if n < 64 else 4
    return (kind * N_QUESTION + rest.rstrip().endswith("?")) * N_LENGTH + length


class Model:
    """Log probabilities: ``start`` (S), ``move`` (S x S), ``emit`` (S x observations)."""

    def __init__(self, move: np.ndarray, marker_: np.ndarray, question: np.ndarray, length: np.ndarray):
        def log(x: np.ndarray) -> np.ndarray:
            x = x + SMOOTH
            return np.log(x / x.sum(axis=-1, keepdims=True))

        moves = log(move.astype(float))     # (S + 1) x S, the last row from the start
        begins = np.array([b == "begin" for _, b in STATES])
        same = np.array([[a == b for b, _ in STATES] for a, _ in STATES] + [[False] * S])
        self.moves = np.where(~begins[None, :] & ~same, NEVER, moves)   # a turn goes on in its own role
        m, q, n = log(marker_.astype(float)), log(question.astype(float)), log(length.astype(float))
        self.emit = (m[:, :, None, None] + q[:, None, :, None] + n[:, None, None, :]).reshape(S, -1)


def observed(lines: DataFrame) -> DataFrame:
    """``lines`` with ``obs``, their observation."""
    @F.pandas_udf("int")
    def obs(line: pd.Series) -> pd.Series:
        return line.map(features)

    return lines.withColumn("obs", obs(F.coalesce(F.col("line").cast("string"), F.lit(""))))


def fit(labelled: DataFrame) -> Model:
    """From labelled lines (conv_id, seq, line, role, begin); lines whose role is none of ``ROLES`` are left out.
    The counts that reach the driver are bounded by the numbers of states and observations."""
    names = F.create_map(*(x for i, (r, b) in enumerate(STATES) for x in (F.lit(f"{r} {b}"), F.lit(i))))
    state = names[F.concat(F.col("role"), F.when(F.col("begin"), F.lit(" begin")).otherwise(F.lit(" inside")))]
    rows = observed(labelled).withColumn("state", state).filter("state is not null").select("conv_id", "seq", "state", "obs", "before")
    marks, questions, lengths = np.zeros((S, N_MARKERS)), np.zeros((S, N_QUESTION)), np.zeros((S, N_LENGTH))
    move = np.zeros((S + 1, S))
    for r in rows.groupBy("state", "obs").count().collect():
        kind, rest = divmod(r["obs"], N_QUESTION * N_LENGTH)
        marks[r["state"], kind] += r["count"]
        questions[r["state"], rest // N_LENGTH] += r["count"]
        lengths[r["state"], rest % N_LENGTH] += r["count"]
    # the state before a line: its own turn's, or what ``before`` says of the turn before it
    for r in rows.groupBy(F.coalesce("before", F.lit(START)).alias("before"), "state").count().collect():
        move[r["before"], r["state"]] += r["count"]
    return Model(move, marks, questions, lengths)


def line_sum(model: Model, obs: list[int]) -> np.ndarray:
    """Best log probability from each state before the lines (or the start) to each state of the last."""
    out = None
    for o in obs:
        one = model.moves + model.emit[None, :, o]
        out = one if out is None else (out[:, :, None] + one[None, :S, :]).max(axis=1)
    return out


def combine(sums: list[np.ndarray]) -> np.ndarray:
    out = sums[0]
    for m in sums[1:]:
        out = (out[:, :, None] + m[None, :S, :]).max(axis=1)
    return out


def best_ends(sums: list[np.ndarray], before: int, end: int) -> list[int]:
    """State after each of the given parts on the best path from ``before`` to ``end``."""
    score, back = sums[0][before], []
    for m in sums[1:]:
        via = score[:, None] + m[:S]
        back.append(via.argmax(axis=0))
        score = via.max(axis=0)
    out = [end]
    for choice in reversed(back):
        out.append(int(choice[out[-1]]))
    return out[::-1]


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """``(conv_id, block, seq, line, state)``: the states of the best path through each transcript."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("\x00none"))
    blocks = (observed(lines).select("conv_id", key.alias("conv"), F.shiftright("seq", BLOCK_SHIFT).alias("idx"), "seq", "line", "obs")
              .groupBy("conv", "idx").agg(F.array_sort(F.collect_list(F.struct("seq", "line", "conv_id", "obs"))).alias("lines")))
    blocks = stage(blocks, "chat-blocks")    # a block's lines; never a transcript's
    flat = "conv string, idx bigint, sums array<double>"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums = [line_sum(model, [x["obs"] for x in lines]).ravel().tolist() for lines in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sums, pa.list_(pa.float64()))], names=["conv", "idx", "sums"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        m = combine([np.array(x).reshape(S + 1, S) for x in pdf["sums"]])
        return pd.DataFrame({"conv": pdf["conv"].iloc[:1], "idx": [pdf["group"].iloc[0]], "sums": [m.ravel().tolist()]})

    group = F.floor(F.col("idx") / FAN).cast("bigint").alias("group")

    @F.pandas_udf("int")
    def best_end(sums: pd.Series) -> pd.Series:
        return sums.map(lambda x: int(np.array(x).reshape(S + 1, S)[START].argmax())).astype("int32")

    def hand_down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        after = best_ends([np.array(x).reshape(S + 1, S) for x in pdf["sums"]], int(pdf["before"].iloc[0]), int(pdf["end"].iloc[0]))
        return pd.DataFrame({"conv": pdf["conv"], "idx": pdf["idx"], "before": [int(pdf["before"].iloc[0]), *after[:-1]], "end": after})

    # up: a transcript that is down to one part is done; only the longer ones are combined further
    level, whole, parts = stage(map_arrow(blocks.select("conv", "idx", "lines"), first, flat), "chat-level-0"), [], []
    while True:
        longer = level.filter("idx > 0").select("conv").distinct()
        if longer.isEmpty():
            whole.append(level)
            break
        longer = stage(longer, "chat-longer")
        whole.append(level.join(longer, "conv", "left_anti"))
        parts.append(stage(level.join(longer, "conv", "left_semi").select("conv", "idx", "sums", group), f"chat-parts-{len(parts)}"))
        level = stage(parts[-1].groupBy("conv", "group").applyInPandas(merge, flat), f"chat-level-{len(parts)}")
    # down: the ends of a transcript's one part, then of the parts it was combined from
    ends = None
    for k in range(len(whole) - 1, -1, -1):
        done = whole[k].select("conv", "idx", F.lit(START).alias("before"), best_end("sums").alias("end"))
        if ends is not None:
            up = ends.select("conv", F.col("idx").alias("group"), "before", "end")
            handed = (parts[k].join(up, ["conv", "group"]).groupBy("conv", "group")
                      .applyInPandas(hand_down, "conv string, idx bigint, before int, end int"))
            done = done.unionByName(handed)
        ends = done

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            states = []
            for lines, before, end in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                states.append(best_ends([line_sum(model, [x["obs"]]) for x in lines], before, end))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(states, pa.list_(pa.int32()))], names=["conv", "idx", "lines", "states"])

    inner = blocks.schema["lines"].dataType.simpleString()
    decoded = map_arrow(blocks.join(ends, ["conv", "idx"]).select("conv", "idx", "lines", "before", "end"), last,
                        f"conv string, idx bigint, lines {inner}, states array<int>")
    each = decoded.select("conv", "idx", F.posexplode(F.arrays_zip("lines", "states")).alias("at", "x"))
    return each.select("conv", "idx", "at", F.col("x.lines.conv_id").alias("conv_id"), F.col("x.lines.seq").alias("seq"),
                       F.col("x.lines.line").alias("line"), F.col("x.states").alias("state"))


def is_begin(state: Column) -> Column:
    return (state % 2 == 0).cast("int")


def role_of(state: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(state / 2) + 1).cast("int"))


def turns(decoded: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, n_lines, text)``: canonical rendering of the recovered turns.

    A line's turn is the number of beginnings up to it: those of its block's earlier lines, and the
    running sum over the blocks before (one row for each block)."""
    from pyspark.sql import Window

    decoded = stage(decoded, "chat-decoded")
    within = Window.partitionBy("conv", "idx").orderBy("at")
    over = Window.partitionBy("conv").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    blocks = decoded.groupBy("conv", "idx").agg(F.sum(is_begin(F.col("state"))).alias("n"))
    offsets = blocks.select("conv", "idx", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("offset"))
    lines = decoded.withColumn("inner", F.sum(is_begin(F.col("state"))).over(within)).join(offsets, ["conv", "idx"])

    @F.pandas_udf("string")
    def bare(line: pd.Series) -> pd.Series:
        return line.map(lambda x: marker(x)[1])

    lines = lines.select("conv_id", (F.col("offset") + F.col("inner")).alias("turn"), role_of(F.col("state")).alias("role"),
                         F.struct("idx", "at", bare(F.coalesce("line", F.lit(""))).alias("line")).alias("x"))
    grouped = lines.groupBy("conv_id", "turn", "role").agg(F.array_sort(F.collect_list("x")).alias("xs"))   # one turn's lines
    text = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.array_join(F.transform("xs", lambda x: x["line"]), "\n"), F.lit("\n<|end|>"))
    return grouped.select("conv_id", "turn", "role", F.size("xs").cast("bigint").alias("n_lines"), text.alias("text"))


#: How raw transcripts mark speakers: (system, user, assistant) by style; the last has no markers.
STYLES = (("System: ", "User: ", "Assistant: "), ("Context: ", "Q: ", "A: "), ("[system] ", "[human] ", "[ai] "),
          ("**Instructions**: ", "**Customer**: ", "**Agent**: "), ("", "", ""))


def raw_lines(conversations: DataFrame) -> DataFrame:
    """Transcripts of a conversations table as lines with their labels: (conv_id, seq, line, role, begin, before).
    Each turn's first line gets a marker in a style that the conversation's hash picks."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))).cast("int")
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.coalesce("role", F.lit("user"))).cast("int")
    prefix = F.element_at(F.element_at(F.array(*(F.array(*map(F.lit, s)) for s in STYLES)), style + 1), F.greatest(role, F.lit(1)))
    text = F.when(role > 0, F.concat(prefix, F.coalesce("text", F.lit("")))).otherwise(F.coalesce("text", F.lit("")))
    t = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                             F.col("text").cast("string").alias("text")).withColumn("lines", F.split(text, "\n", -1))
    # the last state of the turn before: an equi-join on (conv_id, turn), which no conversation makes hot
    last = t.filter("conv_id is not null and turn is not null").groupBy((F.col("turn") + 1).alias("turn"), "conv_id").agg(
        F.max((role - 1) * 2 + F.when(F.size("lines") > 1, 1).otherwise(0)).alias("last"))
    own = (role - 1) * 2
    t = t.withColumn("own", own).join(last, ["conv_id", "turn"], "left")
    lines = t.select("conv_id", "turn", "role", "own", "last", F.posexplode("lines").alias("at", "line"))
    before = F.when(F.col("at") == 0, F.col("last")).when(F.col("at") == 1, F.col("own")).otherwise(F.col("own") + 1)
    seq = F.shiftleft(F.coalesce("turn", F.lit(0)).cast("bigint"), 24) + F.col("at")
    return lines.select("conv_id", seq.alias("seq"), "line", "role", (F.col("at") == 0).alias("begin"),
                        F.when(before >= 0, before).cast("int").alias("before"))


def chat_format(conversations: DataFrame, hold_out: int = 5) -> DataFrame:
    """Recovered and rendered turns of all conversations; fitted on those whose conv_id is not held out."""
    lines = stage(raw_lines(conversations), "chat-lines")
    known = lines.filter(F.coalesce(F.crc32(F.col("conv_id").cast("string").cast("binary")) % hold_out != 0, F.lit(False)))
    return turns(decode(lines.select("conv_id", "seq", "line"), fit(known)))
