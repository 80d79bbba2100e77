"""Fill-in-the-middle transformation (operator 12): Fenwick trees over fixed text blocks.

A text is a run of units: code points, or the places where ``unit`` (a regular expression) matches,
found from left to right; what stands between two matches belongs to the unit before it, what stands
before the first match to the first unit. The UTF-8 bytes are dealt into blocks of ``block_bytes``. A
Fenwick tree over the blocks holds, in each node, the units and the code points that begin in the
node's blocks. A cut after u units is found by binary lifting: the descent adds the largest steps
whose units do not pass u and ends in the block where unit u begins; only that block is looked at to
find the byte, and the code points before the cut are the descent's sum plus those of the block.

Two cuts per row come from the SHA-256 of ``seed:doc_id``. The text between them is the middle. The
output carries the markers of ``Markers`` in the order prefix, suffix, middle (psm) or suffix, prefix,
middle (spm), or the text as it is (plain). ``restore`` rebuilds the text from output and form.

Defined results: a null text counts as empty. Empty texts, texts that hold a marker, and a share of
the others by hash stay plain. A null doc_id is hashed as an empty string. Each row is decided alone, so
rows that repeat a doc_id or a text do not matter, and ties cannot occur; equal cuts give an empty
middle. A text of any length is held once, with three bytes of counters for each of its bytes. An empty
table gives an empty result. Extra columns stay; the results replace columns of their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import raw_bytes

BLOCK_BYTES = 512
SEED = 1
#: Of 100: hashes from PLAIN_FROM on stay plain; of the others, those under SPM_BELOW put the suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20
#: Results are handed on once they hold so many bytes, so a run of long texts is never one batch.
BATCH_BYTES = 8 << 20
RESULTS = (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
           ("middle_chars", T.LongType()), ("output", T.StringType()))


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def fenwick(counts: np.ndarray) -> np.ndarray:
    """Trees (columns) over the rows of ``counts``: node i (from 1) sums the lowbit(i) rows that end at i."""
    tree = np.zeros((len(counts) + 1, counts.shape[1]), dtype=np.int64)
    tree[1:] = counts
    step = 1
    while step < len(tree):      # all nodes whose lowest bit is ``step`` are whole; hand them to their parents
        nodes = np.arange(step, len(tree), 2 * step)
        parents = nodes + step
        inside = parents < len(tree)
        tree[parents[inside]] += tree[nodes[inside]]
        step *= 2
    return tree


def descend(tree: np.ndarray, rank: int) -> tuple[int, int, int]:
    """The block that holds the unit of ``rank`` (from 0), and the units and code points before it."""
    at, units, points = 0, 0, 0
    step = 1 << (len(tree) - 1).bit_length()
    while step:
        to = at + step
        if to < len(tree) and units + tree[to, 0] <= rank:
            at, units, points = to, units + int(tree[to, 0]), points + int(tree[to, 1])
        step >>= 1
    return at, units, points


class Cutter:
    """The units of one text, and the places of cuts in it."""

    def __init__(self, data: bytes, unit: re.Pattern | None = None, block_bytes: int = BLOCK_BYTES):
        self.size, self.block = len(data), block_bytes
        points = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80      # a code point begins here
        begins = points
        if unit is not None:
            places = [m.start() for m in unit.finditer(data.decode("utf-8")) if m.end() > m.start()]
            begins = np.zeros(self.size, dtype=bool)
            begins[np.flatnonzero(points)[places]] = True
        self.points, self.begins = points, begins
        if self.size:
            edges = np.arange(0, self.size, block_bytes)
            self.tree = fenwick(np.column_stack([np.add.reduceat(x, edges, dtype=np.int64) for x in (begins, points)]))
        else:
            self.tree = np.zeros((1, 2), dtype=np.int64)
        self.units, self.chars = (self._total(k) for k in (0, 1))

    def _total(self, k: int) -> int:
        i, out = len(self.tree) - 1, 0
        while i:
            out, i = out + int(self.tree[i, k]), i & (i - 1)
        return out

    def cut(self, units: int) -> tuple[int, int]:
        """Byte and code point where the text after ``units`` units begins."""
        if units <= 0:
            return 0, 0
        if units >= self.units:
            return self.size, self.chars
        block, before, chars = descend(self.tree, units)
        low = block * self.block
        byte = int(np.flatnonzero(self.begins[low:low + self.block])[units - before])
        return low + byte, chars + int(self.points[low:low + byte].sum())


def transform(doc_id: int | None, data: bytes, markers: Markers = Markers(), unit: re.Pattern | None = None,
              seed: int = SEED, block_bytes: int = BLOCK_BYTES) -> tuple[int, str, int | None, int | None, bytes]:
    """``(units, form, code points of the prefix, of the middle, output)`` of one text."""
    pre, suf, mid = (m.encode() for m in (markers.prefix, markers.suffix, markers.middle))
    text = Cutter(data, unit, block_bytes)
    n = text.units
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[4 * i:4 * i + 4], "big") for i in range(4))
    if not data or pre in data or suf in data or mid in data or h3 % 100 >= PLAIN_FROM:
        return n, "plain", None, None, data
    (a, a_chars), (b, b_chars) = (text.cut(u) for u in sorted((h1 % (n + 1), h2 % (n + 1))))
    if h4 % 100 < SPM_BELOW:
        form, parts = "spm", (suf, data[b:], pre, data[:a], mid, data[a:b])
    else:
        form, parts = "psm", (pre, data[:a], suf, data[b:], mid, data[a:b])
    return n, form, a_chars, b_chars - a_chars, b"".join(parts)


def fill_middle(docs: DataFrame, markers: Markers = Markers(), unit: str | None = None, seed: int = SEED,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs(doc_id, text, ...)`` plus n (units), form, prefix_chars, middle_chars and output; one
    pass over the rows, no shuffle. No marker may begin with what another one ends with."""
    names = [name for name, _ in RESULTS]
    kept = [c for c in docs.columns if c not in names]
    held = docs.select(*kept)
    schema = T.StructType([*held.schema.fields, *(T.StructField(name, kind) for name, kind in RESULTS)])
    pattern = None if unit is None else re.compile(unit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), raw_bytes(batch.column("text"))
            start, size, out = 0, 0, []
            for i, (doc_id, data) in enumerate(zip(ids, texts)):
                out.append(transform(doc_id, data or b"", markers, pattern, seed, block_bytes))
                size += len(out[-1][-1])
                if size > BATCH_BYTES or i + 1 == len(ids):
                    part = batch.slice(start, i + 1 - start)
                    n, form, prefix, middle, output = zip(*out)
                    columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                               pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())]
                    yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])
                    start, size, out = i + 1, 0, []

    return held.mapInArrow(run, schema)


def restore(output: str = "output", form: str = "form", markers: Markers = Markers()) -> Column:
    """The text that ``fill_middle`` was given, as a native expression on its output and form."""
    pre, suf, mid = F.lit(markers.prefix), F.lit(markers.suffix), F.lit(markers.middle)
    text, first, second = F.col(output), F.lit(1), F.lit(2)

    def between(opening: Column, closing: Column) -> Column:
        return F.split_part(F.split_part(text, opening, second), closing, first)

    middle = F.split_part(text, mid, second)
    return (F.when(F.col(form) == "psm", F.concat(between(pre, suf), middle, between(suf, mid)))
            .when(F.col(form) == "spm", F.concat(between(pre, mid), middle, between(suf, pre)))
            .otherwise(text))
