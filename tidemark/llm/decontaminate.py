"""Benchmark decontamination (operator 9): latent semantic retrieval.

1. The benchmark gives items, each a sequence of words, and their vocabulary (in slices by hash where it is too large
   for a task). One pass over the documents turns every whole text into vocabulary numbers (0: any other word,
   which cannot match an item), staged in the shared folder; later passes read those.
2. Passages are windows of whole blocks of ``BLOCK`` words, one starting at every block: two blocks for
   items of up to 64 words, four for up to 128, and so on. Inverse document frequencies come from all blocks
   of all documents. There are no stop words: an item in many documents makes its own words common, so common words
   only weigh less.
3. A randomised SVD of the TF-IDF matrix of passages fits the index. Tasks multiply their rows into a
   vocabulary x rank sketch, Spark sums the sketches and the driver orthonormalises that sum (bounded by the
   benchmark's vocabulary). The rows are the two-block passages of all documents and all benchmark items,
   which together weigh ``ITEM_MASS`` times as much.
4. All passages of all documents are compared to the items by cosine in the latent space, the items as the
   stated query set, in blocks. Candidates reach the item's least cosine (``least_cosines``) and have enough of the item's words in any order, in whole
   blocks around the window, for ``PARAPHRASE`` (others cannot be verified: a subsequence is not longer).
5. Every candidate is verified: the longest common subsequence of item and passage (widened
   by the item's length), in words of the whole item, must cover ``SIMILARITY`` of the item. Paraphrases
   that reach only ``PARAPHRASE`` must hold the item's answer too: its ``answer`` column where there is
   one, else its last or its rarest ``ANSWER_WORDS`` words, again to ``SIMILARITY``, and close together. (The bound
   on words in any order is taken again in the exact passage before it is aligned.)
6. Items under ``MIN_ITEM_WORDS`` words are no passages; they are found where their words stand one after the other.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Defined results: one row for each (doc_id, item_id) found, none for others. Null and empty texts
and items match nothing. Items with equal words are found alike. Repeated
rows are merged to the best hit; rows with a null doc_id are reported under null. An empty table
or benchmark gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, keep_rows, map_arrow, numbered, raw_bytes, stage

BLOCK = 32
RANK = 128
ITEM_MASS = 8
MIN_ITEM_WORDS = 5
#: An item's least cosine: COSINE_RATE times the root of its share of a window's words, within these bounds.
COSINE, COSINE_MOST, COSINE_RATE = 0.25, 0.4, 0.55
SIMILARITY, PARAPHRASE = 0.8, 0.65
ANSWER_WORDS = 8
#: A slice of the benchmark is held by the driver and every task, and so is a table of its vocabulary x rank.
SLICE_BYTES, SLICE_WORDS = 64 << 20, 100_000
#: Items that a block of passages is compared with at a time.
ITEM_BLOCK = 2048
#: Words of documents that a task works on at a time; longer texts are cut into overlapping pieces.
SLAB = 1 << 17
#: Blocks whose word vectors are summed side by side.
SUM_BLOCKS = 1024
#: Bytes of a table of vocabulary x blocks.
PRESENT_BYTES = 32 << 20

#: Lower-cases A-Z and blanks every byte that is not part of a word.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_WORD_BYTES).split()


def lcs(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Length of the longest common subsequence, by bit-parallel rows over the bits of ``a``, and the
    number of places of ``b`` up to the one that completes it."""
    masks: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v, best, end = full, 0, 0
    for j, w in enumerate(b.tolist()):
        m = masks.get(w)
        if m is not None:
            u = v & m
            v = (v + u | v - u) & full
            got = len(a) - v.bit_count()
            if got > best:
                best, end = got, j + 1
    return best, end


class Benchmark:
    """The items as vocabulary numbers (1..size); those of under ``MIN_ITEM_WORDS`` words apart, as ``short``."""

    def __init__(self, items: list[tuple[int, bytes | None, bytes | None]]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids, self.items, self.answers, self.short = [], [], [], []
        for item_id, text, answer in items:
            code = self._codes(words(text))
            if 0 < len(code) < MIN_ITEM_WORDS:
                self.short.append((item_id, code))
            elif len(code):
                self.ids.append(item_id)
                self.items.append(code)
                own = self._codes(words(answer))
                self.answers.append([own] if len(own) else [])

    def _codes(self, found: list[bytes]) -> np.ndarray:
        return np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in found], np.int32)

    def set_answers(self, weight: np.ndarray) -> None:
        """Items without an answer of their own are known by their last ``ANSWER_WORDS`` words, where answers
        stand, and by as many of their rarest words, in the item's order."""
        for k, item in enumerate(self.items):
            if not self.answers[k]:
                rarest = item[np.sort(np.argsort(-weight[item], kind="stable")[:ANSWER_WORDS])]
                self.answers[k] = [item[-ANSWER_WORDS:], rarest]

    @classmethod
    def slices(cls, benchmark: DataFrame, max_bytes: int, max_words: int) -> Iterator[Benchmark]:
        """The benchmark in parts that the driver and every task can hold: halved by hash until the texts have
        at most ``max_bytes`` and ``max_words`` words, or are one text."""
        text = F.col("text").cast("string")
        answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
        rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text.cast("binary").alias("t"),
                                answer.cast("binary").alias("a")).distinct()
        todo = [(rows, 0)]
        while todo:
            part, level = todo.pop()
            length = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("t", "a")]
            n, size = part.agg(F.count("*"), F.sum(length[0] + length[1] + 100)).first()
            if not n:
                continue
            if size > max_bytes and n > 1:
                todo += cls._halves(part, level)
                continue
            found = part.collect()   # bounded by the check above
            out = cls(sorted(((r["item_id"], r["t"] and bytes(r["t"]), r["a"] and bytes(r["a"])) for r in found),
                             key=lambda r: (r[0] is None, r[0] or 0, r[1] or b"", r[2] or b"")))
            if len(out.vocabulary) > max_words and n > 1:
                todo += cls._halves(part, level)
            else:
                yield out

    @staticmethod
    def _halves(part: DataFrame, level: int) -> list[tuple[DataFrame, int]]:
        # other bits at every level: the hash is taken over the row and the level
        bit = F.pmod(F.xxhash64("item_id", "t", "a", F.lit(level)), F.lit(2))
        return [(part.filter(bit == i), level + 1) for i in range(2)]


def encode(docs: DataFrame, bench: Benchmark) -> DataFrame:
    """``(doc_id, codes)``: vocabulary numbers of the whole text's words, as packed unsigned integers."""
    kind = np.uint16 if len(bench.vocabulary) < 1 << 16 else np.uint32
    get = bench.vocabulary.get

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [np.array([get(w, 0) for w in words(t)], kind).tobytes() for t in raw_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(codes, pa.binary())], names=["doc_id", "codes"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id bigint, codes binary")


def _blocks(n_words: int) -> int:
    return max(1, -(-n_words // BLOCK))


class Slab:
    """Pieces of documents side by side, each padded to whole blocks and ``pad`` empty ones, so that
    windows do not run into the next piece."""

    def __init__(self, pieces: list[tuple[int, int, np.ndarray]], pad: int):
        self.pieces = pieces        # (row of the batch, first word in its text, codes)
        lengths = np.array([len(c) for _, _, c in pieces])
        self.blocks = -(-np.maximum(lengths, 1) // BLOCK)
        self.start = np.concatenate(([0], np.cumsum(self.blocks + pad)))
        codes = np.concatenate([c for _, _, c in pieces])
        shift = np.repeat(self.start[:-1] * BLOCK - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
        at = np.flatnonzero(codes)
        self.terms, self.block = codes[at].astype(np.int64), (at + shift[at]) // BLOCK

    def sums(self, table: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per block the sum of the table's rows of its kept words; also those words and their blocks."""
        some = kept[self.terms]
        terms, block = self.terms[some], self.block[some]
        out = np.zeros((self.start[-1], table.shape[1]), np.float32)
        if len(terms):
            own, first, n = np.unique(block, return_index=True, return_counts=True)
            order = np.argsort(-n, kind="stable")       # fullest first: the blocks that have a j-th word are the first ones
            for lo in range(0, len(order), SUM_BLOCKS):
                some = order[lo:lo + SUM_BLOCKS]
                begin, count = first[some], n[some]
                acc = table[terms[begin]]
                for j in range(1, int(count[0])):
                    m = int(np.searchsorted(-count, -j, side="left"))
                    acc[:m] += table[terms[begin[:m] + j]]
                out[own[some]] = acc
        return out, terms, block


def _slabs(batch: pa.RecordBatch, kind: type, pad: int, overlap: int = 0) -> Iterator[Slab]:
    """Whole texts of a batch, in slabs; pieces of a long text share ``overlap`` blocks."""
    pieces, held = [], 0
    for row, raw in enumerate(batch.column(1).to_pylist()):
        codes = np.frombuffer(raw, kind)
        for lo in range(0, max(1, len(codes)), SLAB):
            pieces.append((row, lo, codes[lo:lo + SLAB + overlap * BLOCK]))
            held += len(pieces[-1][2]) + BLOCK
            if held >= SLAB:
                yield Slab(pieces, pad)
                pieces, held = [], 0
    if pieces:
        yield Slab(pieces, pad)


def surroundings(slab: Slab, lo: int, n: int, size: int, reach: int, terms: int) -> np.ndarray:
    """Words x ``n`` windows from block ``lo`` on: whether the window of ``size`` blocks, or ``reach`` more on either side, holds the word."""
    first, width = lo - reach, size + 2 * reach
    start, end = np.searchsorted(slab.block, (first, first + n + width - 1))
    out, have = np.zeros((terms, n + width - 1), np.uint8), 1
    out[slab.terms[start:end], slab.block[start:end] - first] = 1
    while have < width:
        more = min(have, width - have)
        out = out[:, :-more] | out[:, more:]
        have += more
    return out


def document_frequency(encoded: DataFrame, size: int, kind: type) -> tuple[np.ndarray, int]:
    """Blocks that hold each vocabulary word, and their number; over all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size + 1, np.int64)   # at 0: all blocks
        for b in batches:
            for slab in _slabs(b, kind, 0):
                pairs = np.unique(slab.block * (size + 1) + slab.terms)
                df += np.bincount(pairs % (size + 1), minlength=size + 1)
                df[0] += slab.blocks.sum()
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "n"])

    out = np.zeros(size + 1, np.int64)
    for r in map_arrow(encoded, run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]   # one row for each vocabulary word at most
    return out, int(out[0])


def term_weights(df: np.ndarray, n: int, bench: Benchmark) -> np.ndarray:
    """Inverse document frequency of each vocabulary number; 0 for 0."""
    idf = np.log((n + 1) / (df + 1.0)) + 1.0
    idf[0] = 0.0
    return idf


def item_vectors(bench: Benchmark, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """TF-IDF rows of the items, times ``basis``."""
    return np.array([weight[item] @ basis[item] for item in bench.items])


def item_gram(bench: Benchmark, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """B'B · basis for the TF-IDF matrix B of the items."""
    out = np.zeros_like(basis)
    for item, row in zip(bench.items, item_vectors(bench, weight, basis), strict=True):
        np.add.at(out, item, weight[item][:, None] * row)
    return out


def sketch(encoded: DataFrame, weight: np.ndarray, basis: np.ndarray, kind: type) -> np.ndarray:
    """A'A · basis for the TF-IDF matrix A of two-block passages: a vocabulary x columns sum over all tasks."""
    kept = weight > 0
    table = (basis * weight[:, None]).astype(np.float32)
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(weight), width))
        for b in batches:
            for slab in _slabs(b, kind, 1):
                z, terms, block = slab.sums(table, kept)
                if not len(terms):
                    continue
                z[:-1] += z[1:]
                cover = z.copy()        # a block is in the windows that start at it and at the one before
                cover[1:] += z[:-1]
                cover[slab.start[:-1]] = z[slab.start[:-1]]
                order = np.argsort(terms, kind="stable")
                own, first = np.unique(terms[order], return_index=True)
                total[own] += np.add.reduceat(cover[block[order]], first, axis=0)
        some = np.flatnonzero(total.any(axis=1))
        values = total[some] * weight[some, None]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(values[:, j]) for j in range(width))],
                                         names=["term", *(f"y{j}" for j in range(width))])

    schema = "term int, " + ", ".join(f"y{j} double" for j in range(width))
    sums = map_arrow(encoded, run, schema).groupBy("term").agg(*(F.sum(f"y{j}").alias(f"y{j}") for j in range(width)))
    out = np.zeros((len(weight), width))
    for r in sums.collect():   # one row for each vocabulary word at most
        out[r[0]] = r[1:]
    return out


def latent_basis(encoded: DataFrame, bench: Benchmark, weight: np.ndarray, passages: int, kind: type, rank: int = RANK) -> np.ndarray:
    """Orthonormal columns (vocabulary x rank) that span the leading right singular vectors, by a randomised range finder."""
    mass = ITEM_MASS * passages / max(1, len(bench.items))
    basis = np.random.default_rng(9).standard_normal((len(weight), min(rank, int((weight > 0).sum())))) * (weight > 0)[:, None]
    basis, _r = np.linalg.qr(basis)
    basis, _r = np.linalg.qr(sketch(encoded, weight, basis, kind) + mass * item_gram(bench, weight, basis))
    return basis


def scales(bench: Benchmark) -> dict[int, np.ndarray]:
    """Items by the blocks of the windows they are looked for in."""
    out: dict[int, list[int]] = {}
    for k, item in enumerate(bench.items):
        size = 2
        while size * BLOCK < len(item):
            size *= 2
        out.setdefault(size, []).append(k)
    return {size: np.array(ks) for size, ks in sorted(out.items())}


def least_cosines(bench: Benchmark, least: float = COSINE) -> np.ndarray:
    """What a window must reach to be a candidate for each item: longer items fill more of their windows."""
    out = np.zeros(len(bench.items), np.float32)
    for size, ks in scales(bench).items():
        for k in ks.tolist():
            out[k] = min(max(least, COSINE_MOST), max(least, COSINE_RATE * (len(bench.items[k]) / (size * BLOCK)) ** 0.5))
    return out


def search(encoded: DataFrame, bench: Benchmark, weight: np.ndarray, basis: np.ndarray, kind: type,
           cosine: float = COSINE, verify: bool = True) -> DataFrame:
    """``(doc_id, item_id, cosine, similarity, answer)`` of the verified candidates (of all, unless ``verify``)."""
    kept = weight > 0
    table = (basis * weight[:, None]).astype(np.float32)
    queries = item_vectors(bench, weight, basis)
    queries = (queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    items, answers, ids, sized = bench.items, bench.answers, bench.ids, scales(bench)
    largest, wide = max(sized), max(64, min(4096, PRESENT_BYTES // len(weight)))
    reaches = {k: size // 2 if len(items[k]) <= size // 2 * BLOCK else size for size, ks in sized.items() for k in ks.tolist()}
    floor = least_cosines(bench, cosine)
    schema = "doc_id bigint, item_id bigint, cosine double, similarity double, answer double"

    def judge(codes: np.ndarray, block: int, size: int, k: int, seen: np.ndarray) -> tuple[float, float]:
        item = items[k]
        region = codes[max(0, block * BLOCK - len(item)):(block + size) * BLOCK + len(item)]
        seen[region] = True
        common = int(seen[item].sum())      # no subsequence is longer
        seen[region] = False
        if common < PARAPHRASE * len(item):
            return 0.0, 0.0
        region = region[region > 0]
        got, end = lcs(item, region)
        said = 0.0
        if PARAPHRASE <= got / len(item) < SIMILARITY:
            # near where the subsequence ends, at most half as much again as the item
            near = region[max(0, end - len(item) * 3 // 2):end + max(map(len, answers[k]))]
            if lcs(item, near)[0] >= PARAPHRASE * len(item):
                said = max(lcs(answer, near)[0] / len(answer) for answer in answers[k])
        return got / len(item), said

    def candidates(slab: Slab) -> Iterator[tuple[int, int, int, float]]:
        """(block of the slab, window size, item, cosine)."""
        z, _terms, _block = slab.sums(table, kept)
        size = 1
        while size < largest:
            z[:-size] += z[size:].copy()
            size *= 2
            if size in sized:
                norm = np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
                for lo in range(0, len(z), wide):
                    unit = z[lo:lo + wide] / norm[lo:lo + wide]
                    # an item reaches at most its own length beyond the window
                    held = {reach: surroundings(slab, lo, len(unit), size, reach, len(weight)) for reach in {reaches[k] for k in sized[size].tolist()}}
                    for first in range(0, len(sized[size]), ITEM_BLOCK):
                        some = sized[size][first:first + ITEM_BLOCK]
                        likeness = queries[some] @ unit.T
                        for k, row in zip(some.tolist(), likeness, strict=True):
                            at = np.flatnonzero(row >= floor[k])
                            common = held[reaches[k]][items[k][:, None], at].sum(axis=0, dtype=np.int64)
                            for w in at[common >= PARAPHRASE * len(items[k])].tolist():
                                yield lo + w, size, k, float(row[w])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(weight), bool)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            found: dict[tuple, tuple] = {}
            for slab in _slabs(b, kind, largest - 1, largest + _blocks(max(map(len, items)))):
                for block, size, k, likeness in candidates(slab):
                    at = int(np.searchsorted(slab.start, block, side="right")) - 1
                    row, _lo, codes = slab.pieces[at]
                    similarity, said = judge(codes, block - int(slab.start[at]), size, k, seen) if verify else (1.0, 0.0)
                    if similarity >= SIMILARITY or said >= SIMILARITY:
                        key = doc_ids[row], ids[k]
                        found[key] = max(found.get(key, ()), (similarity, said, likeness))
            rows = [(d, i, c, s, a) for (d, i), (s, a, c) in found.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))],
                names=["doc_id", "item_id", "cosine", "similarity", "answer"])

    hits = map_arrow(encoded, run, schema)
    best = F.max(F.struct("similarity", "answer", "cosine")).alias("b")
    return hits.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.similarity", "b.answer")


def find_short(encoded: DataFrame, bench: Benchmark, kind: type) -> DataFrame:
    """``(doc_id, item_id, cosine, similarity, answer)`` of the items too short for the index: their words, one after
    the other, stand in the text."""
    by_size: dict[int, dict[bytes, list]] = {}
    for item_id, code in bench.short:
        by_size.setdefault(len(code), {}).setdefault(code.astype(kind).tobytes(), []).append(item_id)
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found = [], []
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes, hits = np.frombuffer(raw, kind), set()
                for size, items in by_size.items():
                    if len(codes) >= size:
                        grams = np.lib.stride_tricks.sliding_window_view(codes, size)
                        grams = np.ascontiguousarray(grams[(grams > 0).all(axis=1)])
                        for gram in np.unique(grams.view(f"V{width * size}").ravel()).tolist() if len(grams) else ():
                            hits.update(items.get(bytes(gram), ()))
                ids += [doc_id] * len(hits)
                found += hits
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.int64())], names=["doc_id", "item_id"])

    one = F.lit(1.0)
    return map_arrow(encoded, run, "doc_id bigint, item_id bigint").distinct().select(
        "doc_id", "item_id", one.alias("cosine"), one.alias("similarity"), F.lit(0.0).alias("answer"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE,
                  max_bytes: int = SLICE_BYTES, max_words: int = SLICE_WORDS) -> DataFrame:
    """Documents that hold a benchmark item: doc_id, item_id, cosine, similarity, answer. A benchmark larger than
    ``max_bytes`` or ``max_words`` is looked for in slices, each with an index of its own."""
    hits = []
    for bench in Benchmark.slices(benchmark, max_bytes, max_words):
        if not bench.vocabulary:
            continue
        encoded = stage(encode(docs, bench), "codes")
        kind = np.uint16 if len(bench.vocabulary) < 1 << 16 else np.uint32
        if bench.short:
            hits.append(find_short(encoded, bench, kind))
        if bench.items:
            df, passages = document_frequency(encoded, len(bench.vocabulary), kind)
            weight = term_weights(df, passages, bench)
            bench.set_answers(weight)
            basis = latent_basis(encoded, bench, weight, passages, kind, rank)
            hits.append(search(encoded, bench, weight, basis, kind, cosine))
    if not hits:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, cosine double, similarity double, answer double")
    if len(hits) == 1:
        return hits[0]
    # an item_id may stand for several texts, in several slices
    best = F.max(F.struct("similarity", "answer", "cosine")).alias("b")
    found = reduce(DataFrame.unionByName, (stage(h, "hits") for h in hits))
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.cosine", "b.similarity", "b.answer")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; each row is decided by itself, whatever its doc_id."""
    rows = numbered(docs)
    found = decontaminate(rows.select(F.col(ROW).alias("doc_id"), "text"), benchmark)
    return keep_rows(rows, found.select("doc_id").distinct(), "left_anti")
