"""Language ID (operator 5): hyperdimensional profiles.

Every letter class has a random vector of +1 and -1 (``DIMENSIONS`` long, from a fixed seed). The
vector of a three-letter sequence binds the letter vectors, permuted by their place: a cyclic
shift by two for the first, by one for the second, multiplied together. A text's vector is the
bundle (sum) of the vectors of all its sequences, words being set off by a blank. A language's
prototype is the bundle over all training texts of that language. Documents go to the prototype
with the largest cosine.

Bundling is linear, so a training task adds up sequence counts for each language and sends one
bundle per language: the model is ``languages x DIMENSIONS`` integers whatever the corpus, and
learns from all training rows.

Defined results: lang_pred is ``und`` and score 0 for a null text, a text without a letter, or
when no training text has a letter. Ties go to the language first by code point. Repeated rows
get equal results; a null doc_id is held in (trained on if its lang is not null). An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ROW, keep_rows, map_arrow, numbered

DIMENSIONS = 512
SEED = 20
CLASS_BITS = 6          # 64 letter classes: blank, a to z, and 37 that other letters share
HOLD_OUT = 5
#: The model is held by the driver and every task: at most so many languages.
MAX_LANGUAGES = 5000
FLUSH = 1 << 20

_cache: dict = {}


def letter_classes() -> np.ndarray:
    """Class of each code point; 0 for what is no letter."""
    if "classes" not in _cache:
        classes = np.zeros(0x110000, np.uint8)
        letters = np.array([c for c in range(0x110000) if chr(c).isalpha()])
        classes[letters] = 27 + (letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(37)
        classes[ord("a"):ord("z") + 1] = np.arange(1, 27)
        _cache["classes"] = classes
    return _cache["classes"]


def sequences(text: str | None) -> np.ndarray:
    """Codes (18 bits) of all three-letter sequences of the lower-cased text; empty if it has no letter."""
    if not text:
        return np.zeros(0, np.int32)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.concatenate(([0], letter_classes()[points], [0])).astype(np.int32)
    c = c[np.concatenate(([True], (c[1:] | c[:-1]) != 0))]   # one blank between words
    if len(c) < 3:
        return np.zeros(0, np.int32)
    return c[:-2] << 2 * CLASS_BITS | c[1:-1] << CLASS_BITS | c[2:]


def _vectors(dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Bound vectors of all letter pairs (first shifted by two, second by one), and of the third letter."""
    if ("v", dimensions) not in _cache:
        letters = (np.random.default_rng(SEED).integers(0, 2, (1 << CLASS_BITS, dimensions)) * 2 - 1).astype(np.int8)
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        _cache["v", dimensions] = (first[:, None, :] * second[None, :, :]).reshape(-1, dimensions), letters
    return _cache["v", dimensions]


def bundle(codes: np.ndarray, counts: np.ndarray, dimensions: int) -> np.ndarray:
    """Sum of the vectors of the given sequences, each as often as counted; exact integers."""
    pairs, third = _vectors(dimensions)
    out = np.zeros(dimensions)
    for i in range(0, len(codes), 4096):
        u = codes[i:i + 4096]
        bound = pairs[u >> CLASS_BITS]
        bound *= third[u & (1 << CLASS_BITS) - 1]
        if counts[i:i + 4096].sum() < 1 << 24:
            out += counts[i:i + 4096].astype(np.float32) @ bound.astype(np.float32)
        else:
            out += counts[i:i + 4096].astype(np.float64) @ bound.astype(np.float64)
    return out


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT == 0, F.lit(False))


def prototypes(training: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Bundle of every language over all rows of ``training`` (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: dict[str, list] = {}
        sums: dict[str, np.ndarray] = {}

        def add(lang: str) -> None:
            u, n = np.unique(np.concatenate(pending.pop(lang)), return_counts=True)
            sums[lang] = sums.get(lang, 0) + bundle(u, n, dimensions)

        held: dict[str, int] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                codes = sequences(text)
                if len(codes):
                    pending.setdefault(lang, []).append(codes)
                    held[lang] = held.get(lang, 0) + len(codes)
                    if held[lang] > FLUSH:
                        add(lang)
                        held[lang] = 0
        for lang in list(pending):
            add(lang)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(v.astype(np.int64))],
                names=["lang", "dim", "value"])

    labelled = training.filter("lang is not null and text is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    sums = map_arrow(labelled, run, "lang string, dim int, value bigint").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in sums.toLocalIterator():
        if r["lang"] not in out:
            if len(out) == MAX_LANGUAGES:
                raise ValueError(f"over {MAX_LANGUAGES} languages")
            out[r["lang"]] = np.zeros(dimensions)
        out[r["lang"]][r["dim"]] = r["value"]
    return out


def predict(docs: DataFrame, model: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """``(doc_id, lang_pred, score)``; score is the cosine, negative ones as 0."""
    names = sorted(k for k, v in model.items() if v.any())
    unit = np.array([model[k] / np.linalg.norm(model[k]) for k in names]).reshape(len(names), dimensions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            for text in b.column(1).to_pylist():
                codes = sequences(text)
                if not len(codes) or not names:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                v = bundle(*np.unique(codes, return_counts=True), dimensions)
                cosines = unit @ (v / (np.linalg.norm(v) or 1.0))
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(float(np.clip(cosines[best], 0.0, 1.0)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, run, "doc_id bigint, lang_pred string, score double")


def language_id(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score; fitted on the rows that are not held out."""
    model = prototypes(docs.filter(~held_out(F.col("doc_id"))), dimensions)
    return (predict(docs, model, dimensions)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"))


def drop_unidentified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows in which no language is found; each row is decided by itself, whatever its doc_id."""
    rows = numbered(docs)
    found = predict(rows.select(F.col(ROW).alias("doc_id"), "text"), prototypes(rows.filter(~held_out(F.col("doc_id")))))
    return keep_rows(rows, found.filter("lang_pred = 'und'").select("doc_id"), "left_anti")
