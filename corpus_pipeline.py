"""A corpus pipeline: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, mixing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor kept. All but the last
return the columns of ``docs``; the last adds size, source_size, target and copies, and keeps the
documents the mix takes at least once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import read_table, stage
from tidemark.llm.decontaminate import drop_contaminated
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.language_id import drop_unidentified
from tidemark.llm.mixing import mix
from tidemark.llm.simhash import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_unidentified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).filter("copies > 0")


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", benchmark), ("mixing", mixing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read back."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_name, fn) in enumerate(STAGES):
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{i}")
    return docs


#: Language ID, SimHash components and latent retrieval have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None
