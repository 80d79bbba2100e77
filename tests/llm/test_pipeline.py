"""The pipeline against its operators' brute-force versions, its registration, and the SQL of the queries."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tidemark.llm.decontaminate import drop_contaminated, words
from tidemark.llm.queries import ORACLES, QUERIES
from tests.llm.test_dedup import brute_components, brute_fingerprint, lower
from tests.llm.test_mixing import brute_mix

SF = "/root/testdata/sf0.01"


def test_run_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    bench = [b" " + b" ".join(words(r["text"].encode())) + b" " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    last = {}
    for d in docs:
        last[lower(d[1])] = max(d, last.get(lower(d[1]), d), key=lambda x: x[0])
    docs = list(last.values())
    fps = {d[0]: brute_fingerprint(d[1]) for d in docs}
    comp = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    low = {}
    for d in docs:
        low[comp[fps[d[0]]]] = min(d[0], low.get(comp[fps[d[0]]], d[0]))
    docs = [d for d in docs if low[comp[fps[d[0]]]] == d[0]]
    docs = [d for d in docs if not any(b in b" " + b" ".join(words(d[1].encode())) + b" " for b in bench)]
    want = {(i, n, taken) for i, n, _s, _t, taken in brute_mix(docs) if taken}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["size"], r["size"] * r["copies"]) for r in rows if r["size"]} == want


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert [k for k, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "benchmark decontamination", "mixing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema == docs.schema
        assert stage(spark, docs.limit(0), SF).count() == 0


ROWS = [(5, "one two three x"), (5, "four five six y"), (9, "one two three x"), (None, "copy seven eight t"), (None, "COPY seven eight t"),
        (1, "copy seven eight t"), (None, "alone nine ten z"), (None, "alone nine ten z"), (7, "twice a b c"), (7, "twice a b c"), (None, "123"), (3, "123"), (3, "words")]


def test_stages_decide_rows_not_ids(spark):
    """Rows without id, and rows that share one: no unique text is lost, no copy stays."""
    docs = spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(ROWS)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    stages = dict(corpus_pipeline.STAGES)
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in stages["language ID"](spark, docs, SF).collect())
    assert kept == sorted((i is None, i or 0, t) for i, t in ROWS if t != "123")
    for name in ("exact dedup", "SimHash near-dedup"):
        out = [(r["doc_id"], lower(r["text"])) for r in stages[name](spark, docs, SF).collect()]
        assert len(out) == len({t for _, t in out}) == len({lower(t) for _, t in ROWS}), name
        ids = {t: {i for i, x in ROWS if lower(x) == t} for t in {lower(x) for _, x in ROWS}}
        pick = max if name == "exact dedup" else min
        assert all(i == (pick(ids[t] - {None}) if ids[t] - {None} else None) for i, t in out), name
    bench = spark.createDataFrame([(1, "four five six"), (2, "alone nine ten z")], "item_id bigint, text string")
    clean = sorted(r["text"] for r in drop_contaminated(docs, bench).collect())
    assert clean == sorted(t for _, t in ROWS if t not in ("four five six y", "alone nine ten z"))


def test_a_third_of_the_ids_is_null(spark):
    docs = spark.range(3_000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 700).alias("doc_id"), F.concat(F.lit("a text of its own "), (F.col("id") % 1_000).cast("string")).alias("text"),
                                     F.lit("en").alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    kept = dict(corpus_pipeline.STAGES)["exact dedup"](spark, docs, SF)
    assert kept.count() == kept.select("text").distinct().count() == 1_000


def test_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    cur = con.execute(ORACLES[name])
    cols = [c[0] for c in cur.description]
    order = lambda r: [(v is None, v) for v in list(r.values())[:2]]
    want = sorted((dict(zip(cols, r, strict=True)) for r in cur.fetchall()), key=order)
    got = sorted((r.asDict() for r in df.select(*cols).collect()), key=order)
    assert sorted(cols) == sorted(df.columns) and len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        floats = {k for k, v in w.items() if isinstance(v, float)}
        assert {k: v for k, v in g.items() if k not in floats} == {k: v for k, v in w.items() if k not in floats}
        assert [g[k] for k in sorted(floats)] == pytest.approx([w[k] for k in sorted(floats)], rel=1e-9)


def test_whole_tables_are_read(spark):
    for name, table, key in (("op5_language_id", "documents", "doc_id"), ("op6_lm_scoring", "documents", "doc_id")):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert df.select(F.count_distinct(key)).first()[0] == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count()
