"""Same operations on the Delta store; skipped where delta-spark is not installed."""

import pytest

from conftest import rows

pytest.importorskip("delta")


def test_delta_store_operations_match_portable_semantics(spark):
    from tidemark.session import fresh_dir
    from tidemark.sources.state import DeltaStore, Layout, ParquetStore
    schema = "k string, organiser_Id long, a int, b string"
    base = spark.createDataFrame([("x", 1, 1, "p"), ("y", 2, 2, "q")], schema)
    ins = spark.createDataFrame([("x", 1, 9, "new"), ("z", 3, 3, "r")], schema)
    pat = spark.createDataFrame([("x", None, None, "patched")], "k string, organiser_Id long, a int, b string")
    out = []
    for store in (ParquetStore(spark, fresh_dir(spark, "s")), DeltaStore(spark, fresh_dir(spark, "d"))):
        store.put("t", base)
        store.insert_then_patch("t", ins, pat.select("k", "a", "b"), ["k"], ["a", "b"])
        store.upsert("t", spark.createDataFrame([("y", 2, 7, "u")], schema), ["k"])
        store.layouts["t"] = Layout("k", "organiser_Id")
        store.erase(spark.createDataFrame([(3,)], "organiser_Id long"), store.begin("sync.a", 0)[0])
        out.append(rows(store.read("t"), "k", "organiser_Id", "a", "b"))
    assert out[0] == out[1] == [("x", 1, 1, "patched"), ("y", 2, 7, "u")]
