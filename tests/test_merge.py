from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators.latest import latest_per
from tidemark.operators.merge import erase_tenants, merge_insert, merge_patch, merge_upsert
from conftest import rows

SCHEMA = "k string, a int, b string"
keyed = st.lists(st.tuples(st.sampled_from(["x", "y", "z", None]), st.integers(0, 5) | st.none(),
                           st.sampled_from(["p", "q"]) | st.none()), max_size=8, unique_by=lambda t: t[0])


@settings(max_examples=15, deadline=None)
@given(keyed, keyed)
def test_upsert_and_insert_idempotent(spark, base, src):
    b, s = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(src, SCHEMA)
    once = merge_upsert(b, s, ["k"])
    assert rows(merge_upsert(once, s, ["k"])) == rows(once)
    ins = merge_insert(b, s, ["k"])
    assert rows(merge_insert(ins, s, ["k"])) == rows(ins)
    # NULL is a key like any other: never duplicated
    assert len([r for r in rows(once) if r[0] is None]) <= 1


@settings(max_examples=15, deadline=None)
@given(keyed)
def test_all_null_patch_is_identity(spark, base):
    b = spark.createDataFrame(base, SCHEMA)
    p = spark.createDataFrame([(r[0], None, None) for r in base], SCHEMA)
    assert rows(merge_patch(b, p, ["k"], ["a", "b"])) == rows(b)


def test_patch_keeps_old_values_and_ignores_unmatched(spark):
    b = spark.createDataFrame([("x", 1, "p"), ("y", 2, "q")], SCHEMA)
    p = spark.createDataFrame([("x", None, "new"), ("w", 9, "zz")], SCHEMA)
    assert rows(merge_patch(b, p, ["k"], ["a", "b"])) == [("x", 1, "new"), ("y", 2, "q")]


def test_insert_keeps_base_rows(spark):
    b = spark.createDataFrame([("x", 1, "old")], SCHEMA)
    s = spark.createDataFrame([("x", 2, "new"), ("y", 3, "n")], SCHEMA)
    assert rows(merge_insert(b, s, ["k"])) == [("x", 1, "old"), ("y", 3, "n")]


def test_erase_tenants(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "organiser_Id long, v string")
    t = spark.createDataFrame([(2,), (2,), (None,)], "organiser_Id long")
    assert rows(erase_tenants(df, t)) == [(1, "a"), (None, "c")]


def test_latest_per_order_and_ties(spark):
    df = spark.createDataFrame([("k", 1, 5, "a"), ("k", 2, 1, "b"), ("k", 2, 3, "c"), ("k", None, 9, "d"),
                                ("j", None, None, "e")], "k string, ts int, off int, v string")
    assert rows(latest_per(df, ["k"], ["ts", "off"]), "k", "v") == [("j", "e"), ("k", "c")]


@settings(max_examples=20, deadline=None)
@given(keyed, keyed, keyed)
def test_fused_insert_patch_equals_two_steps(spark, base, ins, pat):
    b, i, p = (spark.createDataFrame(x, SCHEMA) for x in (base, ins, pat))
    from tidemark.operators.merge import merge_insert_patch
    two = merge_patch(merge_insert(b, i, ["k"]), p, ["k"], ["a", "b"])
    assert rows(merge_insert_patch(b, i, p, ["k"], ["a", "b"])) == rows(two)


def test_merges_accept_inputs_of_one_lineage(spark):
    df = spark.createDataFrame([("x", 1, "p"), ("y", 2, "q")], SCHEMA)
    changed = df.filter("k = 'x'").selectExpr("k", "a + 10 AS a", "b")
    assert rows(merge_upsert(df, changed, ["k"])) == [("x", 11, "p"), ("y", 2, "q")]
    assert rows(merge_insert(df, changed, ["k"])) == rows(df)
    assert rows(merge_patch(df, changed, ["k"], ["a"])) == [("x", 11, "p"), ("y", 2, "q")]
