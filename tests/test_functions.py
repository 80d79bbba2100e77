from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    any_not_null, ascii_bucket, epoch_ms_to_s, latest_stage, parse_time, to_bool, to_epoch_long, touch_point,
)


def py_bucket(s):
    return sum(ord(c) for c in s) % 100


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=0xFFFF,
                                               blacklist_categories=("Cs",)), max_size=30), min_size=1, max_size=20))
def test_bucket_matches_python_model(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id string").select("id", ascii_bucket("id").alias("b"))
    for r in df.collect():
        assert r["b"] == py_bucket(r["id"])


def test_bucket_edge_values(spark):
    df = spark.createDataFrame([("5f1a2b3c4d5e6f7a8b9c0d1e",), ("é",), ("",), (None,)], "id string")
    got = [r["b"] for r in df.select(ascii_bucket("id").alias("b")).collect()]
    assert got == [py_bucket("5f1a2b3c4d5e6f7a8b9c0d1e"), 33, 0, None]


def test_touch_point_truth_table(spark):
    data = [("a@x", "a@x", True, "Platform", 1), ("a@x", "A@X", True, "Web", 2), ("a@x", "a@x", False, "Platform", 0),
            ("a@x", "a@x", None, "Platform", 0), ("a@x", None, True, "Platform", 0), (None, None, True, "Platform", 0),
            ("a@x", "b@x", True, "Platform", 0), ("a@x", "a@x", True, None, 2)]
    df = spark.createDataFrame(data, "e string, p string, l boolean, s string, want int")
    for r in df.select("want", touch_point("e", "p", "l", "s").alias("got")).collect():
        assert r["got"] == r["want"]


def test_parse_time_and_numbers(spark):
    df = spark.createDataFrame([("1998-10-03T00:00:00.000+0000", "12.6", "true", 1999),
                                ("n/a", "abc", "maybe", 1000), (None, None, None, None)],
                               "t string, n string, b string, ms long")
    out = df.select(F.unix_timestamp(parse_time("t")).alias("t"), to_epoch_long("n").alias("n"),
                    to_bool("b").alias("b"), epoch_ms_to_s("ms").alias("s")).collect()
    assert [tuple(r) for r in out] == [(907372800, 13, True, 1), (None, None, None, 1), (None, None, None, None)]


def test_parse_time_extra_pattern(spark):
    df = spark.createDataFrame([("03/10/1998",)], "t string")
    r = df.select(F.unix_timestamp(parse_time("t", ["dd/MM/yyyy"])).alias("t")).first()
    assert r["t"] == 907372800


TIMES = [("2021-03-03T16:05:07.000+0000", 1614787507), ("2021-03-03", 1614729600), ("1614787507", 1614787507), ("1614787507123", 1614787507),
         ("1614787507.5", 1614787507), ("Wed, 03 Mar 2021 16:05:07 +0000", 1614787507), ("Wed, 3 Mar 2021 16:05:07 GMT", 1614787507),
         ("Wed, 03 Mar 2021 18:05:07 +0200", 1614787507), ("Mar 3, 2021 4:05 PM", 1614787500), ("March 3, 2021 4:05pm", 1614787500),
         ("Mar 3 2021 16:05", 1614787500), ("March 3, 2021", 1614729600), ("03/03/2021 16:05", 1614787500), ("3/3/2021 4:05 PM", 1614787500),
         ("25/12/2021", 1640390400), ("2021/3/3 16:05:07", 1614787507), ("2021-03-03 4:05 PM", 1614787500), ("3.3.2021 16:05", 1614787500),
         ("20210303T160507Z", 1614787507), ("3 March 2021 16:05", 1614787500), (" 2021-03-03 16:05 ", 1614787500), ("n/a", None), ("", None),
         ("13/13/2021", None), ("Foo 3, 2021", None), (None, None), ("99999999999", None), ("2021-02-30", None)]


def test_time_forms(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TIMES)], "i int, t string")
    got = df.select("i", F.unix_timestamp(parse_time("t")).alias("s")).orderBy("i").collect()
    assert [(TIMES[r["i"]][0], r["s"]) for r in got] == TIMES


def test_latest_stage_handles_null_empty_and_null_dates(spark):
    schema = "h array<struct<CreatedDate:date,StageName:string>>"
    df = spark.createDataFrame([(None,), ([],), ([(None, "B"), (None, "A")],),
                                ([(None, "Z"), ("2020-01-01", "A"), ("2020-01-01", "C")],)],
                               schema.replace("date", "string"))
    df = df.select(F.col("h").cast(schema.split(" ", 1)[1]).alias("h"))
    got = [(r["s"]["StageName"] if r["s"] else None) for r in df.select(latest_stage("h").alias("s")).collect()]
    assert got == [None, None, "B", "C"]


def test_any_not_null(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(any_not_null(["a", "b"])).collect()] == [False, True]
