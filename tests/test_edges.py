import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.attribution import fx_normalise, usable_rates
from tidemark.operators.changes import latest_patches
from tidemark.operators.notify import completion_notice, tenants_with_action
from tidemark.schemas import ACTION_DISABLED, ACTION_FETCHED, ACTION_PROCESSED
from conftest import rows

RATES = "base_currency string, target_currency string, conversion_rate double"
LC = "prospect_id string, base_currency string, opportunity_Currency string, opportunity_Amount double"


def test_unknown_currency_gets_rate_one_and_null_amount_stays_null(spark):
    rates = spark.createDataFrame([("EUR", "USD", 1.5), ("EUR", "USD", 1.5)], RATES)   # repeated pair
    lc = spark.createDataFrame([("a", "USD", "EUR", 10.0), ("b", "USD", "XXX", 10.0), ("c", "USD", "EUR", None)], LC)
    out = rows(fx_normalise(lc, rates), "prospect_id", "conversion_rate", "opportunity_Amount")
    assert out == [("a", 1.5, 15.0), ("b", 1.0, 10.0), ("c", 1.5, None)]


def test_several_rates_for_a_pair_need_an_order(spark):
    rates = spark.createDataFrame([("EUR", "USD", 1.5, 1), ("EUR", "USD", 1.2, 2)], RATES + ", day int")
    with pytest.raises(ValueError, match="several rates"):
        usable_rates(rates)
    assert rows(usable_rates(rates, "day")) == [("EUR", "USD", 1.2)]
    with pytest.raises(ValueError, match="at most 0"):
        usable_rates(rates.filter("day = 1"), max_rate_rows=0)


def test_every_message_is_kept_ruled_out_or_rejected(spark):
    """Counts in = kept + ruled out + rejected, for each decoder."""
    from tidemark.operators.decode import dead_letters, fate_counts, prospect_fates, registration_insert_fates, sync_fates, user_fates
    env = "topic string, partition int, offset long, db string, collection string, ts_ms long, _id string, after string, v string, set_doc string"
    doc = '{"_id":{"$oid":"%s"},"email":"e","organiser_id":%s,"firstName":"f","lastName":"l","event_id":%s}'
    texts = [doc % ("a", '"7"', 1), doc % ("b", '"acme"', 1), doc % ("c", '"7"', '"x"'), "{broken", doc % ("d", "null", 1)]
    df = spark.createDataFrame([("t", 0, i, "d", "c", 1, None, t, None, None) for i, t in enumerate(texts)], env)
    assert rows(fate_counts(registration_insert_fates(df)), "fate", "reason", "n") == [
        ("kept", "a field of another type", 1), ("kept", None, 1), ("rejected", "tenant id is not a number", 1), ("rejected", "unreadable document", 1),
        ("ruled out", "no tenant", 1)]
    assert rows(dead_letters(user_fates(df)), "offset", "reason", "value") == [(1, "tenant id is not a number", texts[1]), (3, "unreadable document", "{broken")]
    rec = [None, "", "{broken", "[]", "null", "{}", '{"data":{}}', '{"data":{"organiserId":3}}', '{"data":{"organiserId":3,"leadDetails":{"Id":"l","CreatedDate":"soon"}}}']
    df = spark.createDataFrame([("t", 0, i, t) for i, t in enumerate(rec)], "topic string, partition int, offset long, value string")
    got = {r["offset"]: (r["fate"], r["reason"]) for r in prospect_fates(df).collect()}
    assert [got[i] for i in (0, 1, 2, 4, 5, 6, 7, 8)] == [("rejected", "no value")] * 2 + [("rejected", "unreadable payload")] * 3 + [
        ("rejected", "no tenant"), ("rejected", "no lead or opportunity id"), ("kept", "unreadable time")]
    assert got[3][0] == "rejected" and prospect_fates(df).filter("offset = 8").first()["unread_times"] == 1
    notices = [None, "{", '{"context":{"oId":"x","action":"%s"}}' % ACTION_FETCHED, '{"context":{"action":"%s"}}' % ACTION_DISABLED,
               '{"context":{"oId":"x","action":"other"}}', '{"context":{"oId":"4","action":"%s"}}' % ACTION_FETCHED]
    df = spark.createDataFrame([("t", 0, i, t) for i, t in enumerate(notices)], "topic string, partition int, offset long, value string")
    assert [(r["fate"], r["reason"]) for r in sync_fates(df).orderBy("offset").collect()] == [
        ("rejected", "no value"), ("rejected", "unreadable notice"), ("rejected", "tenant id is not a number"), ("rejected", "no tenant"),
        ("ruled out", "other action"), ("kept", None)]


def test_a_new_run_does_not_overwrite_an_old_one(spark):
    from tidemark.session import fresh_dir
    from tidemark.sources.warehouse import WarehouseConf, append_warehouse, read_warehouse
    conf = WarehouseConf(format="parquet", root=fresh_dir(spark, "test-wh"))
    three, two = spark.range(3).withColumn("load_timestamp", F.lit(1)), spark.range(2).withColumn("load_timestamp", F.lit(2))
    append_warehouse(three, conf, "s.t", "a", 0)
    append_warehouse(two, conf, "s.t", "b", 0)
    append_warehouse(two, conf, "s.t", "b", 0)
    assert read_warehouse(spark, conf, "s.t").count() == 5


def test_a_folder_may_hold_several_topics(spark):
    from tidemark.session import fresh_dir
    from tidemark.sources.kafka import StreamConf, read_changes, read_topic
    from tidemark.streaming.cdc import drain
    root = fresh_dir(spark, "test-topics")
    rec = spark.createDataFrame([(t,) for t in ("cdc.app.users", "cdc.app.usersX", "crm")], "topic string").selectExpr(
        "binary(topic) AS key", "binary(topic) AS value", "topic", "0 AS partition", "0L AS offset", "timestamp_seconds(0) AS timestamp", "0 AS timestampType")
    rec.write.parquet(f"{root}/in")
    seen = []
    for i, df in enumerate((read_changes(spark, StreamConf(format="parquet", path=f"{root}/in"), r"cdc\.app\.(?:users|communities)"),
                            read_topic(spark, StreamConf(format="parquet", path=f"{root}/in"), "crm"))):
        drain(df, lambda b, _i: seen.append(sorted(r["topic"] for r in b.collect())), f"{root}/ck{i}")
    assert seen == [["cdc.app.users"], ["crm"]]


def test_own_processing_notice_is_ignored(spark):
    sync = spark.createDataFrame([(1, ACTION_FETCHED), (1, ACTION_FETCHED), (2, ACTION_PROCESSED),
                                  (3, ACTION_DISABLED), (None, ACTION_FETCHED)], "organiser_Id long, action string")
    assert rows(tenants_with_action(sync, ACTION_FETCHED)) == [(1,)]
    assert rows(tenants_with_action(sync, ACTION_DISABLED)) == [(3,)]


def test_completion_notice_shape(spark):
    t = spark.createDataFrame([(5,)], "organiser_Id long")
    msg = json.loads(completion_notice(t, 42).first()["value"])
    assert msg == {"context": {"oId": 5, "eId": 0, "action": ACTION_PROCESSED, "actor": "SYSTEM"}, "timeStamp": 42}


def test_patch_modes_latest_and_fold(spark):
    cols = ("_id string, bucket int, event_id long, exhibitor_id string, firstName string, lastName string, "
            "initLoginAt long, isLoggedIn boolean, localCreatedAt double, organiser_id long, source string, "
            "speaker_id long, userId string, ts_ms long, partition int, offset long, OPS string")
    base = dict.fromkeys(["event_id", "exhibitor_id", "firstName", "lastName", "initLoginAt", "isLoggedIn",
                          "localCreatedAt", "organiser_id", "source", "speaker_id", "userId"])

    def row(ts, off, **kw):
        d = dict(base, **kw)
        return ("x", 1, *d.values(), ts, 1, off, "UPDATE")

    ch = spark.createDataFrame([row(1, 1, firstName="A", source="s1"), row(2, 2, source="s2"),
                                row(2, 1, source="tie-lost")], cols)
    latest = latest_patches(ch).first()
    assert (latest["firstName"], latest["source"]) == (None, "s2")
    fold = latest_patches(ch, "fold").first()
    assert (fold["firstName"], fold["source"]) == ("A", "s2")


def test_decimal_money_is_order_independent(spark):
    from tidemark.operators.funnel import opportunity_pivot
    vals = [0.1, 0.2, 0.3, 1e15, -1e15] * 20
    df = spark.createDataFrame([(1, 1, f"o{i}", v, 0) for i, v in enumerate(vals)],
                               "organiser_Id long, event_id long, opportunity_Id string, opportunity_Amount double, "
                               "ClosedWon int")
    a = opportunity_pivot(df.repartition(7)).first()["amt_opportunity_0"]
    b = opportunity_pivot(df.orderBy(F.rand(3)).coalesce(1)).first()["amt_opportunity_0"]
    assert a == b
