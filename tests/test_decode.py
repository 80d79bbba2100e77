import json

from pyspark.sql import functions as F

from tidemark.operators.changes import registration_changes
from tidemark.operators.decode import (
    decode_envelope, decode_registration_inserts, decode_registration_patches, decode_sync, decode_users, route,
)
from tidemark.schemas import KAFKA_RECORD
from tidemark.sources.kafka import kafka_record


def envelope(after=None, patch=None, filter_=None, collection="communities", ts=1):
    payload = {"source": json.dumps({"db": "app", "collection": collection, "ts_ms": ts})}
    if after is not None:
        payload["after"] = json.dumps(after)
    if patch is not None:
        payload["patch"] = json.dumps(patch)
    if filter_ is not None:
        payload["filter"] = json.dumps({"_id": json.dumps({"$oid": filter_})})
    return json.dumps({"payload": payload})


def records(spark, values, offsets=None):
    data = [(None, None if v is None else v.encode(), "cdc.app.t", 0, (offsets or list(range(len(values))))[i],
             None, 0) for i, v in enumerate(values)]
    return kafka_record(spark.createDataFrame(data, KAFKA_RECORD))


def reg(oid, first="F", last="L", org="7", **kw):
    d = {"_id": {"$oid": oid}, "firstName": first, "lastName": last, "organiser_id": org, "userId": {"$oid": "u1"}}
    d.update(kw)
    return d


def test_offset_stays_64_bit(spark):
    r = records(spark, [envelope(after=reg("a"))], offsets=[2 ** 31 + 5]).first()
    assert r["offset"] == 2 ** 31 + 5


def test_malformed_and_tombstone_give_null_fields(spark):
    env = decode_envelope(records(spark, ["{not json", None]))
    got = env.select("collection", "after", "set_doc").collect()
    assert all(all(v is None for v in r) for r in got)


def test_name_length_guard(spark):
    vals = [envelope(after=reg("a", first="x" * 264)), envelope(after=reg("b", first="x" * 265)),
            envelope(after=reg("c", first=None)), envelope(after=reg("d", last="y" * 265)),
            envelope(after=reg("e", org=None))]
    env = route(decode_envelope(records(spark, vals)), "communities")
    assert sorted(r["_id"] for r in decode_registration_inserts(env).collect()) == ["a"]
    loose = decode_registration_inserts(env, allow_null_names=True)
    assert sorted(r["_id"] for r in loose.collect()) == ["a", "c"]


def test_empty_unknown_and_delete_patches_are_dropped(spark):
    vals = [envelope(patch={"$v": "2", "$set": json.dumps({"unknownField": 1})}, filter_="a"),
            envelope(patch={"$v": "2", "$set": "{}"}, filter_="b"),
            envelope(filter_="c"),
            envelope(patch={"$v": "2", "$set": json.dumps({"source": "s", "immutable": {"isLoggedIn": "true"}})},
                     filter_="d")]
    env = route(decode_envelope(records(spark, vals)), "communities")
    ch = registration_changes(decode_registration_inserts(env), decode_registration_patches(env))
    out = ch.select("_id", "source", "isLoggedIn", "OPS").collect()
    assert [tuple(r) for r in out] == [("d", "s", True, "UPDATE")]


def test_users_need_email_and_numeric_tenant(spark):
    vals = [envelope(after={"_id": {"$oid": "u1"}, "email": "a@b", "organiser_id": "3"}, collection="users"),
            envelope(after={"_id": {"$oid": "u2"}, "organiser_id": "3"}, collection="users"),
            envelope(after={"_id": {"$oid": "u3"}, "email": "c@d", "organiser_id": "x3"}, collection="users")]
    u = decode_users(route(decode_envelope(records(spark, vals)), "users"))
    assert [(r["_id"], r["organiser_id"]) for r in u.collect()] == [("u1", 3)]


def test_sync_decode_non_numeric_tenant(spark):
    vals = [json.dumps({"context": {"oId": "12", "action": "A"}}), json.dumps({"context": {"oId": "x", "action": "A"}})]
    s = decode_sync(records(spark, vals)).select("organiser_Id").collect()
    assert [r[0] for r in s] == [12, None]


def test_insert_typing(spark):
    vals = [envelope(after=reg("a", immutable={"initLoginAt": "1000.6", "isLoggedIn": "true"},
                               localCreatedAt=5.0, event_id=3))]
    env = route(decode_envelope(records(spark, vals)), "communities")
    ch = registration_changes(decode_registration_inserts(env), decode_registration_patches(env))
    r = ch.first()
    assert (r["initLoginAt"], r["isLoggedIn"], r["event_id"], r["organiser_id"]) == (1001, True, 3, 7)
    assert r["bucket"] == sum(map(ord, "a")) % 100
    assert ch.select(F.col("OPS")).first()[0] == "INSERT"


def test_dotted_keys_and_unset_fields(spark):
    from tidemark.operators.changes import REG_KEYS, change_types, latest_patches, with_bucket
    from tidemark.operators.decode import KEPT, envelope_fates, registration_patch_fates
    from tidemark.operators.merge import merge_insert_patch
    from tidemark.schemas import REGISTRATION_FIELDS

    def patch(ts, set_=None, unset=None):
        p = {"$v": "2"} | ({"$set": json.dumps(set_)} if set_ else {}) | ({"$unset": json.dumps(unset)} if unset else {})
        return envelope(patch=p, filter_="a", ts=ts)

    vals = [patch(1, {"immutable.isLoggedIn": True, "immutable.initLoginAt": "12", "firstName": "N"}), patch(2, unset={"immutable": "", "source": True}),
            patch(3, {"userId.$oid": "u9", "lastName": "Z"}, {"lastName": 1, "unknown.field": 1}), patch(4, unset={"unknown": 1})]
    env = route(envelope_fates(records(spark, vals)), "communities")
    plain = {r["ts_ms"]: r for r in registration_patch_fates(env).collect()}
    assert [plain[i]["fate"] for i in (1, 2, 3, 4)] == [KEPT, "ruled out", KEPT, "ruled out"]       # the default reads no paths
    assert plain[1]["isLoggedIn"] is None and "unset" not in plain[1].asDict()
    fates = registration_patch_fates(env, dotted=True)
    got = {r["ts_ms"]: r for r in fates.collect()}
    assert [got[i]["fate"] for i in (1, 2, 3, 4)] == [KEPT, KEPT, KEPT, "ruled out"]
    assert (got[1]["isLoggedIn"], got[1]["initLoginAt"], got[1]["firstName"], got[1]["unset"]) == ("true", "12", "N", [])
    assert sorted(got[2]["unset"]) == ["initLoginAt", "isLoggedIn", "source"] and (got[3]["userId"], got[3]["unset"]) == ("u9", ["lastName"])

    changes = with_bucket(change_types(fates.filter(F.col("fate") == KEPT)))
    base = spark.createDataFrame([("a", "F", "L", 5, True, "s", "u1")], "_id string, firstName string, lastName string, initLoginAt long, isLoggedIn boolean, source string, userId string")
    rest = {"event_id": "bigint", "exhibitor_id": "string", "localCreatedAt": "double", "organiser_id": "bigint", "speaker_id": "bigint"}
    base = with_bucket(base.withColumns({c: F.lit(None).cast(t) for c, t in rest.items()}))
    seen = {}
    for mode in ("latest", "fold"):
        new = latest_patches(changes, mode).select(*REG_KEYS, *REGISTRATION_FIELDS, "unset")
        out = merge_insert_patch(base, base.limit(0), new, REG_KEYS, REGISTRATION_FIELDS, "unset").first()
        seen[mode] = [out[c] for c in ("firstName", "lastName", "initLoginAt", "isLoggedIn", "source", "userId")]
    # the newest patch alone (its value for a field wins over its own unset); all three folded
    assert seen == {"latest": ["F", "Z", 5, True, "s", "u9"], "fold": ["N", "Z", None, None, None, "u9"]}
