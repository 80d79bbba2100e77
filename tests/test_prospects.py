import json

from tidemark.operators.decode import decode_prospects
from tidemark.operators.prospects import (
    contact_rows, lead_contact_union, prepare_prospects, with_latest_stage, with_prospect_key,
)
from tidemark.schemas import KAFKA_RECORD
from tidemark.sources.kafka import kafka_record


def msg(org=1, opp="OP1", lead=None, ts=1, history=None, contacts=None, created="2020-01-02T00:00:00.000+0000"):
    data = {"organiserId": org, "opportunityDetails": {"Id": opp, "Amount": 10.0, "CreatedDate": created,
                                                       "LastModifiedDate": created}}
    if lead:
        data["leadDetails"] = {"Id": lead, "Email": "A@B.c", "CreatedDate": created}
    if history is not None:
        data["opportunityHistory"] = history
    if contacts is not None:
        data["contacts"] = contacts
    return json.dumps({"data": data, "timeStamp": ts})


def decoded(spark, msgs):
    recs = [(None, m.encode(), "crm", 0, i, None, 0) for i, m in enumerate(msgs)]
    return decode_prospects(kafka_record(spark.createDataFrame(recs, KAFKA_RECORD)))


def test_history_null_empty_and_null_dates(spark):
    d = with_latest_stage(decoded(spark, [
        msg(history=None), msg(history=[]),
        msg(history=[{"StageName": "B"}, {"StageName": "A"}]),
        msg(history=[{"StageName": "A", "CreatedDate": "2020-01-01"}, {"StageName": "Z", "CreatedDate": "2019-01-01"}])]))
    assert [r["Opportunity_StageName"] for r in d.collect()] == [None, None, "B", "A"]


def test_contacts_null_and_empty_give_no_rows(spark):
    p = with_latest_stage(with_prospect_key(decoded(spark, [msg(contacts=None), msg(opp="OP2", contacts=[]),
                                          msg(opp="OP3", contacts=[{"Id": "C1", "Email": "X@Y"}])])))
    assert [(r["SF_Id"], r["prospect_id"]) for r in contact_rows(p).collect()] == [("C1", "OP3")]


def test_tenant_scoped_key(spark):
    d = decoded(spark, [msg(opp=None), msg(org=None), msg(org=1, opp="S", ts=1), msg(org=2, opp="S", ts=2),
                        msg(org=1, opp="S", ts=3)])
    kept = prepare_prospects(d, 0)
    assert sorted((r["organiser_Id"], r["record_timeStamp"]) for r in kept.collect()) == [(1, 3), (2, 2)]
    legacy = prepare_prospects(d, 0, legacy_key=True)
    assert [(r["organiser_Id"], r["record_timeStamp"]) for r in legacy.collect()] == [(1, 3)]


def test_unparseable_dates_and_lead_rows(spark):
    p = with_prospect_key(decoded(spark, [msg(lead="L1", created="not a date")]))
    u = lead_contact_union(with_latest_stage(p)).collect()
    assert [(r["SF_Id"], r["email"], r["record_created_timestamp"]) for r in u] == [("L1", "a@b.c", None)]
