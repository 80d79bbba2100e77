"""Plans of the operators themselves, on inputs read from files (not of staged results)."""

import pytest

from tidemark.operators.attribution import attribute, best_registration, for_tenants, fx_normalise, registrations_for_attribution
from tidemark.operators.changes import apply_registration_changes, changed_keys, changed_rows, with_user
from tidemark.operators.funnel import event_funnel
from tidemark.operators.merge import erase_tenants, merge_upsert
from tidemark.operators.prospects import PROSPECT_KEYS, lead_contact_union, latest_prospects
from tidemark.plans.workspace import NOW, workspace
from conftest import SF_SMALL

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "SortAggregate"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def operator_plans(spark):
    ws = workspace(spark, SF_SMALL)
    p, ur, rates = ws.prospects(), ws.attribution_registrations(), ws.rates()
    reg, lc = registrations_for_attribution(ur), lead_contact_union(p)
    changes, state = ws.cdc_changes(1), ws.cdc_state(0)
    tenants = spark.createDataFrame([(1,)], "organiser_Id long")
    changed = changed_rows(state.registrations, changed_keys(changes))
    return {
        "event_funnel": event_funnel(ws.contacts(), reg, NOW), "attribute": attribute(fx_normalise(lc, rates), reg),
        "best_registration": best_registration(reg, lc), "apply_changes": apply_registration_changes(state.registrations, changes),
        "joined_changes": with_user(changed, state.users, NOW), "latest_prospects": latest_prospects(p),
        "upsert": merge_upsert(p, p.filter("opportunity_IsWon"), PROSPECT_KEYS), "erase": erase_tenants(p, tenants),
        "tenants": for_tenants(p, tenants, broadcast=True)}


@pytest.fixture(scope="module")
def plans(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for inputs without statistics
    try:
        return {k: plan(df) for k, df in operator_plans(spark).items()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_plans_stay_on_the_jvm_without_cross_products(plans):
    for name, text in plans.items():
        for bad in FORBIDDEN:
            assert bad not in text, f"{name}: {bad} in plan"
        assert "FileScan" in text, name


def test_checked_tenant_lists_filter_without_an_exchange(plans):
    assert "BroadcastHashJoin" in plans["tenants"] and "hashpartitioning" not in plans["tenants"]


def test_joined_changes_scan_each_table_once(plans):
    assert plans["joined_changes"].count("FileScan") == 3      # registrations, changes, users


def test_people_are_spread_by_tenant_and_email(plans):
    text = plans["best_registration"]
    assert "WindowGroupLimit" in text
    assert "hashpartitioning(organiser_Id" in text and "email#" in text.split("hashpartitioning(organiser_Id", 1)[1].split(")", 1)[0]


def test_scans_prune_columns(spark):
    from tidemark import fixtures as fx
    plan = fx.registrations(spark, SF_SMALL).select("_id")._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan


def test_each_json_document_is_parsed_once(spark):
    """Filters on decoded fields must not be pushed below the parse (which would
    re-parse the text once per referenced field)."""
    from tidemark.operators.changes import registration_changes
    from tidemark.operators.decode import (
        decode_envelope, decode_registration_inserts, decode_registration_patches, route,
    )
    from tidemark.plans.workspace import workspace
    from tidemark.sources.kafka import kafka_record
    env = decode_envelope(kafka_record(workspace(spark, SF_SMALL).cdc_messages().drop("file_no")))
    comm = route(env, "communities")
    ch = registration_changes(decode_registration_inserts(comm), decode_registration_patches(comm))
    plan = ch._jdf.queryExecution().optimizedPlan().toString()
    # per union branch: envelope + 3 inner documents + the registration document (+ filter id for patches)
    assert plan.count("from_json(") <= 2 * 6, plan.count("from_json(")
