import re

import __spark_entry__ as E
from tidemark.plans.checks import QUERIES


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["organiser_Id", "event_id", "Opportunity_Count", "ClosedWon_Count", "Opportunity_Amount",
                          "ClosedWon_Amount", "leads_count", "regn", "atts", "load_timestamp"]
    assert df.count() > 0
    assert E.entry(spark).schema == df.schema


def test_registry_names_are_plain():
    for name in QUERIES:
        assert name.isidentifier() and not re.match(r"op\d+_", name) and "pipeline" not in name
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
