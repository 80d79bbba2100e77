"""Every registered query against its DuckDB oracle on the smallest data set."""

import datetime as dt
import decimal
import os
from collections import Counter

import duckdb
import pytest

from tidemark.plans.checks import QUERIES
from tidemark.plans.oracle import ORACLES
from conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["nation", "customer", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    got = Counter(tuple(_norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect())
    rel = con.sql(ORACLES[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert got == want
