"""What the check queries write on the way: no shuffle of finished messages, no state that is not read."""

import re

from conftest import SF_SMALL

from tidemark import fixtures as fx
from tidemark.plans.workspace import Workspace, workspace


def test_finished_messages_are_not_shuffled(spark, monkeypatch):
    workspace(spark, SF_SMALL)      # sets the time zone
    monkeypatch.setattr(Workspace, "stage", lambda self, name, build: build())
    w = Workspace(spark, SF_SMALL)
    for messages in (w.cdc_messages(), w.crm_messages()):
        assert "RoundRobinPartitioning" not in messages._jdf.queryExecution().executedPlan().toString()


def test_orders_are_joined_before_they_become_payloads(spark):
    workspace(spark, SF_SMALL)
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = fx.crm_messages(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    made = [i for i, line in enumerate(plan.splitlines()) if "Account " in line]
    joins = [i for i, line in enumerate(plan.splitlines()) if re.search(r"\bJoin\b", line)]
    assert made and max(made) < min(joins)


def test_a_change_set_needs_no_state(spark):
    workspace(spark, SF_SMALL)
    w = Workspace(spark, SF_SMALL)
    assert not w.cdc_changes(9).isEmpty()
    assert set(w._paths) == {"cdc_messages", "cdc9_changes"}
    w.cdc_state(9)
    assert {"cdc9_users", "cdc9_registrations", "cdc9_user_registrations"} <= set(w._paths)


def test_a_batch_reads_the_messages_of_its_file_only(spark):
    workspace(spark, SF_SMALL)
    w = Workspace(spark, SF_SMALL)
    files = {f: w.cdc_messages().filter(f"file_no = {f}") for f in fx.CDC_FILES}
    for f, df in files.items():
        assert {p.split("file_no=")[1][0] for p in df.select("_metadata.file_path").distinct().toPandas()["file_path"]} == {str(f)}
        assert "file_no" in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    want = fx.cdc_messages(spark, SF_SMALL).select("topic", "offset", "file_no")
    assert sorted(w.cdc_messages().select("topic", "offset", "file_no").collect()) == sorted(want.collect())


def test_a_step_waits_only_for_the_tables_it_reads(spark):
    workspace(spark, SF_SMALL)
    w = Workspace(spark, SF_SMALL)
    w.cdc_registrations(2)
    assert set(w._paths) == {"cdc_messages", *(f"cdc{i}_{t}" for i in range(3) for t in ("changes", "registrations"))}
    w.cdc_joined(2)
    assert not any("user_registrations" in p for p in w._paths) and "cdc1_joined" not in w._paths


def test_envelopes_of_damaged_messages_are_decoded_once(spark):
    from tidemark.plans import checks
    workspace(spark, SF_SMALL)
    files = checks.message_fates(spark, SF_SMALL).inputFiles()
    assert not any("cdc_messages" in f for f in files) and any("damaged_envelopes" in f for f in files)
    assert "damaged_envelopes" in workspace(spark, SF_SMALL)._paths


def test_contacts_of_an_order_without_joining_the_orders_again(spark, tmp_path):
    """Customer keys that repeat, have gaps or are null; orders that repeat, or whose key is null."""
    customers = [(0, "a"), (1, "b"), (1, "b2"), (2, None), (7, "h"), (None, "z")]
    orders = [(1, 0), (2, 1), (2, 7), (4, 2), (4, 2), (11, 1), (None, 1), (5, 99), (6, None), (8, 7)]
    (spark.createDataFrame([(k, n, 3, "S") for k, n in customers], "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string")
     .write.parquet(f"{tmp_path}/customer.parquet"))
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    n = len(customers)
    rows = [(o, c) for o, c in orders for k, _ in customers if c is not None and k == c]
    want = []
    for o, c in rows:
        if o is None or o % 11 == 0:
            want.append((o, c, None))
            continue
        found = [(k, name) for o2, c2 in rows if o2 == o for at in (c2, (c2 + 1) % n) for k, name in customers if k == at]
        src = "Platform" if o % 4 == 0 else "Web"
        want.append((o, c, sorted(((f"CT{k}", name and f"{name}@MAIL.example", name, src) for k, name in found), key=repr)))
    df = fx.orders_with_contacts(spark, str(tmp_path))
    got = [(r["o_orderkey"], r["o_custkey"], None if r["cts"] is None else sorted((tuple(x) for x in r["cts"]), key=repr)) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_messages_read_the_orders_once(spark):
    workspace(spark, SF_SMALL)
    plan = fx.crm_messages(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("orders.parquet") == 1


def test_tasks_that_stage_and_store_read_small_pieces(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from tidemark import session
    from tidemark.sources.state import ParquetStore
    seen = []
    for name in ("parquet", "save"):
        write = getattr(DataFrameWriter, name)
        monkeypatch.setattr(DataFrameWriter, name, lambda self, *a, write=write, **k: (seen.append(int(spark.conf.get(session.SPLIT_KEY).rstrip("bMB"))), write(self, *a, **k)))
    df = spark.range(3).selectExpr("id as prospect_id", "id as organiser_Id")
    before = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    Workspace(spark, SF_SMALL).stage("t", lambda: df)
    store = ParquetStore(spark, f"{tmp_path}/state")
    store.stage("t", df)
    store.put("prospects", df)
    store.upsert("prospects", df, ["prospect_id"], 0)
    assert len(seen) >= 4 and set(seen) == {session.SPLIT_BYTES} and session.SPLIT_BYTES < before
    assert spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == before
    assert store.read("prospects").count() == 3


def test_warehouse_files_are_compressed_like_the_state(spark, tmp_path):
    from tidemark.sources.warehouse import WarehouseConf, append_warehouse, read_appended
    for append_only in (False, True):
        conf = WarehouseConf(root=f"{tmp_path}/{append_only}", append_only=append_only)
        append_warehouse(spark.range(3), conf, "t", "run", 0)
        files = read_appended(spark, conf, "t").inputFiles()
        assert files and all(".zstd." in f for f in files)
        assert read_appended(spark, conf, "t").count() == 3
