import logging
import shutil
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.plans.workspace import NOW, workspace
from tidemark.session import fresh_dir
from tidemark.sources.state import BUCKET, CDC_TABLES, CRM_TABLES, Layout, ParquetStore, read_dead_letters
from tidemark.streaming.cdc import cdc_batch
from conftest import SF_SMALL, rows


def files_of(spark, n=3):
    msgs = workspace(spark, SF_SMALL).cdc_messages()
    return [msgs.filter(f"file_no = {i}").drop("file_no") for i in range(n)]


def test_replayed_batches_change_nothing(spark):
    files = files_of(spark)
    store = ParquetStore(spark, fresh_dir(spark, "test-replay"))
    fn = cdc_batch(store, now=NOW)
    fn(files[0], 0)
    fn(files[1], 1)
    first = {t: rows(store.read(t)) for t in ("users", "registrations", "user_registrations")}
    fn(files[1], 1)                      # at-least-once: the same batch again
    fn(files[0], 0)                      # finished before the other one began: not applied
    assert {t: rows(store.read(t)) for t in first} == first


def test_an_erasure_between_two_batches(spark):
    """Erased rows are gone at once, no replay brings them back, and no later batch is hidden."""
    files = files_of(spark)
    store = ParquetStore(spark, fresh_dir(spark, "test-two"))
    fn = cdc_batch(store, now=NOW)
    gone = spark.createDataFrame([(5,)], "organiser_Id long")

    def tenant():
        return store.read("user_registrations").filter("organiser_id = 5").count()

    fn(files[0], 0)
    before = store.read("user_registrations").count()
    assert tenant() > 0
    era = store.begin("sync.a", 0)[0]
    assert store.erase(gone, era) == era + 1
    assert tenant() == 0
    fn(files[0], 0)                              # a replay brings nothing back
    assert tenant() == 0
    fn(files[1].limit(0), 1)                     # nor does an empty change batch
    assert tenant() == 0
    store.erase(spark.createDataFrame([(6,)], "organiser_Id long"), store.begin("sync.a", 1)[0])
    fn(files[1], 2)                              # and no batch is hidden by erasures
    assert store.read("user_registrations").count() > before and tenant() > 0
    fn(files[2], 3)
    fn(files[1], 2)
    again = rows(store.read("user_registrations"))
    assert store.begin("sync.a", 0) is None      # a later notice batch followed: this one is finished
    store.erase(gone, era)                       # and in its own era it erases nothing that came later
    assert rows(store.read("user_registrations")) == again


def test_a_batch_that_runs_while_a_tenant_is_erased(spark):
    """What a batch begun before an erasure writes after it is hidden as well."""
    store = ParquetStore(spark, fresh_dir(spark, "test-during"))
    schema = "organiser_Id long, prospect_id string"
    old = store.begin("crm.a", 0)[0]
    store.erase(spark.createDataFrame([(2,)], "organiser_Id long"), store.begin("sync.a", 0)[0])
    keys = ["organiser_Id", "prospect_id"]
    store.upsert("prospects", spark.createDataFrame([(1, "p"), (2, "p")], schema), keys, old)
    assert rows(store.read("prospects")) == [(1, "p")]
    new = store.begin("crm.a", 1)[0]
    store.upsert("prospects", spark.createDataFrame([(2, "q")], schema), keys, new)
    assert rows(store.read("prospects")) == [(1, "p"), (2, "q")]


def test_purged_rows_leave_the_disk(spark):
    store = ParquetStore(spark, fresh_dir(spark, "test-disk"))
    schema = "organiser_Id long, prospect_id string"
    letters = "topic string, partition int, offset long, decoder string, reason string, kept boolean, organiser_Id long, value string"
    store.append("crm_dead_letters", spark.createDataFrame([("t", 0, i, "prospects", "x", False, i, "v") for i in (1, 2)], letters))
    store.upsert("prospects", spark.createDataFrame([(t, f"p{k}") for t in (1, 2, 3) for k in range(20)], schema), ["organiser_Id", "prospect_id"])
    store.erase(spark.createDataFrame([(2,), (3,)], "organiser_Id long"), store.begin("sync.a", 0)[0])
    store.purge(CRM_TABLES)
    for t in ("prospects", "crm_dead_letters"):
        left = spark.read.parquet(f"{store.root}/{t}").filter("organiser_Id is not null")
        assert rows(left.select("organiser_Id").distinct()) == [(1,)] and store.read(t).filter("organiser_Id = 1").count() > 0
    store.upsert("prospects", spark.createDataFrame([(3, "again")], schema), ["organiser_Id", "prospect_id"], store.era())
    assert rows(store.read("prospects").filter("organiser_Id = 3")) == [(3, "again")]


def test_only_touched_buckets_are_read_and_written(spark):
    store = ParquetStore(spark, fresh_dir(spark, "test-buckets"), {"users": Layout("_id", parts=64)})
    schema = "_id string, organiser_id long, email string"
    store.insert_if_absent("users", spark.createDataFrame([(f"u{i}", 1, "a") for i in range(500)], schema), ["_id"])

    def held():
        return {p.name: sorted(f.name for f in p.glob("part-*")) for p in Path(store.root.removeprefix("file:"), "users").glob(f"{BUCKET}=*")}

    full = held()
    new, at = store.stage("new", spark.createDataFrame([("u1", 2, "b"), ("new", 2, "b")], schema), {"users": store.bucket_of("users")})
    assert at["users"] == store.touched("users", new) and len(at["users"]) <= 2
    store.upsert("users", new, ["_id"], 0, at["users"])
    after = held()
    assert len(full) > 50 and {b for b in after if after[b] != full.get(b)} == {f"{BUCKET}={b}" for b in at["users"]}
    near = store.read("users", only=at["users"])
    files = [r[0] for r in near.select(F.input_file_name()).distinct().collect()]
    assert files and all(any(f"{BUCKET}={b}/" in f for b in at["users"]) for f in files)
    assert f"PartitionFilters: [{BUCKET}" in near._jdf.queryExecution().executedPlan().toString()
    assert store.read("users").count() == 501 and rows(store.read("users").filter("_id = 'u1'")) == [("u1", 2, "b")]


def test_a_commit_that_a_lost_driver_left_half_done_is_finished(spark):
    store = ParquetStore(spark, fresh_dir(spark, "test-recover"))
    schema = "_id string, organiser_id long, email string"
    store.insert_if_absent("users", spark.createDataFrame([(f"u{i}", 1, "a") for i in range(300)], schema), ["_id"])
    want = rows(store.read("users"))
    table = Path(store.root.removeprefix("file:"), "users")
    left = table / ".spark-staging-0"
    left.mkdir()
    shutil.move(table / f"{BUCKET}=3", left / f"{BUCKET}=3")       # deleted in the table, not yet moved there
    assert len(rows(store.read("users"))) < 300
    store.recover(CDC_TABLES)                                      # written in part only: not taken
    assert len(rows(store.read("users"))) < 300
    (left / "_SUCCESS").touch()
    store.recover(CDC_TABLES)
    assert rows(store.read("users")) == want and not left.exists()
    store.recover(CDC_TABLES)
    assert rows(store.read("users")) == want


def test_run_rows_do_not_pile_up(spark):
    store = ParquetStore(spark, fresh_dir(spark, "test-runs"))
    for i in range(5):
        assert store.begin("cdc.a", i) == (0, 0) and store.begin("cdc.b", i) == (0, 0)
    assert store.begin("cdc.a", 3) is None and spark.read.parquet(f"{store.root}/_runs").count() == 2


def test_dead_letters_of_a_stream(spark):
    """Three records that cannot be read end up as dead letters, once, however often the batch runs."""
    from tidemark.schemas import KAFKA_RECORD
    values = [b"{broken", b'{"payload":{"after":"{oops","source":"{\\"db\\":\\"app\\",\\"collection\\":\\"users\\",\\"ts_ms\\":1}"}}', None]
    batch = spark.createDataFrame([(None, v, "cdc.app.t", 0, i, None, 0) for i, v in enumerate(values)], KAFKA_RECORD)
    store, seen = ParquetStore(spark, fresh_dir(spark, "test-dead")), []
    for _ in range(2):
        cdc_batch(store, now=NOW, report=seen.append)(batch, 0)
    got = rows(read_dead_letters(store), "offset", "decoder", "reason", "kept", "value")
    assert got == [(0, "envelope", "unreadable envelope", False, "{broken"), (1, "users", "unreadable document", False, "{oops"),
                   (2, "envelope", "no value", False, None)]
    assert [c["envelopes"] for c in seen] == [{"read": 3, "kept": 1, "ruled_out": 0, "rejected": 2, "partly_read": 0}] * 2
    assert seen[0]["users"]["rejected"] == 1 and store.read("users") is None


def test_running_stream_with_a_trigger_reports_its_counts(spark, caplog):
    """A stream with a one-second trigger: counts of each batch and the engine's progress in the log, then stop()."""
    from tidemark.sources.kafka import StreamConf
    from tidemark.streaming.cdc import start_cdc_stream
    from tidemark.streaming.metrics import ProgressLog
    root = fresh_dir(spark, "test-trigger")
    files = files_of(spark)
    files[0].write.parquet(f"{root}/in")
    store, seen, events = ParquetStore(spark, f"{root}/state"), [], []
    listener = ProgressLog(events.append)
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="tidemark.metrics"):
            q = start_cdc_stream(spark, StreamConf(format="parquet", path=f"{root}/in"), fx.CDC_TOPIC_PATTERN, store, f"{root}/ckpt",
                                 {"processingTime": "1 second"}, report=seen.append)
            for expected in (1, 2):
                end = time.time() + 120
                while len(seen) < expected and time.time() < end and q.exception() is None:
                    time.sleep(0.2)
                if expected == 1:
                    files[1].write.mode("append").parquet(f"{root}/in")
            q.stop()
        assert not q.isActive and q.exception() is None
        assert [c["envelopes"]["read"] for c in seen] == [files[0].count(), files[1].count()] and [c["batch"] for c in seen] == [0, 1]
        assert seen[0]["users"]["kept"] == store.read("users").count()
        end = time.time() + 30
        while not any(e["event"] == "terminated" for e in events) and time.time() < end:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert {e["event"] for e in events} >= {"started", "progress", "terminated"}
    assert sum(e.get("rows", 0) for e in events) == files[0].count() + files[1].count()


def test_store_format_is_explicit(spark):
    from tidemark.sources.state import open_store
    with pytest.raises(ValueError):
        open_store(spark, "x", "snapshot")
    assert isinstance(open_store(spark, "x", "parquet"), ParquetStore)


def test_large_notice_batches_are_sliced(spark):
    from tidemark.streaming.sync import tenant_slices
    tenants = spark.range(1000).withColumnRenamed("id", "organiser_Id")
    parts = [rows(p) for p in tenant_slices(tenants, 100)]
    assert max(map(len, parts)) <= 100 and sorted(x for p in parts for x in p) == [(i,) for i in range(1000)]
    assert tenant_slices(tenants.limit(0), 100) == []


def test_job_entry_points_over_files(spark):
    """Both long-running jobs, started through the job runner with file sources and a
    drain-once trigger, reach the same tables as the check queries."""
    from tidemark.jobs import run
    from tidemark.plans.checks import QUERIES
    ws = workspace(spark, SF_SMALL)
    root = fresh_dir(spark, "test-jobs")
    for f in range(3):
        ws.cdc_messages().filter(F.col("file_no") == f).drop("file_no").write.mode("append").parquet(f"{root}/cdc_in")
        conf = {"state_root": f"{root}/state", "state_format": "parquet", "checkpoint_root": f"{root}/ckpt",
                "trigger": {"availableNow": True},
                "cdc": {"source": {"format": "parquet", "path": f"{root}/cdc_in"}, "topic_pattern": fx.CDC_TOPIC_PATTERN}}
        run("cdc", conf, spark).awaitTermination()
    got = ParquetStore(spark, f"{root}/state").read("user_registrations")
    assert rows(got, "_id", "organiser_id", "email", "event_id") == \
        rows(QUERIES["registration_upsert"](spark, SF_SMALL), "_id", "organiser_id", "email", "event_id")

    ParquetStore(spark, f"{root}/state2").put("user_registrations", ws.attribution_registrations())
    conf["state_root"] = f"{root}/state2"
    ws.rates().write.parquet(f"{root}/wh/exchange_rates")
    ws.crm_messages().drop("batch_no").write.parquet(f"{root}/crm_in")
    ws.sync_messages().filter("batch_no = 0").drop("batch_no").write.parquet(f"{root}/sync_in")
    conf["sync"] = {"notices": {"format": "parquet", "path": f"{root}/sync_in"}, "notice_topic": fx.SYNC_TOPIC,
                    "crm": {"format": "parquet", "path": f"{root}/crm_in"}, "crm_topic": fx.PROSPECT_TOPIC, "contact_table": "crm.contact",
                    "rates": {"format": "parquet", "root": f"{root}/wh"}, "unattributed": "zero_row",
                    "warehouse": {"format": "parquet", "root": f"{root}/wh_out"}}
    run("sync", conf, spark).awaitTermination()
    funnel = ParquetStore(spark, f"{root}/state2").read("event_agg").drop("load_timestamp")
    want = QUERIES["stream_sync_gate"](spark, SF_SMALL).drop("load_timestamp")
    assert rows(funnel) == rows(want.select(*funnel.columns))
    assert spark.read.json(f"{root}/ckpt/published").count() == 10
    appended = spark.read.parquet(f"{root}/wh_out/roi_event_wise_agg")
    assert appended.count() == funnel.count() and appended.select("run_id", "batch_id").distinct().count() == 1
    assert spark.read.parquet(f"{root}/wh_out/crm.contact").count() > 0
    # the run id is the streaming query's, not the fallback
    assert appended.first()["run_id"] != "batch"


def test_one_shot_batch_api_equals_staged_state(spark):
    from tidemark.plans.cdc import apply_change_batch, empty_state
    ws = workspace(spark, SF_SMALL)
    st, joined = apply_change_batch(ws.envelopes(), empty_state(spark), NOW)
    staged = ws.cdc_state(9)
    assert rows(st.registrations) == rows(staged.registrations)
    assert rows(st.user_registrations) == rows(staged.user_registrations)
    assert rows(joined) == rows(staged.user_registrations)


def test_restart_without_new_data_fires_no_batch(spark):
    from tidemark.sources.kafka import StreamConf, read_changes
    from tidemark.streaming.cdc import drain
    ws = workspace(spark, SF_SMALL)
    root = fresh_dir(spark, "test-restart")
    store = ParquetStore(spark, f"{root}/state")
    fn = cdc_batch(store, now=NOW)
    ws.cdc_messages().filter(F.col("file_no") == 0).drop("file_no").write.parquet(f"{root}/in")
    drain(read_changes(spark, StreamConf(format="parquet", path=f"{root}/in"), fx.CDC_TOPIC_PATTERN), fn, f"{root}/ckpt")
    before = sorted(store.read("user_registrations").inputFiles())
    drain(read_changes(spark, StreamConf(format="parquet", path=f"{root}/in"), fx.CDC_TOPIC_PATTERN), fn, f"{root}/ckpt")          # restart, nothing new
    assert sorted(store.read("user_registrations").inputFiles()) == before


def test_gate_handles_notice_before_any_payload(spark):
    from tidemark.streaming.sync import sync_batch
    ws = workspace(spark, SF_SMALL)
    store = ParquetStore(spark, fresh_dir(spark, "test-early"))
    published = []
    fn = sync_batch(store, ws.rates, lambda: None, lambda df: published.append(df.count()), now=NOW)
    fn(ws.sync_messages().filter("batch_no = 0").drop("batch_no"), 0)
    assert store.read("event_agg").count() == 0 and published == [10]
