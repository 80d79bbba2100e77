"""Benchmark of the headline pipeline steps.

Each step is computed from its stored inputs (Kafka-shaped message tables and
current-state tables, written once in a setup phase), exactly as the streaming
job runs it, and fully executed (noop sink, or the real state writes for the
stream runs). Stream input is written outside the timed region; the streams' times with it are reported beside.
Prints one JSON line, with the shuffle and spill megabytes of each step (all its repeats) from the event log.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3; median reported)
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators.attribution import registrations_for_attribution  # noqa: E402
from tidemark.operators.decode import decode_prospects  # noqa: E402
from tidemark.operators.funnel import event_funnel  # noqa: E402
from tidemark.operators.prospects import prepare_prospects  # noqa: E402
from tidemark import fixtures as fx  # noqa: E402
from tidemark.streaming.cdc import cdc_batch as cdc_batch_fn, drain  # noqa: E402
from tidemark.streaming.sync import start_sync_stream  # noqa: E402
from tidemark.plans.crm import recompute  # noqa: E402
from tidemark.plans.workspace import FUNNEL_CONF, NOW, workspace  # noqa: E402
from tidemark.session import build_session, fresh_dir  # noqa: E402
from tidemark.sources.kafka import StreamConf, kafka_record, read_changes  # noqa: E402
from tidemark.sources.state import ParquetStore  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def moved(log_dir: str, spans: dict[str, tuple[float, float]]) -> dict[str, dict[str, float]]:
    """Megabytes written to shuffles and spilled by the tasks that ended in each step's span."""
    out = {name: {"shuffle_mb": 0.0, "spill_mb": 0.0} for name in spans}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        with open(path, errors="replace") as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                e = json.loads(line)
                m, at = e.get("Task Metrics") or {}, e["Task Info"]["Finish Time"] / 1000
                for name, (a, b) in spans.items():
                    if a <= at <= b:
                        out[name]["shuffle_mb"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                        out[name]["spill_mb"] += m.get("Disk Bytes Spilled", 0) / 1e6
    return {k: {n: round(x, 1) for n, x in v.items()} for k, v in out.items()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    log_dir = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = build_session(f"local[{cpus}]", cpus, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    ws = workspace(spark, sf_dir)

    t0 = time.time()
    cdc_msgs, crm_msgs, rates = ws.cdc_messages(), ws.crm_messages(), ws.rates()
    regs, prospects = ws.attribution_registrations(), ws.prospects()
    contacts, sync_msgs = ws.contacts(), ws.sync_messages()
    setup = time.time() - t0

    def cdc_batch():
        # the change stream's foreachBatch body on one batch holding every message
        store = ParquetStore(spark, fresh_dir(spark, "bench-cdc"))
        cdc_batch_fn(store, now=NOW)(cdc_msgs.drop("file_no"), 0)

    def crm_ingest():
        run(prepare_prospects(decode_prospects(kafka_record(crm_msgs.drop("batch_no"))), NOW))

    def contact_table():
        run(recompute(prospects, regs, rates, NOW, None, FUNNEL_CONF).contacts)

    def funnel():
        run(event_funnel(contacts, registrations_for_attribution(regs), NOW, FUNNEL_CONF.unattributed))

    def flagship_chain():
        store = ParquetStore(spark, fresh_dir(spark, "bench-chain"))
        store.put("prospects", prepare_prospects(decode_prospects(kafka_record(crm_msgs.drop("batch_no"))), NOW))
        r = recompute(store.read("prospects"), regs, rates, NOW, None, FUNNEL_CONF)
        store.put("contacts", r.contacts)
        c = store.read("contacts")
        store.put("opportunities", r.opportunities)
        run(event_funnel(c, registrations_for_attribution(regs), NOW, FUNNEL_CONF.unattributed))

    def stream_cdc():
        """Three files, each drained by its own run; returns the seconds of the runs alone."""
        root = fresh_dir(spark, "bench-stream-cdc")
        source = StreamConf(format="parquet", path=f"{root}/in")
        fn, took = cdc_batch_fn(ParquetStore(spark, f"{root}/state"), now=NOW), 0.0
        for i in range(3):
            cdc_msgs.filter(F.col("file_no") == i).drop("file_no").write.mode("append").parquet(source.path)
            t = time.time()
            drain(read_changes(spark, source, fx.CDC_TOPIC_PATTERN), fn, f"{root}/checkpoint")
            took += time.time() - t
        return took

    def stream_sync():
        """Two notice batches through the gate; returns the seconds of the runs alone."""
        root = fresh_dir(spark, "bench-stream-sync")
        store, took = ParquetStore(spark, f"{root}/state"), 0.0
        store.put("user_registrations", regs)
        crm_msgs.drop("batch_no").write.parquet(f"{root}/crm_in")
        for i in range(2):
            sync_msgs.filter(F.col("batch_no") == i).drop("batch_no").write.mode("append").parquet(f"{root}/sync_in")
            t = time.time()
            start_sync_stream(spark, StreamConf(format="parquet", path=f"{root}/sync_in"), fx.SYNC_TOPIC,
                              StreamConf(format="parquet", path=f"{root}/crm_in"), fx.PROSPECT_TOPIC, store, lambda: rates,
                              f"{root}/checkpoints", FUNNEL_CONF, {"availableNow": True}, now=NOW).awaitTermination()
            took += time.time() - t
        return took

    steps = {
        "cdc_batch_apply": cdc_batch,
        "crm_ingest": crm_ingest,
        "contact_table": contact_table,
        "event_funnel": funnel,
        "flagship_chain": flagship_chain,
        "stream_cdc_apply": stream_cdc,
        "stream_sync_gate": stream_sync,
    }
    out, whole, spans = {}, {}, {}
    steps["cdc_batch_apply"]()  # one warm-up (JIT, codegen caches)
    for name, fn in steps.items():
        times, walls, began = [], [], time.time()
        for _ in range(repeat):
            t = time.time()
            took = fn()
            walls.append(time.time() - t)
            times.append(walls[-1] if took is None else took)
        spans[name] = (began, time.time())
        out[name] = round(statistics.median(times), 3)
        if took is not None:
            whole[name] = round(statistics.median(walls), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    spark.stop()
    print(json.dumps({"metric": "headline_pipeline_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(m.group(1)) if m else None, "cpus": cpus,
                      "setup_sec": round(setup, 3), "repeat": repeat, "with_input_writing": whole, "moved": moved(log_dir, spans)}))


if __name__ == "__main__":
    main()
