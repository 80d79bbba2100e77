"""Command-line entry points for the two long-running jobs.

    python -m tidemark.jobs cdc  --conf job.json
    python -m tidemark.jobs sync --conf job.json

``job.json`` holds only non-secret settings; connection secrets (brokers with
credentials, warehouse passwords) are expected in the Spark configuration or the
environment of the cluster, never in code or in this repository. Keys:

    state_root, state_format ("delta" | "parquet"), checkpoint_root,
    partition_by (Delta only, e.g. {"registrations": ["bucket"], "contacts": ["organiser_Id"]}),
    trigger (e.g. {"processingTime": "5 minutes"}),
    cdc:  {"source": {"format": "kafka", "options": {...}}, "topic_pattern": "...",
           "patch_mode": "latest", "dotted": false (read dotted $set keys and $unset), "warehouse": {"format": ..., "root": ..., "options": {...}},
           "warehouse_table": "community_users"}
    sync: {"notices": {...}, "notice_topic": "...", "crm": {...}, "crm_topic": "...",
           "rates": {"format": ..., "root"|"options": ...}, "rates_table": "exchange_rates",
           "rates_latest_by": null (the column that orders a rate history), "platform_source": "...",
           "unattributed": "keep", "legacy_prospect_key": false, "time_patterns": [patterns beyond the built-in time forms],
           "contact_table" | "opportunity_table" | "funnel_table": warehouse tables}

Table names may be schema-qualified. The jobs set the session zone to UTC and ANSI mode on, which
dates and casts depend on; the rate table is read anew for every recompute. Every batch logs its counts (logger
``tidemark.metrics``), and so does every micro-batch's progress.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from tidemark.plans.cdc import CdcConf
from tidemark.plans.crm import CrmConf
from tidemark.sources.kafka import StreamConf
from tidemark.sources.state import open_store
from tidemark.sources.warehouse import WarehouseConf, read_warehouse
from tidemark.streaming.cdc import start_cdc_stream
from tidemark.streaming.metrics import ProgressLog
from tidemark.streaming.sync import start_sync_stream


def _stream(d: dict) -> StreamConf:
    return StreamConf(format=d.get("format", "kafka"), path=d.get("path"), options=d.get("options", {}),
                      starting_offsets=d.get("starting_offsets", "earliest"),
                      max_files_per_trigger=d.get("max_files_per_trigger"))


def run(kind: str, conf: dict, spark: SparkSession | None = None):
    spark = spark or SparkSession.builder.appName(f"tidemark-{kind}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.streams.addListener(ProgressLog())
    store = open_store(spark, conf["state_root"], conf["state_format"], conf.get("partition_by"))
    trigger = conf.get("trigger")
    if kind == "cdc":
        c = conf["cdc"]
        wh = WarehouseConf(**c["warehouse"]) if c.get("warehouse") else None
        return start_cdc_stream(spark, _stream(c["source"]), c["topic_pattern"], store,
                                f"{conf['checkpoint_root']}/cdc", trigger,
                                CdcConf(patch_mode=c.get("patch_mode", "latest"), dotted=c.get("dotted", False),
                                        warehouse_table=c.get("warehouse_table", CdcConf.warehouse_table)), wh)
    if kind == "sync":
        c = conf["sync"]
        def rates():
            return read_warehouse(spark, WarehouseConf(**c["rates"]), c.get("rates_table", "exchange_rates"))

        own = ("platform_source", "unattributed", "rates_latest_by", "legacy_prospect_key", "time_patterns", "contact_table",
               "opportunity_table", "funnel_table")
        crm = CrmConf(**{k: tuple(c[k]) if k == "time_patterns" else c[k] for k in own if k in c})
        wh = WarehouseConf(**c["warehouse"]) if c.get("warehouse") else None
        return start_sync_stream(spark, _stream(c["notices"]), c["notice_topic"], _stream(c["crm"]), c["crm_topic"],
                                 store, rates, conf["checkpoint_root"], crm, trigger, wh)
    raise ValueError(f"unknown job {kind!r}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark.jobs")
    ap.add_argument("job", choices=["cdc", "sync"])
    ap.add_argument("--conf", required=True, help="JSON file with the job settings")
    a = ap.parse_args(argv)
    with open(a.conf) as fh:
        conf = json.load(fh)
    run(a.job, conf).awaitTermination()


if __name__ == "__main__":
    main()
