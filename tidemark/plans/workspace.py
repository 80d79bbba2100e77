"""Stage tables of the check queries, written once per session and data folder.

The production job reads its inputs from topics and stored tables, so every
step's plan starts at a scan. The checks reproduce that: the messages built from
the given tables and each stored state (CDC state after a batch, the prospect
table, the contact table, ...) are written as parquet tables in the shared
folder (``spark.checkpoint.dir``) and read back. This cuts lineage at the same
boundaries as the streaming job and survives executor loss (the files are on
shared storage, not in executor memory).
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import fixtures as fx
from tidemark.operators.decode import decode_envelope
from tidemark.plans.cdc import (
    CdcState, apply_registrations, apply_user_registrations, apply_users, batch_changes, empty_state,
    joined_changes,
)
from tidemark.operators.attribution import opportunity_latest, registrations_for_attribution
from tidemark.operators.funnel import event_funnel
from tidemark.plans.crm import CrmConf, Recomputed, ingest_prospects, recompute
from tidemark.session import fresh_dir, lean_writes
from tidemark.sources.kafka import kafka_record

NOW = 1_700_000_000          # fixed load time of the checks (seconds)
FUNNEL_CONF = CrmConf(unattributed="zero_row")


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = fresh_dir(spark, "ws")
        self._paths: dict[str, str] = {}
        self._lock = threading.RLock()

    #: Tables with a folder a value: the column and all its values.
    FOLDERS = {"cdc_messages": ("file_no", fx.CDC_FILES)}

    def stage(self, name: str, build) -> DataFrame:
        """Write ``build()`` once as table ``name`` and return a scan of it. Of a table with folders the rows of each are
        written by themselves (Spark's partitioned write would sort them)."""
        with self._lock:
            if name not in self._paths:
                path, df = f"{self.root}/{name}", build()
                parts = {path: df}
                if name in self.FOLDERS:
                    by, values = self.FOLDERS[name]
                    parts = {f"{path}/{by}={v}": df.filter(F.col(by) == v).drop(by) for v in values}
                with lean_writes(self.spark):
                    for at, rows in parts.items():
                        # files are split by size as well, so large tables do not depend on the core count
                        rows.write.options(maxRecordsPerFile=500_000, compression="zstd").mode("overwrite").parquet(at)
                self._paths[name] = path
        return self.spark.read.parquet(self._paths[name])

    # -- messages -----------------------------------------------------------------
    # The messages are written as the tasks make them: shuffling the finished texts only to even out the files would sort
    # and move the largest rows there are. Nothing downstream depends on physical order (ordering uses ts / offset).
    def cdc_messages(self) -> DataFrame:
        """The change records, a folder a stream file: a batch reads its own messages only."""
        return self.stage("cdc_messages", lambda: fx.cdc_messages(self.spark, self.sf_dir))

    def crm_messages(self) -> DataFrame:
        return self.stage("crm_messages", lambda: fx.crm_messages(self.spark, self.sf_dir))

    def sync_messages(self) -> DataFrame:
        return self.stage("sync_messages", lambda: fx.sync_messages(self.spark, self.sf_dir))

    def rates(self) -> DataFrame:
        return self.stage("rates", lambda: fx.rates(self.spark, self.sf_dir))

    # -- CDC ------------------------------------------------------------------------
    def envelopes(self, files: tuple[int, ...] | None = None) -> DataFrame:
        m = self.cdc_messages()
        if files is not None:
            m = m.filter(F.col("file_no").isin(*files))
        return decode_envelope(kafka_record(m.drop("file_no")))

    def cdc_state(self, upto: int) -> CdcState:
        """State after applying stream files 0..upto as separate batches
        (``upto=-1``: empty; ``upto=9``: all messages as one batch)."""
        if upto < 0:
            return empty_state(self.spark)
        return CdcState(self.cdc_users(upto), self.cdc_registrations(upto), self.cdc_user_registrations(upto))

    # Each table of a batch is written when it is asked for: a step waits only for the tables it reads.
    def _before(self, upto: int, table) -> CdcState:
        """The empty state with ``table`` (a method of this class) as the batch before ``upto`` left it."""
        state = empty_state(self.spark)
        if upto not in (0, 9):
            setattr(state, table.__name__.removeprefix("cdc_"), table(upto - 1))
        return state

    def cdc_users(self, upto: int) -> DataFrame:
        return self.stage(f"cdc{upto}_users", lambda: apply_users(self._before(upto, self.cdc_users), batch_changes(self._batch(upto))[0]))

    def cdc_registrations(self, upto: int) -> DataFrame:
        return self.stage(f"cdc{upto}_registrations", lambda: apply_registrations(self._before(upto, self.cdc_registrations), self.cdc_changes(upto)))

    def cdc_joined(self, upto: int) -> DataFrame:
        return self.stage(f"cdc{upto}_joined", lambda: joined_changes(self.cdc_registrations(upto), self.cdc_users(upto), self.cdc_changes(upto), NOW))

    def cdc_user_registrations(self, upto: int) -> DataFrame:
        return self.stage(f"cdc{upto}_user_registrations",
                          lambda: apply_user_registrations(self._before(upto, self.cdc_user_registrations), self.cdc_joined(upto)))

    def _batch(self, upto: int) -> DataFrame:
        return self.envelopes(None if upto == 9 else (upto,))

    def cdc_changes(self, upto: int) -> DataFrame:
        """The change set of a batch; it depends on no state."""
        return self.stage(f"cdc{upto}_changes", lambda: batch_changes(self._batch(upto))[1])

    # -- attribution inputs ---------------------------------------------------------
    def attribution_registrations(self) -> DataFrame:
        """Registrations joined with their users, typed, without insert filters or
        patches (the registration side of the attribution and funnel checks)."""
        def build():
            r = fx.registrations(self.spark, self.sf_dir)
            u = fx.users(self.spark, self.sf_dir).filter(F.col("email").isNotNull())
            r = r.select(
                F.col("organiser_id").try_cast("bigint").alias("organiser_id"), "userId", "_id", "event_id",
                "exhibitor_id", "firstName", "lastName",
                F.round(F.col("initLoginAt").try_cast("double")).try_cast("bigint").alias("initLoginAt"),
                F.col("isLoggedIn").try_cast("boolean").alias("isLoggedIn"), "localCreatedAt", "source",
                "speaker_id")
            u = u.select(F.col("_id").alias("userId"), F.col("organiser_id").try_cast("bigint").alias("organiser_id"),
                         "email")
            return (r.join(u, ["organiser_id", "userId"], "left")
                    .withColumn("load_timestamp", F.lit(NOW).cast("bigint")))
        return self.stage("attr_registrations", build)

    # -- CRM ------------------------------------------------------------------------
    def prospects(self, batches: tuple[int, ...] = (0, 1)) -> DataFrame:
        tag = "prospects_" + "".join(map(str, batches))

        def build():
            m = self.crm_messages().filter(F.col("batch_no").isin(*batches)).drop("batch_no")
            return ingest_prospects(kafka_record(m), None, NOW)
        return self.stage(tag, build)

    def prospects_upserted(self) -> DataFrame:
        def build():
            m = self.crm_messages().filter(F.col("batch_no") == 1).drop("batch_no")
            return ingest_prospects(kafka_record(m), self.prospects((0,)), NOW)
        return self.stage("prospects_upserted", build)

    def contacts(self, batches: tuple[int, ...] = (0, 1)) -> DataFrame:
        tag = "contacts_" + "".join(map(str, batches))
        return self.stage(tag, lambda: recompute(self.prospects(batches), self.attribution_registrations(),
                                                 self.rates(), NOW, None, FUNNEL_CONF).contacts)

    def recomputed(self, batches: tuple[int, ...] = (0, 1)) -> Recomputed:
        """Contacts (the written table), opportunities and funnel of all tenants; the
        funnel reads the written contact table, as the gate does."""
        contacts = self.contacts(batches)
        reg = registrations_for_attribution(self.attribution_registrations())
        return Recomputed(contacts, opportunity_latest(self.prospects(batches), NOW),
                          event_funnel(contacts, reg, NOW, FUNNEL_CONF.unattributed))


_SPACES: dict[tuple[str, str], Workspace] = {}
_GUARD = threading.Lock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    # Epochs and dates of the given TIMESTAMP_NTZ columns are read as UTC wall time.
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    with _GUARD:
        if key not in _SPACES:
            _SPACES[key] = Workspace(spark, sf_dir)
        return _SPACES[key]


__all__ = ["Workspace", "workspace", "NOW", "FUNNEL_CONF"]
