"""One change batch -> new users, registrations and joined registration tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import (
    REGISTRATION_COLUMNS, USER_REGISTRATION_KEYS, apply_registration_changes, apply_user_inserts,
    change_types, changed_keys, changed_rows, registration_changes, with_bucket, with_user,
)
from tidemark.operators.decode import (
    KEPT, REJECTED, RULED_OUT, decode_registration_inserts, decode_registration_patches, decode_users, envelope_fates, kept,
    registration_insert_fates, registration_patch_fates, route, user_fates,
)
from tidemark.operators.merge import merge_upsert
from tidemark.sources.state import empty_frame

USERS_SCHEMA = T.StructType([T.StructField("_id", T.StringType()), T.StructField("organiser_id", T.LongType()),
                             T.StructField("email", T.StringType())])
REGISTRATIONS_SCHEMA = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("event_id", T.LongType()),
    T.StructField("exhibitor_id", T.StringType()), T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()), T.StructField("initLoginAt", T.LongType()),
    T.StructField("isLoggedIn", T.BooleanType()), T.StructField("localCreatedAt", T.DoubleType()),
    T.StructField("organiser_id", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("speaker_id", T.LongType()), T.StructField("userId", T.StringType()),
    T.StructField("bucket", T.IntegerType())])
USER_REGISTRATION_COLUMNS = ["organiser_id", "userId", *[c for c in REGISTRATION_COLUMNS
                                                         if c not in ("organiser_id", "userId", "bucket")],
                             "email", "load_timestamp"]
_REG_TYPES = {f.name: f.dataType for f in REGISTRATIONS_SCHEMA.fields}
USER_REGISTRATIONS_SCHEMA = T.StructType(
    [T.StructField(c, _REG_TYPES.get(c, T.StringType() if c == "email" else T.LongType()))
     for c in USER_REGISTRATION_COLUMNS])


@dataclass
class CdcConf:
    users_collection: str = "users"
    registrations_collection: str = "communities"
    patch_mode: str = "latest"        # "latest" (per-batch newest patch) or "fold"
    buckets: int = 100
    dotted: bool = False              # read dotted $set keys and $unset (see registration_patch_fates)
    warehouse_table: str = "community_users"     # may be schema-qualified


@dataclass
class CdcState:
    users: DataFrame
    registrations: DataFrame
    user_registrations: DataFrame


def empty_state(spark: SparkSession) -> CdcState:
    return CdcState(empty_frame(spark, USERS_SCHEMA), empty_frame(spark, REGISTRATIONS_SCHEMA),
                    empty_frame(spark, USER_REGISTRATIONS_SCHEMA))


@dataclass
class ChangeFates:
    """Every message of a batch with its fate, by decoder (see ``operators.decode``)."""
    envelopes: DataFrame
    users: DataFrame
    inserts: DataFrame
    patches: DataFrame

    def by_name(self) -> dict[str, DataFrame]:
        return {"envelopes": self.envelopes, "users": self.users, "registrations": self.inserts, "patches": self.patches}


def change_fates(rec: DataFrame, conf: CdcConf = CdcConf(), keep=lambda df: df) -> ChangeFates:
    """Kafka-shaped change records, decoded. ``keep`` may hold the envelopes, which every decoder reads. Envelopes of
    other collections are ruled out where the kept ones go on to the decoder of their collection."""
    known = F.col("collection").isin(conf.users_collection, conf.registrations_collection)
    env = envelope_fates(rec)
    other = (F.col("fate") == KEPT) & ~known
    env = keep(env.withColumns({"fate": F.when(other, RULED_OUT).otherwise(F.col("fate")), "reason": F.when(other, "other collection").otherwise(F.col("reason"))}))
    read = kept(env)
    comm = route(read, conf.registrations_collection)
    return ChangeFates(env, user_fates(route(read, conf.users_collection)), registration_insert_fates(comm),
                       registration_patch_fates(comm, conf.dotted))


def decoded_batch(envelopes: DataFrame, users: DataFrame, inserts: DataFrame, patches: DataFrame) -> DataFrame:
    """One frame of what the decoders made of a batch (kept envelopes are in theirs): registration changes are
    typed and bucketed, rows that carry nothing to apply or to report are left out."""
    about = ["topic", "partition", "offset", "decoder", "fate", "reason", "value"]
    out = envelopes.select(*about)
    for df in (users, with_bucket(change_types(inserts)), with_bucket(change_types(patches))):
        out = out.unionByName(df, allowMissingColumns=True)
    return out.filter((F.col("fate") == REJECTED) | ((F.col("fate") == KEPT) & (F.col("decoder") != "envelope")))


def batch_changes(env: DataFrame, conf: CdcConf = CdcConf()) -> tuple[DataFrame, DataFrame]:
    """Decoded envelopes -> (user inserts, registration change set)."""
    users = decode_users(route(env, conf.users_collection))
    comm = route(env, conf.registrations_collection)
    changes = registration_changes(decode_registration_inserts(comm), decode_registration_patches(comm))
    return users, changes


def apply_users(state: CdcState, users: DataFrame) -> DataFrame:
    return apply_user_inserts(state.users, users)


def apply_registrations(state: CdcState, changes: DataFrame, conf: CdcConf = CdcConf()) -> DataFrame:
    return apply_registration_changes(state.registrations, changes, conf.patch_mode).select(*REGISTRATION_COLUMNS)


def joined_changes(registrations: DataFrame, users: DataFrame, changes: DataFrame, now: int) -> DataFrame:
    """Current rows of the registrations this batch changed, joined with their user."""
    return with_user(changed_rows(registrations, changed_keys(changes)), users, now).select(*USER_REGISTRATION_COLUMNS)


def apply_user_registrations(state: CdcState, joined: DataFrame) -> DataFrame:
    return merge_upsert(state.user_registrations.select(*USER_REGISTRATION_COLUMNS), joined, USER_REGISTRATION_KEYS)


def apply_change_batch(env: DataFrame, state: CdcState, now: int,
                       conf: CdcConf = CdcConf()) -> tuple[CdcState, DataFrame]:
    """Users first, then registrations (inserts, then patches), then the joined rows
    of the registrations this batch touched. Returns the new state and the joined
    change rows (what a warehouse append receives)."""
    users_in, changes = batch_changes(env, conf)
    users = apply_users(state, users_in)
    regs = apply_registrations(state, changes, conf)
    joined = joined_changes(regs, users, changes, now)
    return CdcState(users, regs, apply_user_registrations(state, joined)), joined
