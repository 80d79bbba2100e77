"""Registration change sets: union, typing, empty-change filter, bucket, apply, join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import any_not_null, ascii_bucket, to_bool, to_epoch_long
from tidemark.operators.latest import latest_per
from tidemark.operators.merge import merge_insert, merge_insert_patch
from tidemark.schemas import REGISTRATION_FIELDS

CHANGE_META = ["ts_ms", "partition", "offset", "OPS"]
REGISTRATION_COLUMNS = ["_id", *REGISTRATION_FIELDS, "bucket"]
REG_KEYS = ["_id", "bucket"]
# Latest change first: newest source time, then the Kafka position.
CHANGE_ORDER = ["ts_ms", "partition", "offset"]


def change_union(inserts: DataFrame, patches: DataFrame) -> DataFrame:
    """INSERT and UPDATE rows in one frame, aligned by name."""
    cols = ["_id", *REGISTRATION_FIELDS, *CHANGE_META]
    return inserts.select(*cols).unionByName(patches.select(*cols))


def change_types(changes: DataFrame) -> DataFrame:
    """Text flags and epochs to typed columns: login flag -> boolean, login time -> bigint."""
    return (changes.withColumn("isLoggedIn", to_bool("isLoggedIn"))
            .withColumn("initLoginAt", to_epoch_long("initLoginAt")))


def drop_empty(changes: DataFrame) -> DataFrame:
    """Drop changes that carry no field (empty or unset-only patches, deletes)."""
    return changes.filter(any_not_null(REGISTRATION_FIELDS))


def with_bucket(changes: DataFrame, buckets: int = 100) -> DataFrame:
    return changes.withColumn("bucket", ascii_bucket("_id", buckets))


def registration_changes(inserts: DataFrame, patches: DataFrame) -> DataFrame:
    """The change set of one batch: union, typed, non-empty, bucketed."""
    return with_bucket(drop_empty(change_types(change_union(inserts, patches))))


def latest_patches(changes: DataFrame, mode: str = "latest") -> DataFrame:
    """One UPDATE per registration.

    ``latest``: the newest patch wins whole (fields of earlier patches in the same
    batch are lost, as a per-batch MERGE does). ``fold``: each field takes its newest
    non-NULL value across the batch's patches."""
    upd = changes.filter(F.col("OPS") == "UPDATE")
    if mode == "latest":
        return latest_per(upd, REG_KEYS, CHANGE_ORDER)
    if mode != "fold":
        raise ValueError(f"unknown patch mode {mode!r}")
    order = F.struct(*CHANGE_ORDER)
    if "unset" in upd.columns:      # a field's newest word: its value, or that it is unset
        gone = {c: F.coalesce(F.array_contains("unset", c), F.lit(False)) & F.col(c).isNull() for c in REGISTRATION_FIELDS}
        last = {c: F.max_by(F.struct(F.col(c).alias("value"), gone[c].alias("gone")), F.when(F.col(c).isNotNull() | gone[c], order)) for c in REGISTRATION_FIELDS}
        aggs = [x["value"].alias(c) for c, x in last.items()]
        aggs.append(F.array_compact(F.array(*[F.when(x["gone"], F.lit(c)) for c, x in last.items()])).alias("unset"))
    else:
        aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in REGISTRATION_FIELDS]
    aggs += [F.max_by(F.col(c), order).alias(c) for c in CHANGE_META]
    return upd.groupBy(*REG_KEYS).agg(*aggs)


def apply_registration_changes(state: DataFrame, changes: DataFrame, mode: str = "latest") -> DataFrame:
    """Inserts first (insert-if-absent, newest per key), then NULL-preserving patches."""
    ins = latest_per(changes.filter(F.col("OPS") == "INSERT"), REG_KEYS, CHANGE_ORDER)
    pat = latest_patches(changes, mode).select(*REG_KEYS, *REGISTRATION_FIELDS)
    return merge_insert_patch(state.select(*REGISTRATION_COLUMNS), ins.select(*REGISTRATION_COLUMNS), pat,
                              REG_KEYS, REGISTRATION_FIELDS)


def apply_user_inserts(state: DataFrame, users: DataFrame) -> DataFrame:
    """Users are insert-only; the newest record per id within a batch is the one inserted."""
    new = latest_per(users, ["_id"], CHANGE_ORDER).select("_id", "organiser_id", "email")
    return merge_insert(state.select("_id", "organiser_id", "email"), new, ["_id"])


def changed_keys(changes: DataFrame) -> DataFrame:
    return changes.select(*REG_KEYS).distinct()


def changed_rows(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Current rows of the registrations a batch touched (semi join, so a key listed
    twice never duplicates a row)."""
    return state.join(keys, REG_KEYS, "left_semi")


def with_user(registrations: DataFrame, users: DataFrame, now: int) -> DataFrame:
    """Registration ⟕ user on (tenant, user id), stamped with the load time.

    ``registrations`` are the rows a batch changed, so one plain join does: Spark broadcasts
    them when they are few, and stores hand over only the users' buckets they need."""
    u = users.withColumnRenamed("_id", "userId")
    return (registrations.drop("bucket").join(u, ["organiser_id", "userId"], "left")
            .withColumn("load_timestamp", F.lit(now).cast("bigint")))


USER_REGISTRATION_KEYS = ["organiser_id", "userId", "_id"]
