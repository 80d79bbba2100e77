"""Current-state maintenance in portable DataFrame form.

These are the relational equivalents of MERGE INTO / DELETE: the new state is a
function of the old state and a change set. Keys compare NULL-safe, so a NULL key
is a key like any other and does not re-insert itself on every run.
When the state lives in a table format with MERGE (see ``sources.state``) the
same semantics run as a MERGE; this module is what the check queries use.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys_as(df: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    """Only the key columns, renamed: joins stay unambiguous even when both inputs
    come from one lineage (e.g. ``merge_upsert(df, df.filter(...))``)."""
    return df.select(*[F.col(k).alias(f"{tag}{k}") for k in keys])


def _on(keys: Sequence[str], tag: str):
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{tag}{k}")) for k in keys])


def merge_insert(base: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows of ``src`` whose key is absent from ``base``; keep base rows as they are.

    ``src`` must be unique per key (use ``latest_per`` first)."""
    src = src.select(*base.columns)
    new = src.join(_keys_as(base, keys, "__b_"), _on(keys, "__b_"), "left_anti")
    return base.unionByName(new)


def merge_patch(base: DataFrame, patch: DataFrame, keys: Sequence[str],
                cols: Sequence[str]) -> DataFrame:
    """NULL-preserving update: for matched keys each column takes the patch value when
    it is not NULL, else keeps the old one. Unmatched patches are ignored.

    ``patch`` must be unique per key."""
    p = patch.select(*[F.col(k).alias(f"__p_{k}") for k in keys],
                     *[F.col(c).alias(f"__new_{c}") for c in cols])
    joined = base.join(p, _on(keys, "__p_"), "left")
    out = [F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in cols else F.col(c) for c in base.columns]
    return joined.select(*out)


def merge_insert_patch(base: DataFrame, inserts: DataFrame, patches: DataFrame, keys: Sequence[str],
                       cols: Sequence[str], unset: str | None = None) -> DataFrame:
    """``merge_patch(merge_insert(base, inserts), patches)`` with one join against the
    base instead of two.

    The batch side is combined first (inserts ⟗ patches, both batch-sized), then
    joined once with the base: a key keeps its base row, or takes the insert when
    the base lacks it, and in both cases the patch's non-NULL fields win. Patches
    of keys in neither are ignored. ``inserts`` and ``patches`` must be unique per key. ``unset`` names a column of
    ``patches`` that lists the columns to make NULL (those that the patch gives no value)."""
    rest = [c for c in base.columns if c not in keys]

    def eq(a: str, b: str):
        return reduce(lambda x, y: x & y, [F.col(f"{a}{k}").eqNullSafe(F.col(f"{b}{k}")) for k in keys])

    # every column renamed: the three inputs often share lineage (one change set)
    i = inserts.select(*[F.col(k).alias(f"__ik_{k}") for k in keys],
                       *[F.col(c).alias(f"__i_{c}") for c in rest], F.lit(True).alias("__has_i"))
    p = patches.select(*[F.col(k).alias(f"__pk_{k}") for k in keys], *[F.col(c).alias(f"__p_{c}") for c in cols],
                       *([F.col(unset).alias("__unset")] if unset else []))
    batch = i.join(p, eq("__ik_", "__pk_"), "full").select(
        *[F.coalesce(F.col(f"__ik_{k}"), F.col(f"__pk_{k}")).alias(f"__k_{k}") for k in keys],
        *[F.col(f"__i_{c}") for c in rest], "__has_i", *[F.col(f"__p_{c}") for c in cols], *(["__unset"] if unset else []))
    b = base.select(*[F.col(c).alias(f"__b_{c}") for c in base.columns], F.lit(True).alias("__has_b"))
    j = b.join(batch, eq("__b_", "__k_"), "full")
    has_b = F.coalesce(F.col("__has_b"), F.lit(False))

    def cur(c):
        return F.when(has_b, F.col(f"__b_{c}")).otherwise(F.col(f"__k_{c}" if c in keys else f"__i_{c}"))

    def old(c):
        return F.when(~F.coalesce(F.array_contains("__unset", c), F.lit(False)), cur(c)) if unset else cur(c)

    out = [(F.coalesce(F.col(f"__p_{c}"), old(c)) if c in cols else cur(c)).alias(c) for c in base.columns]
    return j.filter(has_b | F.coalesce(F.col("__has_i"), F.lit(False))).select(*out)


def merge_upsert(base: DataFrame, src: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace rows whose key occurs in ``src`` and insert the rest (UPDATE ALL / INSERT ALL).

    ``src`` must be unique per key."""
    src = src.select(*base.columns)
    kept = base.join(_keys_as(src, keys, "__s_"), _on(keys, "__s_"), "left_anti")
    return kept.unionByName(src)


def erase_tenants(df: DataFrame, tenants: DataFrame, key: str = "organiser_Id") -> DataFrame:
    """Drop every row of the tenants listed in ``tenants`` (one column ``organiser_Id``).

    An anti join instead of collecting the ids to the driver: the tenant list can be
    any size and is planned (broadcast or shuffled) by Spark from its measured size."""
    t = tenants.select(F.col(tenants.columns[0]).alias("__tenant")).dropDuplicates()
    return df.join(t, df[key] == t["__tenant"], "left_anti")
