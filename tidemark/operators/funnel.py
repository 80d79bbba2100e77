"""Per-event funnel: opportunities, closed-won, leads, registrations, attendance.

Money is summed as DECIMAL(38,6): exact and independent of partitioning and task
order (a DOUBLE sum changes in its last digits with the plan), so reruns and
replays give identical totals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import closed_won
from tidemark.operators.latest import latest_per

MONEY = "decimal(38,6)"
KEYS = ["organiser_Id", "event_id"]
METRICS = ["Opportunity_Count", "ClosedWon_Count", "Opportunity_Amount", "ClosedWon_Amount",
           "leads_count", "regn", "atts"]
FUNNEL_COLUMNS = [*KEYS, *METRICS]


def funnel_input(contacts: DataFrame) -> DataFrame:
    """The contact columns the funnel needs, with the ClosedWon flag."""
    return (contacts.select("SF_Id", "organiser_Id", "event_id", "opportunity_Id", "initLoginAt",
                            "IsClosed", "IsWon", "touch_point", "opportunity_Amount", "recordType")
            .withColumn("ClosedWon", closed_won("IsClosed", "IsWon")))


def top_amount(fi: DataFrame) -> DataFrame:
    """One row per (tenant, event, opportunity): the largest amount; tie: SF id.

    (Exact duplicate rows need no separate distinct: top-1 keeps one of them.)"""
    return latest_per(fi, ["organiser_Id", "event_id", "opportunity_Id"], ["opportunity_Amount", "SF_Id"])


def opportunity_metrics(top: DataFrame) -> DataFrame:
    """Per (tenant, event, ClosedWon): distinct opportunities and their amount."""
    return top.groupBy(*KEYS, "ClosedWon").agg(
        F.count_distinct("opportunity_Id").alias("cnt_opportunity"),
        F.sum(F.col("opportunity_Amount").cast(MONEY)).alias("amt_opportunity"))


def opportunity_pivot(top: DataFrame) -> DataFrame:
    """ClosedWon 0/1 side by side, in one aggregation.

    ``top`` has one row per (tenant, event, opportunity), so a per-flag count of
    opportunity ids equals the distinct count; both flag columns always exist.
    Counts are 0 and amounts NULL where a flag has no opportunity."""
    amt = F.col("opportunity_Amount").cast(MONEY)
    cw = F.col("ClosedWon")
    return top.groupBy(*KEYS).agg(
        F.count(F.when(cw == 0, F.col("opportunity_Id"))).alias("cnt_opportunity_0"),
        F.sum(F.when(cw == 0, amt)).alias("amt_opportunity_0"),
        F.count(F.when(cw == 1, F.col("opportunity_Id"))).alias("cnt_opportunity_1"),
        F.sum(F.when(cw == 1, amt)).alias("amt_opportunity_1"))


def lead_metrics(fi: DataFrame) -> DataFrame:
    """Distinct LEAD ids per (tenant, event).

    The contact table holds one row per (tenant, SF id), so counting ids is the
    distinct count without a second aggregation stage."""
    return (fi.filter(F.col("recordType") == "LEAD").groupBy(*KEYS)
            .agg(F.count("SF_Id").alias("cnt_leads")))


def attendance_metrics(registrations: DataFrame) -> DataFrame:
    """Per (tenant, event): distinct users without (att_0) and with (att_1) a login.

    A user with both kinds of registration for one event counts in both columns.
    First stage groups by user (spreads a huge event over all partitions and
    reduces it map-side), the second counts per event."""
    r = registrations.select("organiser_Id", "event_id", "userId",
                             F.col("initLoginAt").isNotNull().alias("attended"))
    per_user = r.groupBy(*KEYS, "userId").agg(
        F.max(~F.col("attended")).alias("has0"), F.max("attended").alias("has1"))
    return per_user.groupBy(*KEYS).agg(
        F.count(F.when(F.col("has0"), F.col("userId"))).alias("att_0"),
        F.count(F.when(F.col("has1"), F.col("userId"))).alias("att_1"))


def _side(df: DataFrame, tag: str) -> DataFrame:
    """Rename the key columns so two frames of one lineage can be joined unambiguously."""
    return df.withColumnsRenamed({k: f"{tag}_{k}" for k in KEYS})


def _ns(a: str, b: str):
    return reduce(lambda x, y: x & y, [F.col(f"{a}_{k}").eqNullSafe(F.col(f"{b}_{k}")) for k in KEYS])


def event_keys(opp: DataFrame, leads: DataFrame) -> DataFrame:
    """Distinct (tenant, event) keys that have opportunities or leads."""
    return opp.select(*KEYS).unionByName(leads.select(*KEYS)).distinct()


def assemble_funnel(opp: DataFrame, leads: DataFrame, att: DataFrame, now: int,
                    unattributed: str = "keep") -> DataFrame:
    """Spine of events with opportunities or leads, with their metrics.

    The spine is a full outer join of the opportunity and lead metrics (each one
    row per key) instead of a distinct union plus two joins. ``unattributed``
    decides prospects attributed to no event (NULL event id): ``keep`` reports
    their real metrics under a NULL event; ``zero_row`` reproduces the legacy
    output, one all-zero row per tenant under event 0."""
    spine = _side(opp, "o").join(_side(leads, "l"), _ns("o", "l"), "full").select(
        *[F.coalesce(F.col(f"o_{k}"), F.col(f"l_{k}")).alias(f"s_{k}") for k in KEYS],
        "cnt_opportunity_0", "amt_opportunity_0", "cnt_opportunity_1", "amt_opportunity_1", "cnt_leads")
    j = spine.join(_side(att, "a"), _ns("s", "a"), "left").select(
        *[F.col(f"s_{k}").alias(k) for k in KEYS], "cnt_opportunity_0", "amt_opportunity_0",
        "cnt_opportunity_1", "amt_opportunity_1", "cnt_leads", "att_0", "att_1")
    z_int, z_money = F.lit(0).cast("bigint"), F.lit(0).cast(MONEY)

    def n(c, zero):
        v = F.coalesce(F.col(c), zero)
        if unattributed == "zero_row":
            v = F.when(F.col("event_id").isNull(), zero).otherwise(v)
        return v

    if unattributed not in ("keep", "zero_row"):
        raise ValueError(f"unknown unattributed mode {unattributed!r}")
    ev = F.coalesce("event_id", F.lit(0).cast("bigint")) if unattributed == "zero_row" else F.col("event_id")
    out = j.select(
        "organiser_Id", ev.alias("event_id"),
        (n("cnt_opportunity_0", z_int) + n("cnt_opportunity_1", z_int)).alias("Opportunity_Count"),
        n("cnt_opportunity_1", z_int).alias("ClosedWon_Count"),
        (n("amt_opportunity_0", z_money) + n("amt_opportunity_1", z_money)).cast(MONEY).alias("Opportunity_Amount"),
        n("amt_opportunity_1", z_money).cast(MONEY).alias("ClosedWon_Amount"),
        n("cnt_leads", z_int).alias("leads_count"),
        (n("att_0", z_int) + n("att_1", z_int)).alias("regn"),
        n("att_1", z_int).alias("atts"))
    return out.withColumn("load_timestamp", F.lit(now).cast("bigint"))


def event_funnel(contacts: DataFrame, registrations: DataFrame, now: int,
                 unattributed: str = "keep") -> DataFrame:
    """Contact table + attribution-side registrations -> the per-event funnel."""
    fi = funnel_input(contacts)
    return assemble_funnel(opportunity_pivot(top_amount(fi)), lead_metrics(fi),
                           attendance_metrics(registrations), now, unattributed)


FUNNEL_KEYS = ["event_id", "organiser_Id"]
