"""CRM side: ingest prospect payloads; recompute contacts, opportunities and the
funnel for a set of tenants; erase tenants."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.functions.scalars import DEFAULT_PLATFORM_SOURCE
from tidemark.operators.attribution import (
    build_contacts, for_tenants, opportunity_latest, registrations_for_attribution,
)
from tidemark.operators.decode import decode_prospects
from tidemark.operators.funnel import event_funnel
from tidemark.operators.merge import erase_tenants, merge_upsert
from tidemark.operators.prospects import PROSPECT_KEYS, lead_contact_union, prepare_prospects


@dataclass
class CrmConf:
    platform_source: str = DEFAULT_PLATFORM_SOURCE
    unattributed: str = "keep"          # or "zero_row" (legacy funnel output)
    legacy_prospect_key: bool = False
    time_patterns: tuple = ()
    rates_latest_by: str | None = None  # orders a rate table that holds a history
    contact_table: str = "contact"      # warehouse tables (may be schema-qualified)
    opportunity_table: str = "opportunity"
    funnel_table: str = "roi_event_wise_agg"


def ingest_prospects(rec: DataFrame, prospects: DataFrame | None, now: int,
                     conf: CrmConf = CrmConf()) -> DataFrame:
    """Kafka-shaped payload batch -> new prospect table (upsert on tenant + prospect id)."""
    new = prepare_prospects(decode_prospects(rec, conf.time_patterns), now, conf.legacy_prospect_key)
    if prospects is None:
        return new
    return merge_upsert(prospects, new, PROSPECT_KEYS)


@dataclass
class Recomputed:
    contacts: DataFrame
    opportunities: DataFrame
    funnel: DataFrame


def recompute(prospects: DataFrame, user_registrations: DataFrame, rates: DataFrame, now: int,
              tenants: DataFrame | None = None, conf: CrmConf = CrmConf(), broadcast: bool = False) -> Recomputed:
    """Contacts, opportunities and per-event funnel of ``tenants`` (all when None),
    from the stored prospect and registration tables. ``broadcast``: see ``for_tenants``."""
    p, ur = prospects, user_registrations
    if tenants is not None:
        p = for_tenants(p, tenants, "organiser_Id", broadcast)
        ur = for_tenants(ur, tenants, "organiser_id", broadcast)
    reg = registrations_for_attribution(ur)
    contacts = build_contacts(lead_contact_union(p), reg, rates, now, conf.platform_source)
    return Recomputed(contacts, opportunity_latest(p, now),
                      event_funnel(contacts, reg, now, conf.unattributed))


ERASE_KEYS = {"prospects": "organiser_Id", "user_registrations": "organiser_id", "contacts": "organiser_Id",
              "opportunities": "organiser_Id", "event_agg": "organiser_Id"}


def erase(tables: dict[str, DataFrame], tenants: DataFrame, keys: dict[str, str] = ERASE_KEYS) -> dict[str, DataFrame]:
    """Remove the tenants from each listed table (users and raw registrations are
    kept unless the caller lists them)."""
    return {name: erase_tenants(df, tenants, keys[name]) for name, df in tables.items()}
