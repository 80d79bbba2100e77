"""CRM prospects: key, latest stage, top-1 per key, and the LEAD / CONTACT rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import latest_stage
from tidemark.operators.latest import latest_per

PROSPECT_KEYS = ["prospect_id", "organiser_Id"]


def with_prospect_key(df: DataFrame) -> DataFrame:
    """``prospect_id`` = lead id, else opportunity id."""
    return df.withColumn("prospect_id", F.coalesce("lead_Id", "opportunity_Id"))


def with_latest_stage(df: DataFrame) -> DataFrame:
    """Stage and stage date of the newest history entry. The history stage is the
    opportunity's stage from here on (NULL when there is no history); the payload's
    own stage field is dropped."""
    s = latest_stage("opportunityHistory")
    return (df.withColumn("Opportunity_StageName", s["StageName"])
            .withColumn("OpportunityCurrentStageDate", s["CreatedDate"])
            .drop("opportunity_PayloadStageName"))


def keep_valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("organiser_Id").isNotNull() & F.col("prospect_id").isNotNull())


def latest_prospects(df: DataFrame, legacy_key: bool = False) -> DataFrame:
    """Newest record per (tenant, prospect id); tie: opportunity id.

    ``legacy_key`` partitions by the prospect id alone (two tenants sharing an id
    then overwrite each other)."""
    keys = ["prospect_id"] if legacy_key else PROSPECT_KEYS
    return latest_per(df, keys, ["record_timeStamp", "opportunity_Id"])


def keyed_prospects(decoded: DataFrame) -> DataFrame:
    return with_latest_stage(with_prospect_key(decoded))


def prepare_prospects(decoded: DataFrame, now: int, legacy_key: bool = False) -> DataFrame:
    """Decoded payloads -> rows ready to upsert into the prospect table (``rejects`` has the others)."""
    df = keep_valid(keyed_prospects(decoded))
    return latest_prospects(df, legacy_key).withColumn("load_timestamp", F.lit(now).cast("bigint"))


LEAD_CONTACT_COLUMNS = [
    "SF_Id", "Name", "email", "organiser_Id", "opportunity_Id", "ConvertedDate", "Source",
    "IsLeadConverted", "LeadStatus", "Country", "Industry", "opportunity_LastModifiedDate",
    "lead_LastModifiedDate", "IsWon", "IsClosed", "record_created_date",
    "lead_ConvertedOpportunityId", "lead_ConvertedAccountId", "lead_ConvertedContactId",
    "account_Id", "account_Name", "Opportunity_StageName", "OpportunityCurrentStageDate",
    "opportunity_Amount", "opportunity_CloseDate", "opportunity_Currency", "base_currency",
    "LastSFModifiedDate", "recordType", "prospect_id"]


def contact_rows(p: DataFrame) -> DataFrame:
    """One CONTACT row per element of ``contacts`` (NULL or empty arrays give none);
    lead-only fields are typed NULLs."""
    c = p.select("*", F.explode("contacts").alias("_c"))
    return c.select(
        F.col("_c.Id").alias("SF_Id"), F.col("_c.Name").alias("Name"),
        F.col("_c.Email").alias("email"), "organiser_Id", "opportunity_Id",
        F.lit(None).cast("date").alias("ConvertedDate"), F.col("_c.LeadSource").alias("Source"),
        F.lit(None).cast("boolean").alias("IsLeadConverted"), F.lit(None).cast("string").alias("LeadStatus"),
        F.lit(None).cast("string").alias("Country"), F.lit(None).cast("string").alias("Industry"),
        "opportunity_LastModifiedDate", "lead_LastModifiedDate",
        F.col("opportunity_IsWon").alias("IsWon"), F.col("opportunity_IsClosed").alias("IsClosed"),
        F.col("opportunity_CreatedDate").alias("record_created_date"),
        F.lit(None).cast("string").alias("lead_ConvertedOpportunityId"),
        F.lit(None).cast("string").alias("lead_ConvertedAccountId"),
        F.lit(None).cast("string").alias("lead_ConvertedContactId"),
        "account_Id", "account_Name", "Opportunity_StageName", "OpportunityCurrentStageDate",
        "opportunity_Amount", "opportunity_CloseDate", "opportunity_Currency", "base_currency",
        F.greatest("opportunity_LastModifiedDate", "lead_LastModifiedDate").alias("LastSFModifiedDate"),
        F.lit("CONTACT").alias("recordType"), "prospect_id")


_LEAD_ONLY = [("lead_ConvertedDate", "ConvertedDate", "date"), ("lead_IsConverted", "IsLeadConverted", "boolean"),
              ("lead_Status", "LeadStatus", "string"), ("lead_Country", "Country", "string"),
              ("lead_Industry", "Industry", "string"),
              ("lead_ConvertedOpportunityId", "lead_ConvertedOpportunityId", "string"),
              ("lead_ConvertedAccountId", "lead_ConvertedAccountId", "string"),
              ("lead_ConvertedContactId", "lead_ConvertedContactId", "string")]


def _entry(sf_id, name, email, source, created, record_type: str, lead: bool):
    return F.struct(
        sf_id.alias("SF_Id"), name.alias("Name"), email.alias("email"), source.alias("Source"),
        created.alias("record_created_date"), F.lit(record_type).alias("recordType"),
        *[(F.col(src) if lead else F.lit(None).cast(t)).alias(dst) for src, dst, t in _LEAD_ONLY])


def lead_contact_union(p: DataFrame) -> DataFrame:
    """CONTACT ∪ LEAD rows; e-mail lower-cased; creation time as epoch seconds and date.

    Produced in one pass: a single
    generator emits each prospect's contacts followed by its lead row, so the
    prospect table is scanned once instead of once per branch."""
    lead = _entry(F.col("lead_Id"), F.col("lead_Name"), F.col("lead_Email"), F.col("lead_LeadSource"),
                  F.col("lead_CreatedDate"), "LEAD", True)
    contacts = F.transform("contacts", lambda c: _entry(c["Id"], c["Name"], c["Email"], c["LeadSource"],
                                                         F.col("opportunity_CreatedDate"), "CONTACT", False))
    entries = F.when(F.col("contacts").isNull(), F.array(lead)).otherwise(F.concat(contacts, F.array(lead)))
    shared = ["organiser_Id", "opportunity_Id", "opportunity_LastModifiedDate", "lead_LastModifiedDate",
              F.col("opportunity_IsWon").alias("IsWon"), F.col("opportunity_IsClosed").alias("IsClosed"),
              "account_Id", "account_Name", "Opportunity_StageName", "OpportunityCurrentStageDate",
              "opportunity_Amount", "opportunity_CloseDate", "opportunity_Currency", "base_currency",
              F.greatest("opportunity_LastModifiedDate", "lead_LastModifiedDate").alias("LastSFModifiedDate"),
              "prospect_id"]
    u = p.select(*shared, F.inline(entries)).select(*LEAD_CONTACT_COLUMNS)
    return (u.withColumn("email", F.lower("email"))
            .withColumn("record_created_timestamp", F.unix_timestamp("record_created_date"))
            .withColumn("record_created_date", F.col("record_created_date").cast("date")))
