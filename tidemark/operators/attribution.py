"""Tenant restriction, currency normalisation, attribution of prospects to event
registrations, touch points, and the contact / opportunity current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import DEFAULT_PLATFORM_SOURCE, epoch_ms_to_s, touch_point
from tidemark.operators.latest import latest_per

# Distinct currency pairs are bounded by the ISO currency list (< 200 codes), so a
# rate table reduced to one row per pair is at most 40,000 rows.
MAX_RATE_ROWS = 40_000
# Tenants of one notice batch that are joined by broadcast at a time; larger batches
# are worked off in slices of the tenant list.
MAX_TENANTS = 50_000


def for_tenants(df: DataFrame, tenants: DataFrame, key: str = "organiser_Id", broadcast: bool = False) -> DataFrame:
    """Rows of the listed tenants (semi join; the tenant frame may repeat ids).

    ``broadcast`` is for tenant frames whose count the caller has checked: the big side
    is then filtered where it is read, not exchanged on the tenant."""
    t = tenants.select(F.col(tenants.columns[0]).cast("bigint").alias("__tenant"))
    return df.join(F.broadcast(t) if broadcast else t, df[key] == t["__tenant"], "left_semi")


def registrations_for_attribution(user_registrations: DataFrame) -> DataFrame:
    """The joined registration table as the attribution side: lower-cased e-mail kept
    twice (join key and the person's platform e-mail), ids renamed."""
    r = user_registrations.drop("load_timestamp")
    return (r.withColumn("email", F.lower("email"))
            .withColumnRenamed("_id", "communities_id")
            .withColumnRenamed("source", "community_source")
            .withColumnRenamed("organiser_id", "organiser_Id")
            .withColumn("platform_email", F.col("email")))


def usable_rates(rates: DataFrame, latest_by: str | None = None, max_rate_rows: int = MAX_RATE_ROWS) -> DataFrame:
    """One rate per (currency, base currency): ``fx_base``, ``target_currency``, ``conversion_rate``.

    A table with a history needs ``latest_by``, the column that orders it. Without one, a pair
    with different rates is an error, as is a table beyond ``max_rate_rows`` pairs, which is
    what makes it safe to broadcast. Measured here, once."""
    cols = [F.col("base_currency").alias("fx_base"), "target_currency", F.col("conversion_rate").cast("double").alias("conversion_rate")]
    if latest_by is not None:
        rates = latest_per(rates, ["base_currency", "target_currency"], [latest_by, "conversion_rate"])
    r = rates.select(*cols).distinct()
    n, pairs = r.agg(F.count(F.lit(1)), F.count_distinct(F.struct("fx_base", "target_currency"))).first()
    if n > pairs:
        raise ValueError("a currency pair has several rates; name the column that orders them (rates_latest_by)")
    if n > max_rate_rows:
        raise ValueError(f"{n} currency pairs; at most {max_rate_rows} can be broadcast")
    return r


def fx_normalise(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Amount in the base currency: rate of (opportunity currency -> base currency),
    1 when the pair is unknown. Keeps ``target_currency`` and ``conversion_rate``.
    ``rates`` is a rate table or, when several plans use it, the result of ``usable_rates``."""
    r = F.broadcast(rates if "fx_base" in rates.columns else usable_rates(rates))
    j = df.join(r, (df["base_currency"] == r["target_currency"]) & (df["opportunity_Currency"] == r["fx_base"]), "left")
    return (j.drop("fx_base")
            .withColumn("conversion_rate", F.coalesce(F.col("conversion_rate"), F.lit(1.0)))
            .withColumn("opportunity_Amount", F.col("opportunity_Amount") * F.col("conversion_rate")))


REG_SIDE = ["userId", "communities_id", "event_id", "exhibitor_id", "firstName", "lastName",
            "initLoginAt", "isLoggedIn", "localCreatedAt", "community_source", "speaker_id",
            "platform_email"]
PERSON = ["organiser_Id", "email"]


def best_registration(reg: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Per (tenant, e-mail): the registration that wins the contact tie-break (newest
    ``localCreatedAt``, then highest id) and how many registrations matched; only for the
    people in ``wanted``, if given.

    The winner is a top-1 (each map task forwards one row per person) and the count a hash
    aggregate, both spread by person, so neither a tenant with very many registrations
    nor a person with very many meets in one task."""
    reg = reg.filter(F.col("email").isNotNull()).select(*PERSON, *REG_SIDE)
    if wanted is not None:
        reg = reg.join(wanted.filter(F.col("email").isNotNull()).select(*PERSON).distinct(), PERSON, "left_semi")
    top = latest_per(reg, PERSON, ["localCreatedAt", "communities_id"])
    n = reg.groupBy(*PERSON).agg(F.count(F.lit(1)).alias("matched_registrations"))
    return top.join(n, PERSON)


def _keyed(lead_contacts: DataFrame) -> DataFrame:
    """Prospect rows with ``__key``, the e-mail to match, and ``__nokey``.

    Rows without e-mail cannot match. They get a per-row surrogate key and a
    ``NULL`` flag that no registration carries, so they spread over all
    partitions instead of piling up under one NULL key, in the same single pass."""
    return (lead_contacts.withColumn("__nokey", F.col("email").isNull())
            .withColumn("__key", F.coalesce(F.col("email"),
                                            F.concat_ws("|", "prospect_id", "recordType", "SF_Id"))))


def _matched(lead_contacts: DataFrame, reg: DataFrame) -> DataFrame:
    """Keyed prospect rows ⟕ ``reg`` on (tenant, lower e-mail)."""
    reg = reg.withColumnRenamed("email", "__key").withColumn("__nokey", F.lit(False))
    joined = _keyed(lead_contacts).join(reg, ["organiser_Id", "__key", "__nokey"], "left").drop("__key", "__nokey")
    return joined.withColumn("matched_registrations",
                             F.coalesce("matched_registrations", F.lit(0)).cast("bigint"))


def attribute(lead_contacts: DataFrame, registrations: DataFrame) -> DataFrame:
    """Prospect rows ⟕ registrations on (tenant, lower e-mail): every pair.

    Each prospect row comes once per registration its e-mail matched (once, with NULLs, if none)
    plus ``matched_registrations``, their number. Neither side is held in memory: the registrations
    of one person are counted and paired in buffers that spill."""
    reg = registrations.filter(F.col("email").isNotNull()).select(*PERSON, *REG_SIDE)
    n = F.count(F.lit(1)).over(Window.partitionBy(*PERSON))
    return _matched(lead_contacts, reg.withColumn("matched_registrations", n))


def attribute_best(lead_contacts: DataFrame, registrations: DataFrame) -> DataFrame:
    """Prospect rows with the best of their registrations: the row of ``attribute`` that the
    contact tie-break would keep (see ``contact_latest``), found without making the pairs."""
    return _matched(lead_contacts, best_registration(registrations, lead_contacts))


def with_touch_points(df: DataFrame, now: int, platform: str = DEFAULT_PLATFORM_SOURCE) -> DataFrame:
    """Touch point class, login time in seconds, touch time/date, load stamp."""
    return (df.withColumn("touch_point", touch_point("email", "platform_email", "isLoggedIn", "Source", platform))
            .withColumn("initLoginAt", epoch_ms_to_s("initLoginAt"))
            .withColumn("touchpoint_timestamp", F.col("record_created_timestamp"))
            .withColumn("touchpoint_date", F.timestamp_seconds("touchpoint_timestamp").cast("date"))
            .withColumn("load_timestamp", F.lit(now).cast("bigint")))


CONTACT_KEYS = ["SF_Id", "organiser_Id"]
CONTACT_ORDER = ["touchpoint_timestamp", "opportunity_Id", "prospect_id", "localCreatedAt", "communities_id"]


def contact_latest(df: DataFrame) -> DataFrame:
    """One row per (tenant, SF id): newest touch, ties by opportunity id, prospect id,
    then the registration's creation time and id."""
    return latest_per(df.filter(F.col("SF_Id").isNotNull()), ["organiser_Id", "SF_Id"], CONTACT_ORDER)


def build_contacts(lead_contacts: DataFrame, registrations: DataFrame, rates: DataFrame, now: int,
                   platform: str = DEFAULT_PLATFORM_SOURCE) -> DataFrame:
    """LEAD/CONTACT rows -> the contact table rows (one per tenant and SF id)."""
    lc = lead_contacts.filter(F.col("SF_Id").isNotNull())   # rows without an id never survive
    att = attribute_best(fx_normalise(lc, rates), registrations)   # of the pairs, contact_latest keeps the best
    return contact_latest(with_touch_points(att, now, platform))


OPPORTUNITY_COLUMNS = [
    "organiser_Id", "opportunity_Id", "opportunity_Amount", "opportunity_Currency", "base_currency",
    "opportunity_LastActivityDate", "opportunity_AccountId", "opportunity_IsClosed",
    "opportunity_CloseDate", "opportunity_Closed_Amount", "opportunity_IsWon", "opportunity_Loss_Amount",
    "opportunity_CreatedDate", "Opportunity_StageName", "opportunity_Name", "opportunity_LeadSource",
    "opportunity_LastModifiedDate", "opportunity_type", "account_Id", "account_Name",
    "account_OwnerId", "account_OwnerName", "prospect_id"]
OPPORTUNITY_KEYS = ["opportunity_Id", "organiser_Id"]


def opportunity_latest(prospects: DataFrame, now: int) -> DataFrame:
    """One row per (tenant, opportunity): the most recently modified; tie: prospect id."""
    o = (prospects.select(*OPPORTUNITY_COLUMNS)
         .filter(F.col("opportunity_Id").isNotNull() & F.col("organiser_Id").isNotNull())
         .withColumn("load_timestamp", F.lit(now).cast("bigint")))
    return latest_per(o, ["organiser_Id", "opportunity_Id"], ["opportunity_LastModifiedDate", "prospect_id"])
