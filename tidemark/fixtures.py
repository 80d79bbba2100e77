"""Test inputs derived from the given tables (FIXTURES.md §B) and the Kafka-shaped
messages built from them with ``to_json``.

Every frame here is a Spark plan over the parquet tables, so its size grows with
the scale factor. Epoch milliseconds are ``unix_micros(ts) div 1000`` (timestamps
load as TIMESTAMP_NTZ and are read in the UTC session zone).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CDC_DB = "app"
USERS_COLLECTION = "users"
REGISTRATIONS_COLLECTION = "communities"
USERS_TOPIC = f"cdc.{CDC_DB}.{USERS_COLLECTION}"
REGISTRATIONS_TOPIC = f"cdc.{CDC_DB}.{REGISTRATIONS_COLLECTION}"
CDC_TOPIC_PATTERN = rf"cdc\.{CDC_DB}\.(?:{USERS_COLLECTION}|{REGISTRATIONS_COLLECTION})"
PROSPECT_TOPIC = "crm.prospects.ingest"
SYNC_TOPIC = "crm.organiser.sync"

# The stream files (``file_no``) and the cuts of the patch stream (UTC) between them.
CDC_FILES = (0, 1, 2)
PATCH_CUT_1 = "2024-01-11 00:00:00"
PATCH_CUT_2 = "2024-01-21 00:00:00"
# CRM payload batches: records created before this date form batch 0.
PROSPECT_CUT = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_ms(ts) -> Column:
    """Epoch milliseconds of a timestamp column (floor of the microseconds)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / 1000).cast("bigint")


def _pad(c) -> Column:
    return F.lpad(F.col(c).cast("string"), 24, "0")


def users(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    name = F.concat(F.col("c_name"), F.lit("@Mail.Example"))
    return c.select(
        _pad("c_custkey").alias("_id"),
        F.col("c_nationkey").cast("string").alias("organiser_id"),
        F.when(F.col("c_custkey") % 29 == 0, F.lit(None).cast("string"))
         .when(F.col("c_custkey") % 2 == 0, F.upper(name)).otherwise(name).alias("email"),
        F.col("c_custkey").alias("kafka_offset"))


def _orders_customers(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return o.join(c, o["o_custkey"] == c["c_custkey"])


def registrations(spark: SparkSession, d: str) -> DataFrame:
    oc = _orders_customers(spark, d)
    k = F.col("o_orderkey")
    ms = epoch_ms("o_orderdate")
    return oc.select(
        _pad("o_orderkey").alias("_id"),
        (1 + k % 40).alias("event_id"),
        F.when(k % 10 == 0, F.concat(F.lit("EX"), (k % 7).cast("string"))).alias("exhibitor_id"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
         .when(k % 23 == 0, F.repeat(F.lit("x"), 300))
         .otherwise(F.concat(F.lit("First"), F.col("o_custkey").cast("string"))).alias("firstName"),
        F.concat(F.lit("Last"), F.col("o_custkey").cast("string")).alias("lastName"),
        F.when(F.col("o_orderstatus") == "F", F.concat(ms.cast("string"), F.lit(".6"))).alias("initLoginAt"),
        F.when(F.col("o_orderstatus") == "F", F.lit("true"))
         .when(F.col("o_orderstatus") == "O", F.lit("false")).alias("isLoggedIn"),
        ms.cast("double").alias("localCreatedAt"),
        F.col("c_nationkey").cast("string").alias("organiser_id"),
        F.col("o_orderpriority").alias("source"),
        F.when(k % 50 == 0, k % 9).alias("speaker_id"),
        _pad("o_custkey").alias("userId"),
        ms.alias("ts_ms"),
        k.alias("kafka_offset"),
        F.when(k % 5 != 0, F.lit(0)).otherwise(F.lit(1)).alias("file_no"))


def patches(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    t = F.col("event_type")
    kk = F.get_json_object("props", "$.k").cast("bigint")
    ms = epoch_ms("ts")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        F.lpad((F.col("event_id") % 3000).cast("string"), 24, "0").alias("_id"),
        F.when(t == "view", 1 + kk).alias("event_id"),
        F.when(t == "purchase", F.concat(F.lit("F"), kk.cast("string"))).alias("firstName"),
        F.when(t == "signup", ms.cast("string")).alias("initLoginAt"),
        F.when(t == "signup", F.lit("true")).alias("isLoggedIn"),
        F.when(t == "click", F.lit("click")).alias("source"),
        (F.col("event_id") % 20 == 0).alias("is_delete"),
        ms.alias("ts_ms"),
        F.col("event_id").alias("kafka_offset"),
        F.when(ts < F.lit(PATCH_CUT_1).cast("timestamp"), F.lit(0))
         .when(ts < F.lit(PATCH_CUT_2).cast("timestamp"), F.lit(1)).otherwise(F.lit(2)).alias("file_no"))


def prospect_details(k: Column) -> dict[str, Column]:
    """The payload fields that no step computes with, each with values of its own."""
    def tag(prefix: str, c: Column) -> Column:
        return F.concat(F.lit(prefix), c.cast("string"))

    day = F.col("o_orderdate").cast("timestamp").cast("date")
    won, closed = F.col("o_orderstatus") == "F", F.col("o_orderstatus").isin("F", "P")
    return {
        "last_activity": tag("A", k), "account_id": tag("AC", k % 97), "close_date": F.date_add(day, (k % 30).cast("int")),
        "closed_amount": F.when(won, F.col("o_totalprice") / 2), "loss_amount": F.when(closed & ~won, F.col("o_totalprice") / 4),
        "contact_ref": tag("OC", k % 89), "stage": tag("ST", k % 6), "opp_name": tag("Opp ", k), "opp_type": tag("T", k % 3),
        "lead_conv_opp": tag("OP", k), "lead_conv_account": tag("AC", k % 97), "lead_conv_contact": tag("CT", F.col("o_custkey")),
        "lead_conv_date": F.date_add(day, 1), "lead_converted": k % 2 == 0, "lead_status": tag("S", k % 4), "lead_name": tag("Lead ", k),
        "lead_industry": tag("I", k % 5), "lead_country": tag("N", F.col("c_nationkey")),
        "account_name": tag("Account ", k % 97), "owner_id": tag("OW", k % 11), "owner_name": tag("Owner ", k % 11)}


def _lead_source(k: Column) -> Column:
    return F.when(k % 4 == 0, F.lit("Platform")).otherwise(F.lit("Web"))


def prospects(spark: SparkSession, d: str) -> DataFrame:
    return _as_prospects(_orders_customers(spark, d))


def _as_prospects(oc: DataFrame, *more: str) -> DataFrame:
    """Prospects of orders with their customer; ``more`` names columns that are kept as they are."""
    k = F.col("o_orderkey")
    lead = k % 3 == 0
    return oc.select(
        F.col("c_nationkey").cast("bigint").alias("organiser_id"), k.alias("o_orderkey"),
        F.concat(F.lit("OP"), (k - k % 2).cast("string")).alias("opportunity_id"),
        F.when(lead, F.concat(F.lit("L"), F.col("o_custkey").cast("string"))).alias("lead_id"),
        F.when(lead, F.concat(F.lower("c_name"), F.lit("@mail.example"))).alias("lead_email"),
        _lead_source(k).alias("lead_source"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").isin("F", "P").alias("is_closed"),
        (F.col("o_orderstatus") == "F").alias("is_won"),
        F.concat(F.lit("C"), (F.col("c_nationkey") % 5).cast("string")).alias("currency"),
        F.lit("C0").alias("base_currency"),
        F.when(k % 13 == 0, F.lit("n/a")).otherwise(
            F.concat(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
                     F.lit(".000+0000"))).alias("created_text"),
        F.col("o_custkey"), "c_nationkey",
        *[c.alias(n) for n, c in prospect_details(k).items()],
        (epoch_ms("o_orderdate") + k).alias("record_ts"),
        F.when(F.col("o_orderdate").cast("timestamp") < F.lit(PROSPECT_CUT).cast("timestamp"), F.lit(0))
         .otherwise(F.lit(1)).alias("batch_no"), *more)


def history(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("o_orderkey"),
                     F.col("l_shipdate").cast("timestamp").cast("date").alias("created_date"),
                     F.concat("l_returnflag", "l_linestatus").alias("stage_name"))


def _customers_with_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Customers with ``who``, the customers (key, name) who are contacts of an order of theirs: the customer itself and the
    next customer id (mod the customer count). Made per customer, of whom there are fewer than orders."""
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = c.select(F.count(F.lit(1))).scalar()
    who = c.select("c_custkey", F.struct("c_custkey", "c_name").alias("who"))
    keys = c.select(F.col("c_custkey").alias("custkey")).distinct().withColumn("next", (F.col("custkey") + 1) % n)
    same = who.withColumnRenamed("c_custkey", "custkey")
    nxt = keys.join(who, keys["next"] == who["c_custkey"]).select("custkey", "who")
    lists = same.unionByName(nxt).groupBy("custkey").agg(F.collect_list("who").alias("who"))
    return c.join(lists, c["c_custkey"] == lists["custkey"], "left").drop("custkey")


def orders_with_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Orders with their customer and ``cts``, the contacts of all rows of the order; none when ``o_orderkey % 11 = 0``."""
    o, c = table(spark, d, "orders"), _customers_with_contacts(spark, d)
    k = F.col("o_orderkey")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"])
    all_of = F.flatten(F.collect_list(F.when(k % 11 != 0, F.col("who"))).over(Window.partitionBy("o_orderkey")))
    cts = F.transform(all_of, lambda w: F.struct(
        F.concat(F.lit("CT"), w["c_custkey"].cast("string")).alias("Id"), F.concat(w["c_name"], F.lit("@MAIL.example")).alias("Email"),
        w["c_name"].alias("Name"), _lead_source(k).alias("LeadSource")))
    return oc.withColumn("cts", F.when(k % 11 != 0, cts)).drop("who")


def rates(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    i = n.filter(F.col("n_regionkey") < 4).select(F.col("n_regionkey").alias("i")).distinct()
    return i.select(F.concat(F.lit("C"), F.col("i").cast("string")).alias("base_currency"),
                    F.lit("C0").alias("target_currency"),
                    (F.lit(1.0) + F.col("i") * F.lit(0.25)).cast("double").alias("conversion_rate"))


def notices(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    m = F.col("n_nationkey") % 5
    action = (F.when(m == 0, F.lit("ORGANISER_ROI_DISABLED"))
              .when(m == 4, F.lit("ORGANISER_SF_DATA_PROCESSING_COMPLETED"))
              .when(m == 3, F.lit("UNRELATED"))
              .otherwise(F.lit("ORGANISER_SF_DATA_FETCHING_COMPLETED")))
    return n.select(F.col("n_nationkey").cast("string").alias("oId"), action.alias("action"),
                    F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))


# Kafka-shaped messages -----------------------------------------------------------------

def _record(key, value, topic: str, partition: int, offset, ts_ms) -> list[Column]:
    return [F.col(key).cast("binary").alias("key") if isinstance(key, str) else key.cast("binary").alias("key"),
            value.cast("binary").alias("value"), F.lit(topic).alias("topic"),
            F.lit(partition).cast("int").alias("partition"), offset.cast("bigint").alias("offset"),
            F.timestamp_millis(ts_ms).alias("timestamp"), F.lit(0).alias("timestampType")]


def _source(collection: str, ts_ms) -> Column:
    return F.to_json(F.struct(F.lit(CDC_DB).alias("db"), F.lit(collection).alias("collection"),
                              ts_ms.alias("ts_ms")))


def _oid(c) -> Column:
    return F.struct(F.col(c).alias("$oid"))


def cdc_messages(spark: SparkSession, d: str) -> DataFrame:
    """User inserts, registration inserts and registration patches as change records,
    with ``file_no`` (0..2), the stream cut each belongs to."""
    u = users(spark, d)
    after_u = F.to_json(F.struct(_oid("_id").alias("_id"), "email", "organiser_id"))
    env_u = F.to_json(F.struct(F.struct(after_u.alias("after"),
                                        _source(USERS_COLLECTION, F.lit(0).cast("bigint")).alias("source")).alias("payload")))
    mu = u.select(*_record("_id", env_u, USERS_TOPIC, 0, F.col("kafka_offset"), F.lit(0).cast("bigint")),
                  F.lit(0).alias("file_no"))

    r = registrations(spark, d)
    after_r = F.to_json(F.struct(
        _oid("_id").alias("_id"), "event_id", "exhibitor_id", "firstName", "lastName",
        F.struct("initLoginAt", "isLoggedIn").alias("immutable"), "localCreatedAt", "organiser_id",
        "source", "speaker_id", _oid("userId").alias("userId")))
    env_r = F.to_json(F.struct(F.struct(after_r.alias("after"),
                                        _source(REGISTRATIONS_COLLECTION, F.col("ts_ms")).alias("source")).alias("payload")))
    mr = r.select(*_record("_id", env_r, REGISTRATIONS_TOPIC, 0, F.col("kafka_offset"), F.col("ts_ms")), "file_no")

    p = patches(spark, d)
    set_doc = F.to_json(F.struct("event_id", "firstName", F.struct("initLoginAt", "isLoggedIn").alias("immutable"),
                                 "source"))
    patch = F.when(~F.col("is_delete"), F.to_json(F.struct(F.lit("2").alias("$v"), set_doc.alias("$set"))))
    flt = F.to_json(F.struct(F.to_json(_oid("_id")).alias("_id")))
    env_p = F.to_json(F.struct(F.struct(patch.alias("patch"), flt.alias("filter"),
                                        _source(REGISTRATIONS_COLLECTION, F.col("ts_ms")).alias("source")).alias("payload")))
    mp = p.select(*_record("_id", env_p, REGISTRATIONS_TOPIC, 1, F.col("kafka_offset"), F.col("ts_ms")), "file_no")
    return mu.unionByName(mr).unionByName(mp)


def dotted_messages(spark: SparkSession, d: str) -> DataFrame:
    """The same inserts, with patches in dotted form: logins as ``immutable.*`` keys; clicks unset the source and purchases
    the first name; deletes as before."""
    p = patches(spark, d)
    logins = F.to_json(F.struct(F.col("initLoginAt").alias("immutable.initLoginAt"), F.col("isLoggedIn").alias("immutable.isLoggedIn"), "event_id"))
    unset = F.when(F.col("source").isNotNull(), F.lit('{"source":true}')).when(F.col("firstName").isNotNull(), F.lit('{"firstName":""}'))
    patch = F.when(~F.col("is_delete"), F.to_json(F.struct(F.lit("2").alias("$v"), F.when(unset.isNull(), logins).alias("$set"), unset.alias("$unset"))))
    flt = F.to_json(F.struct(F.to_json(_oid("_id")).alias("_id")))
    env = F.to_json(F.struct(F.struct(patch.alias("patch"), flt.alias("filter"), _source(REGISTRATIONS_COLLECTION, F.col("ts_ms")).alias("source")).alias("payload")))
    inserts = cdc_messages(spark, d).filter("partition = 0").drop("file_no")
    return inserts.unionByName(p.select(*_record("_id", env, REGISTRATIONS_TOPIC, 1, F.col("kafka_offset"), F.col("ts_ms"))))


def crm_messages(spark: SparkSession, d: str) -> DataFrame:
    """CRM prospect payloads (one per order) with ``batch_no`` (0: created before
    ``PROSPECT_CUT``)."""
    h = (history(spark, d).groupBy("o_orderkey")
         .agg(F.collect_list(F.struct(F.col("stage_name").alias("StageName"),
                                      F.col("created_date").alias("CreatedDate"))).alias("hist")))
    # the order is joined, and only then made a payload of many fields
    oc = orders_with_contacts(spark, d).join(h, "o_orderkey", "left")
    j = _as_prospects(oc, "hist", "cts")
    opp = F.struct(F.col("opportunity_id").alias("Id"), F.col("amount").alias("Amount"),
                   F.col("is_closed").alias("IsClosed"), F.col("is_won").alias("IsWon"),
                   F.col("created_text").alias("CreatedDate"), F.col("lead_source").alias("LeadSource"),
                   F.col("created_text").alias("LastModifiedDate"), F.col("base_currency").alias("BaseCurrency"),
                   F.col("currency").alias("CurrencyIsoCode"), F.col("last_activity").alias("LastActivityDate"),
                   F.col("account_id").alias("AccountId"), F.col("close_date").alias("CloseDate"),
                   F.col("closed_amount").alias("Closed_Amount__c"), F.col("contact_ref").alias("ContactId"),
                   F.col("loss_amount").alias("Loss_Amount__c"), F.col("stage").alias("StageName"),
                   F.col("opp_name").alias("Name"), F.col("opp_type").alias("Type"))
    lead = F.when(F.col("lead_id").isNotNull(), F.struct(
        F.col("lead_id").alias("Id"), F.col("lead_email").alias("Email"), F.col("lead_source").alias("LeadSource"),
        F.col("created_text").alias("CreatedDate"), F.col("created_text").alias("LastModifiedDate"),
        F.col("lead_conv_opp").alias("ConvertedOpportunityId"), F.col("lead_conv_account").alias("ConvertedAccountId"),
        F.col("lead_conv_contact").alias("ConvertedContactId"), F.col("lead_conv_date").alias("ConvertedDate"),
        F.col("lead_converted").alias("IsConverted"), F.col("lead_status").alias("Status"), F.col("lead_name").alias("Name"),
        F.col("lead_industry").alias("Industry"), F.col("lead_country").alias("Country")))
    account = F.struct(F.col("account_name").alias("Name"), F.col("account_id").alias("Id"),
                       F.struct(F.col("owner_name").alias("Name"), F.col("owner_id").alias("Id")).alias("owner"))
    data = F.struct(F.col("organiser_id").alias("organiserId"), opp.alias("opportunityDetails"),
                    F.col("hist").alias("opportunityHistory"), lead.alias("leadDetails"),
                    F.col("cts").alias("contacts"), account.alias("accountDetails"))
    value = F.to_json(F.struct(data.alias("data"), F.col("record_ts").alias("timeStamp"),
                               F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("xnId")))
    return j.select(*_record(F.col("opportunity_id"), value, PROSPECT_TOPIC, 0, F.col("o_orderkey"),
                             F.col("record_ts")), "batch_no")


def sync_messages(spark: SparkSession, d: str) -> DataFrame:
    """Sync notices; copy 1 forms batch 0 and copy 2 batch 1 (a full replay)."""
    n = notices(spark, d)
    value = F.to_json(F.struct(F.struct("oId", "action", F.lit("crm").alias("actor"),
                                        F.lit("crm").alias("client")).alias("context")))
    off = F.col("oId").cast("bigint") * 2 + F.col("copy")
    return n.select(*_record(F.col("oId"), value, SYNC_TOPIC, 0, off, F.lit(0).cast("bigint")),
                    (F.col("copy") - 1).alias("batch_no"))


# Damaged messages and time texts --------------------------------------------------------

def damaged(messages: DataFrame) -> DataFrame:
    """``messages`` of which some, by offset, cannot be read: cut in half, without value, not an object, a tenant that is
    no number, broken inner documents, a field of another type."""
    text, k = F.col("value").cast("string"), F.col("offset") % 97
    changed = (F.when(k == 5, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int"))).when(k == 6, F.lit(None))
               .when(k == 7, F.lit('"text"'))
               .when(k == 8, F.regexp_replace(F.regexp_replace(F.regexp_replace(
                   text, r'organiser_id\\":(\\")?[0-9]+(\\")?', r'organiser_id\\":\\"acme\\"'), '"oId":"[0-9]+"', '"oId":"acme"'),
                   '"organiserId":[0-9]+', '"organiserId":null'))
               .when(k == 9, F.regexp_replace(F.replace(text, F.lit('"after":"{'), F.lit('"after":"{{')), '"organiserId":[0-9]+', '"organiserId":"x"'))
               .when(k == 10, F.regexp_replace(F.replace(text, F.lit('"patch":"{'), F.lit('"patch":"{{')), '"Amount":[0-9.E]+', '"Amount":"much"'))
               .when(k == 11, F.replace(text, F.lit('"filter":"{'), F.lit('"filter":"{{'))).otherwise(text))
    return messages.withColumn("value", changed.cast("binary"))


#: How times are written by form number (order key modulo their number); the last is no time.
TIME_TEXTS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'", "EEE, dd MMM yyyy HH:mm:ss '+0000'", "MMM d, yyyy h:mm a", "MMMM d, yyyy", "seconds", "milliseconds",
              "M/d/yyyy H:mm", "yyyy/MM/dd HH:mm:ss", "dd.MM.yyyy HH:mm", "yyyyMMdd'T'HHmmss'Z'", "yyyy-MM-dd h:mm a", "EEEE, d MMM yyyy HH:mm:ss 'GMT'", "none")


def time_texts(spark: SparkSession, d: str) -> DataFrame:
    """Each order's date, some seconds into the day, as text in one of the forms."""
    k = F.col("o_orderkey")
    at = F.timestamp_seconds(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) + k % 86_400)
    texts = {"seconds": F.unix_timestamp(at).cast("string"), "milliseconds": F.unix_millis(at).cast("string"), "none": F.lit("n/a")}
    form = k % len(TIME_TEXTS)
    text = F.coalesce(*[F.when(form == i, texts[f] if f in texts else F.date_format(at, f)) for i, f in enumerate(TIME_TEXTS)])
    return table(spark, d, "orders").select("o_orderkey", form.alias("form"), text.alias("text"))
