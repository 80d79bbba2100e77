"""JSON messages -> typed columns (change envelopes, CRM prospects, sync notices).

Each decoder has a ``..._fates`` form that returns every message with its ``fate``: ``kept``, ``ruled out`` (by the
rule that ``reason`` names) or ``rejected`` (it could not be read, ``reason`` says why and ``value`` holds the
text). A kept message of which a part could not be read has a reason too. ``dead_letters`` collects what
was not read, and the plain decoders return the kept rows alone."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.scalars import any_not_null, parse_time

KEPT, RULED_OUT, REJECTED = "kept", "ruled out", "rejected"
CORRUPT = "_corrupt_record"
NO_VALUE, PARTLY_READ, BAD_TENANT = "no value", "a field of another type", "tenant id is not a number"
EMPTY_CHANGE = "empty change"
DEAD_LETTER_COLUMNS = ["topic", "partition", "offset", "decoder", "reason", "kept", "organiser_Id", "value"]


def parse_once(df: DataFrame, keep: list, docs: dict) -> DataFrame:
    """Select ``keep`` plus one struct column per ``docs`` entry (alias -> (json
    column, schema)), each JSON document parsed exactly once per row. The struct also has
    ``_corrupt_record``: the text where it, or a field of it, could not be read.

    A plain projection of ``from_json`` lets the optimizer push later filters
    below it and substitute every field reference with its own (pruned)
    ``from_json`` call, so a filter on ten fields parses the text ten more times.
    Producing the parsed structs from a generator (``inline`` of a one-element
    array) keeps predicates on them above the parse."""
    def flagged(schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])

    parsed = F.struct(*[F.from_json(c, flagged(schema)).alias(alias) for alias, (c, schema) in docs.items()])
    return df.select(*keep, F.inline(F.array(parsed)))


def _unread(text: str | Column, doc: str, must: Column) -> Column:
    """A text that is there but has nothing of what is needed."""
    text = F.col(text) if isinstance(text, str) else text
    return text.isNotNull() & (F.col(doc).isNull() | (F.col(doc)[CORRUPT].isNotNull() & must.isNull()))


def _judge(df: DataFrame, keep: list, decoder: str, rejects: list[tuple], rules: list[tuple] = (), notes: list[tuple] = (),
           value: str = "value") -> DataFrame:
    """``keep`` of ``df`` plus decoder, fate and reason; ``value`` where there is something to report."""
    def first(pairs) -> Column:
        return reduce(lambda acc, p: acc.when(p[0], F.lit(p[1])), pairs, F.when(F.lit(False), F.lit(None).cast("string")))

    bad, ruled, noted = first(rejects), first(rules), first(notes)
    fate = F.when(bad.isNotNull(), REJECTED).when(ruled.isNotNull(), RULED_OUT).otherwise(KEPT)
    return df.select(*keep, F.lit(decoder).alias("decoder"), fate.alias("fate"), F.coalesce(bad, ruled, noted).alias("reason"),
                     F.when(bad.isNotNull() | (ruled.isNull() & noted.isNotNull()), F.col(value)).alias("value"))


def kept(fates: DataFrame) -> DataFrame:
    return fates.filter(F.col("fate") == KEPT)


def dead_letters(*fates: DataFrame) -> DataFrame:
    """What could not be read, wholly (``kept`` false) or in part (the rest is in the tables)."""
    def shape(df: DataFrame) -> DataFrame:
        tenant = next((c for c in df.columns if c.lower() == "organiser_id"), None)
        found = df.filter((F.col("fate") == REJECTED) | ((F.col("fate") == KEPT) & F.col("reason").isNotNull()))
        return found.select("topic", "partition", "offset", "decoder", "reason", (F.col("fate") == KEPT).alias("kept"),
                            (F.col(tenant) if tenant else F.lit(None)).cast("bigint").alias("organiser_Id"), "value")
    return reduce(DataFrame.unionByName, map(shape, fates))


def envelope_fates(rec: DataFrame) -> DataFrame:
    """Two-step decode of a change record: the payload's inner documents are JSON text.

    Columns: topic, partition, offset, db, collection, ts_ms, _id (filter id as JSON
    text), after (document JSON), v, set_doc and unset_doc (the patch's ``$v``, ``$set`` and ``$unset``)."""
    at = ["topic", "partition", "offset", "value"]
    d = parse_once(rec, at, {"m": ("value", S.ENVELOPE)})
    d = parse_once(d, [*at, F.col("m.payload").isNotNull().alias("read"), F.col("m.payload.after").alias("after"),
                       F.col("m.payload.filter").alias("filter_text"), F.col("m.payload.patch").alias("patch_text")],
                   {"src": (F.col("m.payload.source"), S.SOURCE), "flt": (F.col("m.payload.filter"), S.FILTER),
                    "pat": (F.col("m.payload.patch"), S.PATCH)})
    df = d.select(
        *at, F.col("src.db").alias("db"), F.col("src.collection").alias("collection"), F.col("src.ts_ms").alias("ts_ms"),
        F.col("flt._id").alias("_id"), "after", F.col("pat")["$v"].alias("v"), F.col("pat")["$set"].alias("set_doc"),
        F.col("pat")["$unset"].alias("unset_doc"), "read", _unread("filter_text", "flt", F.col("flt._id")).alias("bad_filter"),
        _unread("patch_text", "pat", F.coalesce(F.col("pat")["$set"], F.col("pat")["$unset"])).alias("bad_patch"))
    blank = F.col("value").isNull() | (F.trim("value") == "")
    return _judge(df, ENVELOPE_COLUMNS, "envelope", [(blank, NO_VALUE), (~F.col("read"), "unreadable envelope"),
                                   (F.col("collection").isNull(), "unreadable source"),
                                   (F.col("bad_filter"), "unreadable filter"),
                                   (F.col("bad_patch"), "unreadable patch")])


ENVELOPE_COLUMNS = ["topic", "partition", "offset", "db", "collection", "ts_ms", "_id", "after", "v", "set_doc", "unset_doc"]


def decode_envelope(rec: DataFrame) -> DataFrame:
    """Every record; what could not be read has NULL fields (``envelope_fates`` tells why)."""
    return envelope_fates(rec).select(*ENVELOPE_COLUMNS)


def route(env: DataFrame, collection: str) -> DataFrame:
    return env.filter(F.col("collection") == F.lit(collection))


_PLACE = ["topic", "ts_ms", "partition", "offset"]
def user_fates(env: DataFrame) -> DataFrame:
    """User documents: e-mail and tenant are mandatory; changes without a document are ignored.

    The tenant id is normalised to bigint here, once."""
    d = parse_once(env, [*_PLACE, "after"], {"d": ("after", S.USER_DOC)})
    tenant = F.col("d.organiser_id")
    df = d.select(*_PLACE, "after", F.col("d._id")["$oid"].alias("_id"), tenant.try_cast("bigint").alias("organiser_id"),
                  F.col("d.email").alias("email"), tenant.isNull().alias("no_tenant"),
                  _unread("after", "d", F.col("d._id")["$oid"]).alias("unread"), F.col("d")[CORRUPT].isNotNull().alias("partly"))
    return _judge(df, [*_PLACE, "_id", "organiser_id", "email"], "users", [(F.col("unread"), "unreadable document"),
                                (~F.col("no_tenant") & F.col("organiser_id").isNull(), BAD_TENANT)],
                  [(F.col("after").isNull(), "no document"), (F.col("no_tenant"), "no tenant"), (F.col("email").isNull(), "no e-mail")],
                  [(F.col("partly"), PARTLY_READ)], "after")


def users_of(fates: DataFrame) -> DataFrame:
    return kept(fates).select("_id", "organiser_id", "email", "ts_ms", "partition", "offset")


def decode_users(env: DataFrame) -> DataFrame:
    return users_of(user_fates(env))


_CHANGE = ["_id", *S.REGISTRATION_FIELDS, "ts_ms", "partition", "offset", "OPS"]


def _registration_cols(d: str):
    return [F.col(f"{d}.event_id").alias("event_id"), F.col(f"{d}.exhibitor_id").alias("exhibitor_id"),
            F.col(f"{d}.firstName").alias("firstName"), F.col(f"{d}.lastName").alias("lastName"),
            F.col(f"{d}.immutable.initLoginAt").alias("initLoginAt"),
            F.col(f"{d}.immutable.isLoggedIn").alias("isLoggedIn"),
            F.col(f"{d}.localCreatedAt").alias("localCreatedAt"),
            F.col(f"{d}.organiser_id").try_cast("bigint").alias("organiser_id"),
            F.col(f"{d}.source").alias("source"), F.col(f"{d}.speaker_id").alias("speaker_id"),
            F.col(f"{d}.userId")["$oid"].alias("userId")]


def registration_insert_fates(env: DataFrame, max_name_len: int = 264, allow_null_names: bool = False) -> DataFrame:
    """Registration documents from ``after``. Rows need a tenant and names of at most ``max_name_len``
    characters; a NULL name fails the length test and rules the row out unless ``allow_null_names``."""
    d = parse_once(env.filter(F.col("after").isNotNull()), [*_PLACE, "after"], {"d": ("after", S.REGISTRATION_DOC)})
    df = d.select(F.col("d._id")["$oid"].alias("_id"), *_registration_cols("d"), *_PLACE, "after", F.lit("INSERT").alias("OPS"),
                  F.col("d.organiser_id").isNull().alias("no_tenant"),
                  _unread("after", "d", F.col("d._id")["$oid"]).alias("unread"), F.col("d")[CORRUPT].isNotNull().alias("partly"))

    def ok(c):
        return F.coalesce(F.length(c) <= max_name_len, F.lit(allow_null_names))

    return _judge(df, ["topic", *_CHANGE], "registrations", [(F.col("unread"), "unreadable document"),
                                        (~F.col("no_tenant") & F.col("organiser_id").isNull(), BAD_TENANT)],
                  [(F.col("no_tenant"), "no tenant"), (~(ok("firstName") & ok("lastName")), "name missing or too long")],
                  [(F.col("partly"), PARTLY_READ)], "after")


def changes_of(fates: DataFrame) -> DataFrame:
    """Registration changes that were not ruled out or rejected, but for patches without a known field
    (``drop_empty`` rules those out)."""
    return fates.filter((F.col("fate") == KEPT) | ((F.col("fate") == RULED_OUT) & (F.col("reason") == EMPTY_CHANGE))).select(*_CHANGE)


def decode_registration_inserts(env: DataFrame, max_name_len: int = 264, allow_null_names: bool = False) -> DataFrame:
    """Kept registration documents, tagged ``OPS='INSERT'``."""
    return changes_of(registration_insert_fates(env, max_name_len, allow_null_names))


#: Where a registration field stands in a patch, in dotted form; unsetting a parent unsets what is in it.
FIELD_PATHS = {**{f: f for f in S.REGISTRATION_FIELDS}, "initLoginAt": "immutable.initLoginAt", "isLoggedIn": "immutable.isLoggedIn", "userId": "userId.$oid"}


def _dotted(doc: Column, path: str) -> Column:
    """The value, as text, under a key that is a path, such as ``immutable.isLoggedIn``."""
    return F.try_variant_get(F.try_parse_json(doc), f"$['{path}']", "string")


def _unset(doc: Column) -> Column:
    """Names of the registration fields that an ``$unset`` document names, by dotted path or by a parent."""
    v = F.try_parse_json(doc)

    def named(key: str) -> Column:
        return F.try_variant_get(v, f"$['{key}']", "variant").isNotNull()

    found = [F.when(reduce(lambda a, b: a | b, [named(k) for k in {path, path.split(".")[0]}]), F.lit(f)) for f, path in FIELD_PATHS.items()]
    return F.array_compact(F.array(*found))


def registration_patch_fates(env: DataFrame, dotted: bool = False) -> DataFrame:
    """Patches (no ``after``): id from the filter document, fields from ``$set``.
    Deletes and patches without a known field change nothing.

    ``dotted`` also reads keys that are paths (``"immutable.isLoggedIn": ...``) and adds ``unset``, the fields that
    ``$unset`` names, which then become NULL."""
    more = []
    if dotted:
        more = [F.struct(*[_dotted(F.col("set_doc"), path).alias(f) for f, path in FIELD_PATHS.items() if "." in path]).alias("paths"),
                _unset(F.col("unset_doc")).alias("unset")]
    d = parse_once(env.filter(F.col("after").isNull()), [*_PLACE, F.col("_id").alias("id_text"), "set_doc", *more],
                   {"f": ("_id", S.OID), "d": ("set_doc", S.REGISTRATION_DOC)})
    fields = dict(zip(S.REGISTRATION_FIELDS, _registration_cols("d")))
    if dotted:
        fields |= {f: F.coalesce(fields[f], F.col("paths")[f]).alias(f) for f, path in FIELD_PATHS.items() if "." in path}
    df = d.select(F.col("f")["$oid"].alias("_id"), *fields.values(), *(["unset"] if dotted else []), *_PLACE, "set_doc", F.lit("UPDATE").alias("OPS"),
                  _unread("id_text", "f", F.col("f")["$oid"]).alias("bad_id"),
                  F.col("d")[CORRUPT].isNotNull().alias("partly"),
                  (F.col("d.organiser_id").isNotNull() & F.col("d.organiser_id").try_cast("bigint").isNull()).alias("bad_tenant"))
    some = any_not_null(S.REGISTRATION_FIELDS)
    if dotted:
        some = some | (F.size("unset") > 0)
    return _judge(df, ["topic", *_CHANGE, *(["unset"] if dotted else [])], "patches", [(F.col("bad_id"), "unreadable id"), (F.col("partly") & ~some, "unreadable fields")],
                  [(~some & ~F.col("bad_tenant"), EMPTY_CHANGE)],
                  [(F.col("bad_tenant"), BAD_TENANT), (F.col("partly"), PARTLY_READ)], "set_doc")


def decode_registration_patches(env: DataFrame) -> DataFrame:
    """Patches tagged ``OPS='UPDATE'``, empty ones included (``drop_empty`` rules them out)."""
    return changes_of(registration_patch_fates(env))


# CRM payload --------------------------------------------------------------------------

def prospect_fates(rec: DataFrame, time_patterns: Sequence[str] = ()) -> DataFrame:
    """Flatten a CRM prospect payload to one row of named columns (the payload's
    nested history and contacts stay arrays). ``unread_times`` counts the four time texts that gave NULL."""
    at = [c for c in ("topic", "partition", "offset") if c in rec.columns]
    d = parse_once(rec, [*at, F.col("value").alias("message")], {"m": ("value", S.PROSPECT_MSG)})
    o, ld, a = "m.data.opportunityDetails", "m.data.leadDetails", "m.data.accountDetails"

    def t(c):
        return parse_time(F.col(c), time_patterns)

    df = d.select(
        *at, "message", F.col("m.data").isNotNull().alias("read"), F.col("m")[CORRUPT].isNotNull().alias("partly"),
        F.array(*(F.col(f"{x}.{c}") for x in (o, ld) for c in ("CreatedDate", "LastModifiedDate"))).alias("time_texts"),
        F.col("m.data.organiserId").cast("bigint").alias("organiser_Id"),
        F.col(f"{o}.Id").alias("opportunity_Id"),
        F.col(f"{o}.Amount").alias("opportunity_Amount"),
        F.col(f"{o}.CurrencyIsoCode").alias("opportunity_Currency"),
        F.col(f"{o}.LastActivityDate").alias("opportunity_LastActivityDate"),
        F.col(f"{o}.AccountId").alias("opportunity_AccountId"),
        F.col(f"{o}.IsClosed").alias("opportunity_IsClosed"),
        F.col(f"{o}.CloseDate").alias("opportunity_CloseDate"),
        F.col(f"{o}.Closed_Amount__c").alias("opportunity_Closed_Amount"),
        F.col(f"{o}.ContactId").alias("opportunity_ContactId"),
        F.col(f"{o}.IsWon").alias("opportunity_IsWon"),
        F.col(f"{o}.Loss_Amount__c").alias("opportunity_Loss_Amount"),
        t(f"{o}.CreatedDate").alias("opportunity_CreatedDate"),
        F.col(f"{o}.StageName").alias("opportunity_PayloadStageName"),
        F.col(f"{o}.Name").alias("opportunity_Name"),
        F.col(f"{o}.LeadSource").alias("opportunity_LeadSource"),
        t(f"{o}.LastModifiedDate").alias("opportunity_LastModifiedDate"),
        F.col(f"{o}.BaseCurrency").alias("base_currency"),
        F.col(f"{o}.Type").alias("opportunity_type"),
        F.col("m.data.opportunityHistory").alias("opportunityHistory"),
        F.col(f"{ld}.Id").alias("lead_Id"),
        F.col(f"{ld}.Email").alias("lead_Email"),
        F.col(f"{ld}.LeadSource").alias("lead_LeadSource"),
        t(f"{ld}.CreatedDate").alias("lead_CreatedDate"),
        F.col(f"{ld}.ConvertedOpportunityId").alias("lead_ConvertedOpportunityId"),
        F.col(f"{ld}.ConvertedAccountId").alias("lead_ConvertedAccountId"),
        F.col(f"{ld}.ConvertedContactId").alias("lead_ConvertedContactId"),
        t(f"{ld}.LastModifiedDate").alias("lead_LastModifiedDate"),
        F.col(f"{ld}.ConvertedDate").alias("lead_ConvertedDate"),
        F.col(f"{ld}.IsConverted").alias("lead_IsConverted"),
        F.col(f"{ld}.Status").alias("lead_Status"),
        F.col(f"{ld}.Name").alias("lead_Name"),
        F.col(f"{ld}.Industry").alias("lead_Industry"),
        F.col(f"{ld}.Country").alias("lead_Country"),
        F.col("m.data.contacts").alias("contacts"),
        F.col(f"{a}.Id").alias("account_Id"),
        F.col(f"{a}.Name").alias("account_Name"),
        F.col(f"{a}.owner.Id").alias("account_OwnerId"),
        F.col(f"{a}.owner.Name").alias("account_OwnerName"),
        F.col("m.timeStamp").alias("record_timeStamp"))
    times = [F.col(f"{x}_{c}") for x in ("opportunity", "lead") for c in ("CreatedDate", "LastModifiedDate")]
    unread = reduce(lambda x, y: x + y, [(F.col("time_texts")[i].isNotNull() & c.isNull()).cast("int") for i, c in enumerate(times)])
    blank = F.col("message").isNull() | (F.trim("message") == "")
    columns = [c for c in df.columns if c not in ("read", "partly", "message", "time_texts")]
    return _judge(df, [*columns, unread.alias("unread_times")], "prospects", [(blank, NO_VALUE), (~F.col("read"), "unreadable payload"),
                                    (F.col("organiser_Id").isNull(), "no tenant"),
                                    (F.coalesce("lead_Id", "opportunity_Id").isNull(), "no lead or opportunity id")],
                  notes=[(F.col("partly"), PARTLY_READ), (unread > 0, "unreadable time")], value="message")


_ABOUT = ["topic", "partition", "offset", "decoder", "fate", "reason", "value", "unread_times"]


def decode_prospects(rec: DataFrame, time_patterns: Sequence[str] = ()) -> DataFrame:
    """Every payload, flattened; what could not be read has NULL fields (``prospect_fates`` tells why)."""
    return prospect_fates(rec, time_patterns).drop(*_ABOUT)


def sync_fates(rec: DataFrame) -> DataFrame:
    """Sync notices -> organiser_Id (bigint), action, actor, client. Notices of other actions are ruled
    out; those that ask for something must name a tenant."""
    at = [c for c in ("topic", "partition", "offset") if c in rec.columns]
    d = parse_once(rec, [*at, F.col("value").alias("message")], {"m": ("value", S.SYNC_MSG)})
    df = d.select(*at, "message", F.col("m.context").isNotNull().alias("read"), F.col("m.context.oId").isNull().alias("no_tenant"),
                  F.col("m.context.oId").try_cast("bigint").alias("organiser_Id"), F.col("m.context.action").alias("action"),
                  F.col("m.context.actor").alias("actor"), F.col("m.context.client").alias("client"))
    blank = F.col("message").isNull() | (F.trim("message") == "")
    asks = F.coalesce(F.col("action").isin(S.ACTION_DISABLED, S.ACTION_FETCHED), F.lit(False))
    return _judge(df, [*at, "organiser_Id", "action", "actor", "client"], "notices", [(blank, NO_VALUE), (~F.col("read"), "unreadable notice"), (asks & F.col("no_tenant"), "no tenant"),
                                  (asks & F.col("organiser_Id").isNull(), BAD_TENANT)],
                  [(~asks, "other action")], value="message")


def decode_sync(rec: DataFrame) -> DataFrame:
    """Every notice -> organiser_Id (NULL when not numeric), action, actor, client."""
    return sync_fates(rec).select("organiser_Id", "action", "actor", "client")


def fate_counts(*fates: DataFrame) -> DataFrame:
    """Messages by decoder, fate and reason."""
    rows = reduce(DataFrame.unionByName, [f.select("decoder", "fate", "reason") for f in fates])
    return rows.groupBy("decoder", "fate", "reason").agg(F.count("*").alias("n"))
