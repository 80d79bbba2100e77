"""Message and table schemas (the shapes the change and CRM topics carry)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _f(name, dtype):
    return T.StructField(name, dtype, True)


def _st(*fields):
    return T.StructType([_f(n, t) for n, t in fields])


OID = _st(("$oid", S))

# Kafka record as delivered by the Kafka source (key/value binary).
KAFKA_RECORD = _st(("key", T.BinaryType()), ("value", T.BinaryType()), ("topic", S),
                   ("partition", T.IntegerType()), ("offset", L),
                   ("timestamp", T.TimestampType()), ("timestampType", T.IntegerType()))

# Change envelope: inner documents stay JSON text and are decoded in a second step.
# (The change producer also sends its own schema text; nobody reads it, so it is not parsed.)
ENVELOPE = _st(("payload", _st(("after", S), ("patch", S), ("filter", S), ("source", S))))
FILTER = _st(("_id", S))
PATCH = _st(("$v", S), ("$set", S), ("$unset", S))
SOURCE = _st(("db", S), ("collection", S), ("ts_ms", L))

USER_DOC = _st(("_id", OID), ("email", S), ("organiser_id", S))

REGISTRATION_DOC = _st(
    ("_id", OID), ("event_id", L), ("exhibitor_id", S), ("firstName", S), ("lastName", S),
    ("immutable", _st(("initLoginAt", S), ("isLoggedIn", S))), ("localCreatedAt", D),
    ("organiser_id", S), ("source", S), ("speaker_id", L), ("userId", OID))

# The eleven registration fields a change may carry (order = table order).
REGISTRATION_FIELDS = ["event_id", "exhibitor_id", "firstName", "lastName", "initLoginAt",
                       "isLoggedIn", "localCreatedAt", "organiser_id", "source", "speaker_id", "userId"]

OPPORTUNITY_DETAILS = _st(
    ("Id", S), ("Amount", D), ("LastActivityDate", S), ("AccountId", S),
    ("IsClosed", B), ("CloseDate", T.DateType()), ("Closed_Amount__c", D), ("ContactId", S),
    ("IsWon", B), ("Loss_Amount__c", D), ("CreatedDate", S), ("StageName", S), ("Name", S),
    ("LeadSource", S), ("LastModifiedDate", S), ("Type", S), ("BaseCurrency", S), ("CurrencyIsoCode", S))
HISTORY_ITEM = _st(("StageName", S), ("CreatedDate", T.DateType()))
LEAD_DETAILS = _st(
    ("Id", S), ("Email", S), ("LeadSource", S), ("CreatedDate", S), ("ConvertedOpportunityId", S),
    ("ConvertedAccountId", S), ("ConvertedContactId", S), ("LastModifiedDate", S),
    ("ConvertedDate", T.DateType()), ("IsConverted", B), ("Status", S), ("Name", S),
    ("Industry", S), ("Country", S))
CONTACT_ITEM = _st(("Id", S), ("Email", S), ("Name", S), ("LeadSource", S))
ACCOUNT_DETAILS = _st(("Name", S), ("Id", S), ("owner", _st(("Name", S), ("Id", S))))

NOTICE_CONTEXT = _st(("oId", S), ("action", S), ("actor", S), ("client", S))

PROSPECT_MSG = _st(
    ("data", _st(("organiserId", L), ("opportunityDetails", OPPORTUNITY_DETAILS),
                 ("opportunityHistory", T.ArrayType(HISTORY_ITEM)), ("leadDetails", LEAD_DETAILS),
                 ("contacts", T.ArrayType(CONTACT_ITEM)), ("accountDetails", ACCOUNT_DETAILS))),
    ("timeStamp", L))

SYNC_MSG = _st(("context", NOTICE_CONTEXT))

# Fixed values of the notice protocol.
ACTION_DISABLED = "ORGANISER_ROI_DISABLED"
ACTION_FETCHED = "ORGANISER_SF_DATA_FETCHING_COMPLETED"
ACTION_PROCESSED = "ORGANISER_SF_DATA_PROCESSING_COMPLETED"
ACTOR_SYSTEM = "SYSTEM"
