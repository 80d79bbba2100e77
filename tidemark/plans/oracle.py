"""Independent DuckDB formulations of every check, starting from the base tables.

The oracle never decodes JSON: it computes from the flat fixture definitions
(FIXTURES.md §B) what the Spark side obtains by encoding those rows as change /
CRM messages, decoding them and running the operators. Where the Spark side uses
an optimised form, the oracle uses the naive one (e.g. the full attribution
fan-out join followed by ``row_number``; the legacy spine + left joins + fill for
the funnel), so a match shows the two are equivalent.
"""

from __future__ import annotations

NOW = 1_700_000_000
MONEY = "DECIMAL(38,6)"
REG_FIELDS = ["event_id", "exhibitor_id", "firstName", "lastName", "initLoginAt", "isLoggedIn",
              "localCreatedAt", "organiser_id", "source", "speaker_id", "userId"]
REG_COLS = ["_id", *REG_FIELDS, "bucket"]
UR_COLS = ["organiser_id", "userId", "_id", "event_id", "exhibitor_id", "firstName", "lastName", "initLoginAt",
           "isLoggedIn", "localCreatedAt", "source", "speaker_id", "email", "load_timestamp"]
CHANGE_COLS = ["_id", *REG_FIELDS, "ts_ms", '"partition"', '"offset"', "OPS"]

OPP_COLS = ["organiser_Id", "opportunity_Id", "prospect_id", "opportunity_Amount", "opportunity_Currency", "base_currency",
            "opportunity_LastActivityDate", "opportunity_AccountId", "opportunity_IsClosed", "opportunity_CloseDate",
            "opportunity_Closed_Amount", "opportunity_IsWon", "opportunity_Loss_Amount", "Opportunity_StageName", "opportunity_Name",
            "opportunity_LeadSource", "opportunity_type", "account_Id", "account_Name", "account_OwnerId", "account_OwnerName"]
FLAT_COLS = [*[c for c in OPP_COLS if c not in ("prospect_id", "Opportunity_StageName")], "opportunity_PayloadStageName", "opportunity_ContactId",
             "lead_Id", "lead_Email", "lead_LeadSource", "lead_ConvertedOpportunityId", "lead_ConvertedAccountId",
             "lead_ConvertedContactId", "lead_ConvertedDate", "lead_IsConverted", "lead_Status", "lead_Name", "lead_Industry",
             "lead_Country", "record_timeStamp"]

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


def build(deps: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order) + "\n" + select


def ms(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def latest(src: str, keys: str, order: list[str], where: str = "TRUE") -> str:
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"SELECT * FROM {src} WHERE {where} QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {o}) = 1"


def null_safe(a: str, b: str, keys: list[str]) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


# ----------------------------------------------------------------- fixtures --
cte("fx_users", [], f"""
SELECT lpad(CAST(c_custkey AS VARCHAR), 24, '0') AS _id, CAST(c_nationkey AS BIGINT) AS organiser_id,
       CASE WHEN c_custkey % 29 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN upper(c_name || '@Mail.Example')
            ELSE c_name || '@Mail.Example' END AS email,
       c_custkey AS kafka_offset
FROM customer""")

cte("fx_registrations", [], f"""
SELECT lpad(CAST(o_orderkey AS VARCHAR), 24, '0') AS _id,
       1 + o_orderkey % 40 AS event_id,
       CASE WHEN o_orderkey % 10 = 0 THEN 'EX' || CAST(o_orderkey % 7 AS VARCHAR) END AS exhibitor_id,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL
            WHEN o_orderkey % 23 = 0 THEN repeat('x', 300)
            ELSE 'First' || CAST(o_custkey AS VARCHAR) END AS firstName,
       'Last' || CAST(o_custkey AS VARCHAR) AS lastName,
       CASE WHEN o_orderstatus = 'F' THEN CAST({ms('o_orderdate')} AS VARCHAR) || '.6' END AS initLoginAt,
       CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' END AS isLoggedIn,
       CAST({ms('o_orderdate')} AS DOUBLE) AS localCreatedAt,
       CAST(c_nationkey AS BIGINT) AS organiser_id,
       o_orderpriority AS source,
       CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey % 9 END AS speaker_id,
       lpad(CAST(o_custkey AS VARCHAR), 24, '0') AS userId,
       {ms('o_orderdate')} AS ts_ms,
       o_orderkey AS kafka_offset,
       CASE WHEN o_orderkey % 5 <> 0 THEN 0 ELSE 1 END AS file_no
FROM orders JOIN customer ON o_custkey = c_custkey""")

cte("fx_patches", [], f"""
SELECT lpad(CAST(event_id % 3000 AS VARCHAR), 24, '0') AS _id,
       CASE WHEN event_type = 'view' THEN 1 + CAST(json_extract(props, '$.k') AS BIGINT) END AS event_id,
       CASE WHEN event_type = 'purchase' THEN 'F' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) END AS firstName,
       CASE WHEN event_type = 'signup' THEN CAST({ms('ts')} AS VARCHAR) END AS initLoginAt,
       CASE WHEN event_type = 'signup' THEN 'true' END AS isLoggedIn,
       CASE WHEN event_type = 'click' THEN 'click' END AS source,
       event_id % 20 = 0 AS is_delete,
       {ms('ts')} AS ts_ms,
       event_id AS kafka_offset,
       CASE WHEN ts < TIMESTAMP '2024-01-11 00:00:00' THEN 0
            WHEN ts < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END AS file_no
FROM events""")

cte("fx_prospects", [], f"""
SELECT CAST(c_nationkey AS BIGINT) AS organiser_id, o_orderkey,
       'OP' || CAST(o_orderkey - o_orderkey % 2 AS VARCHAR) AS opportunity_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'L' || CAST(o_custkey AS VARCHAR) END AS lead_id,
       CASE WHEN o_orderkey % 3 = 0 THEN lower(c_name) || '@mail.example' END AS lead_email,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Platform' ELSE 'Web' END AS lead_source,
       o_totalprice AS amount, o_orderstatus IN ('F', 'P') AS is_closed, o_orderstatus = 'F' AS is_won,
       'C' || CAST(c_nationkey % 5 AS VARCHAR) AS currency, 'C0' AS base_currency,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE epoch_us(o_orderdate) // 1000000 END AS created_s,
       'A' || o_orderkey AS last_activity, 'AC' || (o_orderkey % 97) AS account_id,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS close_date,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 2 END AS closed_amount,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice / 4 END AS loss_amount,
       'OC' || (o_orderkey % 89) AS contact_ref, 'ST' || (o_orderkey % 6) AS stage, 'Opp ' || o_orderkey AS opp_name,
       'T' || (o_orderkey % 3) AS opp_type, 'OP' || o_orderkey AS lead_conv_opp, 'AC' || (o_orderkey % 97) AS lead_conv_account,
       'CT' || o_custkey AS lead_conv_contact, CAST(o_orderdate AS DATE) + 1 AS lead_conv_date, o_orderkey % 2 = 0 AS lead_converted,
       'S' || (o_orderkey % 4) AS lead_status, 'Lead ' || o_orderkey AS lead_name, 'I' || (o_orderkey % 5) AS lead_industry,
       'N' || c_nationkey AS lead_country, 'Account ' || (o_orderkey % 97) AS account_name, 'OW' || (o_orderkey % 11) AS owner_id,
       'Owner ' || (o_orderkey % 11) AS owner_name,
       o_custkey, {ms('o_orderdate')} + o_orderkey AS record_ts,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 0 ELSE 1 END AS batch_no
FROM orders JOIN customer ON o_custkey = c_custkey""")

cte("hist_latest", [], """
SELECT l_orderkey AS o_orderkey, CAST(l_shipdate AS DATE) AS stage_date, l_returnflag || l_linestatus AS stage_name
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
                           ORDER BY CAST(l_shipdate AS DATE) DESC NULLS LAST, l_returnflag || l_linestatus DESC NULLS LAST) = 1""")

cte("fx_contacts", ["fx_prospects"], """
SELECT p.o_orderkey, 'CT' || CAST(c.c_custkey AS VARCHAR) AS contact_id,
       c.c_name || '@MAIL.example' AS email, c.c_name AS name, p.lead_source
FROM fx_prospects p JOIN customer c
  ON c.c_custkey = p.o_custkey OR c.c_custkey = (p.o_custkey + 1) % (SELECT count(*) FROM customer)
WHERE p.o_orderkey % 11 <> 0""")

cte("fx_rates", [], """
SELECT 'C' || CAST(i AS VARCHAR) AS base_currency, 'C0' AS target_currency, CAST(1 + i * 0.25 AS DOUBLE) AS conversion_rate
FROM (SELECT DISTINCT n_regionkey AS i FROM nation WHERE n_regionkey < 4)""")

cte("fx_notices", [], """
SELECT CAST(n_nationkey AS VARCHAR) AS oId,
       CASE n_nationkey % 5 WHEN 0 THEN 'ORGANISER_ROI_DISABLED'
                            WHEN 4 THEN 'ORGANISER_SF_DATA_PROCESSING_COMPLETED'
                            WHEN 3 THEN 'UNRELATED'
                            ELSE 'ORGANISER_SF_DATA_FETCHING_COMPLETED' END AS action
FROM nation CROSS JOIN (VALUES (1), (2)) AS d(copy)""")

cte("fetched", ["fx_notices"], """
SELECT DISTINCT TRY_CAST(oId AS BIGINT) AS organiser_Id FROM fx_notices
WHERE action = 'ORGANISER_SF_DATA_FETCHING_COMPLETED' AND TRY_CAST(oId AS BIGINT) IS NOT NULL""")
cte("disabled", ["fx_notices"], """
SELECT DISTINCT TRY_CAST(oId AS BIGINT) AS organiser_Id FROM fx_notices
WHERE action = 'ORGANISER_ROI_DISABLED' AND TRY_CAST(oId AS BIGINT) IS NOT NULL""")

# ---------------------------------------------------------------------- CDC --
cte("ins_raw", ["fx_registrations"], """
SELECT _id, event_id, exhibitor_id, firstName, lastName, initLoginAt, isLoggedIn, localCreatedAt, organiser_id,
       source, speaker_id, userId, ts_ms, 0 AS "partition", kafka_offset AS "offset", 'INSERT' AS OPS, file_no
FROM fx_registrations
WHERE organiser_id IS NOT NULL AND length(firstName) <= 264 AND length(lastName) <= 264""")

cte("pat_raw", ["fx_patches"], """
SELECT _id,
       CASE WHEN NOT is_delete THEN event_id END AS event_id, CAST(NULL AS VARCHAR) AS exhibitor_id,
       CASE WHEN NOT is_delete THEN firstName END AS firstName, CAST(NULL AS VARCHAR) AS lastName,
       CASE WHEN NOT is_delete THEN initLoginAt END AS initLoginAt,
       CASE WHEN NOT is_delete THEN isLoggedIn END AS isLoggedIn,
       CAST(NULL AS DOUBLE) AS localCreatedAt, CAST(NULL AS BIGINT) AS organiser_id,
       CASE WHEN NOT is_delete THEN source END AS source, CAST(NULL AS BIGINT) AS speaker_id,
       CAST(NULL AS VARCHAR) AS userId, ts_ms, 1 AS "partition", kafka_offset AS "offset", 'UPDATE' AS OPS, file_no
FROM fx_patches""")

cte("chg_raw", ["ins_raw", "pat_raw"], "SELECT * FROM ins_raw UNION ALL SELECT * FROM pat_raw")

cte("chg_typed", ["chg_raw"], """
SELECT _id, event_id, exhibitor_id, firstName, lastName,
       CAST(round(TRY_CAST(initLoginAt AS DOUBLE)) AS BIGINT) AS initLoginAt,
       TRY_CAST(isLoggedIn AS BOOLEAN) AS isLoggedIn, localCreatedAt, organiser_id, source, speaker_id, userId,
       ts_ms, "partition", "offset", OPS, file_no
FROM chg_raw""")

cte("chg", ["chg_typed"], f"""
SELECT *, CAST(list_sum(list_transform(string_split(_id, ''), lambda ch: ascii(ch))) % 100 AS INTEGER) AS bucket
FROM chg_typed
WHERE {' OR '.join(f'{c} IS NOT NULL' for c in REG_FIELDS)}""")

cte("users_state", ["fx_users"], """
SELECT _id, organiser_id, email FROM fx_users WHERE organiser_id IS NOT NULL AND email IS NOT NULL""")

# What becomes of messages of which some are damaged (by offset modulo 97), in two steps for change records.
def _case(*pairs: tuple[str, str]) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, r in pairs) + " END"


FIELDS_SET = " OR ".join(f"{c} IS NOT NULL" for c in ("event_id", "firstName", "initLoginAt", "isLoggedIn", "source"))
cte("chg_msgs", ["fx_users", "fx_registrations", "fx_patches"], f"""
SELECT 'users' AS kind, 'cdc.app.users' AS topic, 0 AS "partition", kafka_offset AS "offset", organiser_id, kafka_offset % 97 AS k,
       email IS NULL AS a, false AS is_delete, {_case(("email IS NULL", "no e-mail"))} AS rule FROM fx_users
UNION ALL
SELECT 'registrations', 'cdc.app.communities', 0, kafka_offset, organiser_id, kafka_offset % 97, false, false,
       CASE WHEN firstName IS NULL OR length(firstName) > 264 OR lastName IS NULL OR length(lastName) > 264 THEN 'name missing or too long' END
FROM fx_registrations
UNION ALL
SELECT 'patches', 'cdc.app.communities', 1, kafka_offset, NULL, kafka_offset % 97, false, is_delete,
       CASE WHEN is_delete OR NOT ({FIELDS_SET}) THEN 'empty change' END FROM fx_patches""")
cte("env_fates", ["chg_msgs"], f"""
SELECT *, {_case(("k IN (5, 7)", "unreadable envelope"), ("k = 6", "no value"), ("kind = 'patches' AND k = 11", "unreadable filter"),
                 ("kind = 'patches' AND k = 10 AND NOT is_delete", "unreadable patch"))} AS env_reason FROM chg_msgs""")
cte("msg_fates", ["env_fates", "fx_prospects", "fx_notices"], f"""
SELECT topic, "partition", "offset", 'envelope' AS decoder, CASE WHEN env_reason IS NULL THEN 'kept' ELSE 'rejected' END AS fate,
       env_reason AS reason, CAST(NULL AS BIGINT) AS organiser_Id FROM env_fates
UNION ALL
SELECT topic, "partition", "offset", kind,
       CASE WHEN kind <> 'patches' AND k IN (8, 9) THEN 'rejected' WHEN rule IS NOT NULL THEN 'ruled out' ELSE 'kept' END,
       CASE WHEN kind <> 'patches' AND k = 8 THEN 'tenant id is not a number' WHEN kind <> 'patches' AND k = 9 THEN 'unreadable document' ELSE rule END,
       CASE WHEN kind <> 'patches' AND k NOT IN (8, 9) THEN organiser_id END
FROM env_fates WHERE env_reason IS NULL
UNION ALL
SELECT 'crm.prospects.ingest', 0, o_orderkey, 'prospects', CASE WHEN k IN (5, 6, 7, 8, 9) THEN 'rejected' ELSE 'kept' END,
       {_case(("k IN (5, 7)", "unreadable payload"), ("k = 6", "no value"), ("k IN (8, 9)", "no tenant"), ("k = 10", "a field of another type"),
              ("created_s IS NULL", "unreadable time"))}, CASE WHEN k NOT IN (5, 6, 7, 8, 9) THEN organiser_id END
FROM (SELECT *, o_orderkey % 97 AS k FROM fx_prospects)
UNION ALL
SELECT 'crm.organiser.sync', 0, off, 'notices',
       CASE WHEN k IN (5, 6, 7) OR (k = 8 AND asks) THEN 'rejected' WHEN NOT asks THEN 'ruled out' ELSE 'kept' END,
       CASE WHEN k IN (5, 7) THEN 'unreadable notice' WHEN k = 6 THEN 'no value' WHEN NOT asks THEN 'other action'
            WHEN k = 8 THEN 'tenant id is not a number' END, NULL
FROM (SELECT off, off % 97 AS k, action IN ('ORGANISER_ROI_DISABLED', 'ORGANISER_SF_DATA_FETCHING_COMPLETED') AS asks
      FROM (SELECT CAST(oId AS BIGINT) * 2 + row_number() OVER (PARTITION BY oId ORDER BY action) AS off, action FROM fx_notices))""")

ORDER_CHG = ["ts_ms", '"partition"', '"offset"']


def _apply(tag: str, prev: str | None, where: str) -> str:
    """CTEs for one batch of registration changes; returns the name of the state CTE."""
    cte(f"ins_{tag}", ["chg"], latest("chg", "_id, bucket", ORDER_CHG, f"OPS = 'INSERT' AND {where}"))
    cte(f"pl_{tag}", ["chg"], latest("chg", "_id, bucket", ORDER_CHG, f"OPS = 'UPDATE' AND {where}"))
    cols = ", ".join(REG_COLS)
    if prev is None:
        cte(f"ai_{tag}", [f"ins_{tag}"], f"SELECT {cols} FROM ins_{tag}")
    else:
        cte(f"ai_{tag}", [f"ins_{tag}", prev], f"""
SELECT {cols} FROM {prev}
UNION ALL
SELECT {', '.join('i.' + c for c in REG_COLS)} FROM ins_{tag} i
WHERE NOT EXISTS (SELECT 1 FROM {prev} s WHERE s._id IS NOT DISTINCT FROM i._id AND s.bucket IS NOT DISTINCT FROM i.bucket)""")
    sel = ", ".join(["b._id"] + [f"coalesce(p.{c}, b.{c}) AS {c}" for c in REG_FIELDS] + ["b.bucket"])
    cte(f"reg_{tag}", [f"ai_{tag}", f"pl_{tag}"], f"""
SELECT {sel} FROM ai_{tag} b LEFT JOIN pl_{tag} p ON {null_safe('b', 'p', ['_id', 'bucket'])}""")
    cte(f"keys_{tag}", ["chg"], f"SELECT DISTINCT _id, bucket FROM chg WHERE {where}")
    ur_sel = ", ".join(f"r.{c}" for c in UR_COLS if c not in ("email", "load_timestamp"))
    cte(f"joined_{tag}", [f"reg_{tag}", f"keys_{tag}", "users_state"], f"""
SELECT {ur_sel}, u.email, CAST({NOW} AS BIGINT) AS load_timestamp
FROM reg_{tag} r LEFT JOIN users_state u ON u.organiser_id = r.organiser_id AND u._id = r.userId
WHERE EXISTS (SELECT 1 FROM keys_{tag} k WHERE {null_safe('k', 'r', ['_id', 'bucket'])})""")
    return f"reg_{tag}"


_apply("all", None, "TRUE")
_apply("f0", None, "file_no = 0")
_apply("f1", "reg_f0", "file_no = 1")
_apply("f2", "reg_f1", "file_no = 2")
URK = ["organiser_id", "userId", "_id"]
cte("ur_f0", ["joined_f0"], "SELECT * FROM joined_f0")
for prev, cur in (("f0", "f1"), ("f1", "f2")):
    cte(f"ur_{cur}", [f"ur_{prev}", f"joined_{cur}"], f"""
SELECT * FROM ur_{prev} b WHERE NOT EXISTS (SELECT 1 FROM joined_{cur} s WHERE {null_safe('s', 'b', URK)})
UNION ALL SELECT * FROM joined_{cur}""")

# ---------------------------------------------------------------------- CRM --
cte("pmsg", ["fx_prospects", "hist_latest"], """
SELECT p.organiser_id AS organiser_Id, p.o_orderkey, p.opportunity_id AS opportunity_Id,
       p.amount AS opportunity_Amount, p.currency AS opportunity_Currency, p.base_currency,
       p.is_closed AS opportunity_IsClosed, p.is_won AS opportunity_IsWon, p.lead_source AS opportunity_LeadSource,
       p.lead_id AS lead_Id, p.lead_email AS lead_Email,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_source END AS lead_LeadSource,
       p.created_s AS opp_created_s, p.created_s AS opp_modified_s,
       CASE WHEN p.lead_id IS NOT NULL THEN p.created_s END AS lead_created_s,
       CASE WHEN p.lead_id IS NOT NULL THEN p.created_s END AS lead_modified_s,
       p.record_ts AS record_timeStamp, coalesce(p.lead_id, p.opportunity_id) AS prospect_id,
       h.stage_name AS Opportunity_StageName, h.stage_date AS OpportunityCurrentStageDate,
       p.last_activity AS opportunity_LastActivityDate, p.account_id AS opportunity_AccountId, p.close_date AS opportunity_CloseDate,
       p.closed_amount AS opportunity_Closed_Amount, p.loss_amount AS opportunity_Loss_Amount, p.contact_ref AS opportunity_ContactId,
       p.stage AS opportunity_PayloadStageName, p.opp_name AS opportunity_Name, p.opp_type AS opportunity_type,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_conv_opp END AS lead_ConvertedOpportunityId,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_conv_account END AS lead_ConvertedAccountId,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_conv_contact END AS lead_ConvertedContactId,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_conv_date END AS lead_ConvertedDate,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_converted END AS lead_IsConverted,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_status END AS lead_Status,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_name END AS lead_Name,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_industry END AS lead_Industry,
       CASE WHEN p.lead_id IS NOT NULL THEN p.lead_country END AS lead_Country,
       p.account_id AS account_Id, p.account_name AS account_Name, p.owner_id AS account_OwnerId, p.owner_name AS account_OwnerName,
       p.batch_no, p.o_orderkey % 11 = 0 AS contacts_missing
FROM fx_prospects p LEFT JOIN hist_latest h ON h.o_orderkey = p.o_orderkey""")

W2 = ["record_timeStamp", "opportunity_Id"]
cte("prosp_all", ["pmsg"], latest("pmsg", "organiser_Id, prospect_id", W2,
                                  "organiser_Id IS NOT NULL AND prospect_id IS NOT NULL"))
cte("prosp_b0", ["pmsg"], latest("pmsg", "organiser_Id, prospect_id", W2,
                                 "organiser_Id IS NOT NULL AND prospect_id IS NOT NULL AND batch_no = 0"))
cte("prosp_b1", ["pmsg"], latest("pmsg", "organiser_Id, prospect_id", W2,
                                 "organiser_Id IS NOT NULL AND prospect_id IS NOT NULL AND batch_no = 1"))
cte("prosp_up", ["prosp_b0", "prosp_b1"], f"""
SELECT * FROM prosp_b0 b WHERE NOT EXISTS (SELECT 1 FROM prosp_b1 s WHERE {null_safe('s', 'b', ['prospect_id', 'organiser_Id'])})
UNION ALL SELECT * FROM prosp_b1""")

cte("areg", ["fx_registrations", "users_state"], """
SELECT r.organiser_id AS organiser_Id, r.userId, r._id AS communities_id, r.event_id,
       CAST(round(TRY_CAST(r.initLoginAt AS DOUBLE)) AS BIGINT) AS initLoginAt,
       TRY_CAST(r.isLoggedIn AS BOOLEAN) AS isLoggedIn, r.localCreatedAt, lower(u.email) AS email
FROM fx_registrations r LEFT JOIN users_state u ON u._id = r.userId AND u.organiser_id = r.organiser_id""")

cte("att_metrics", ["areg"], """
SELECT organiser_Id, event_id,
       count(DISTINCT userId) FILTER (WHERE initLoginAt IS NULL) AS att_0,
       count(DISTINCT userId) FILTER (WHERE initLoginAt IS NOT NULL) AS att_1
FROM areg GROUP BY organiser_Id, event_id""")


def _crm(tag: str, prosp: str) -> None:
    """Lead/contact rows -> FX -> attribution -> contacts -> opportunities -> funnel."""
    cte(f"lc_{tag}", [prosp, "fx_contacts"], f"""
SELECT c.contact_id AS SF_Id, c.name AS Name, lower(c.email) AS email, p.organiser_Id, p.opportunity_Id,
       'CONTACT' AS recordType, c.lead_source AS Source, p.opportunity_IsWon AS IsWon,
       p.opportunity_IsClosed AS IsClosed, p.opp_created_s AS created_s,
       greatest(p.opp_modified_s, p.lead_modified_s) AS modified_s, p.opportunity_Amount,
       p.opportunity_Currency, p.base_currency, p.prospect_id
FROM {prosp} p JOIN fx_contacts c ON c.o_orderkey = p.o_orderkey
UNION ALL
SELECT p.lead_Id, CAST(NULL AS VARCHAR), lower(p.lead_Email), p.organiser_Id, p.opportunity_Id, 'LEAD',
       p.lead_LeadSource, p.opportunity_IsWon, p.opportunity_IsClosed, p.lead_created_s,
       greatest(p.opp_modified_s, p.lead_modified_s), p.opportunity_Amount, p.opportunity_Currency,
       p.base_currency, p.prospect_id
FROM {prosp} p""")
    cte(f"fxn_{tag}", [f"lc_{tag}", "fx_rates"], f"""
SELECT l.*, r.target_currency, coalesce(r.conversion_rate, 1.0) AS conversion_rate,
       l.opportunity_Amount * coalesce(r.conversion_rate, 1.0) AS amount_fx
FROM lc_{tag} l LEFT JOIN fx_rates r ON l.base_currency = r.target_currency AND l.opportunity_Currency = r.base_currency""")
    # the full fan-out: one row per (prospect row, matching registration)
    cte(f"fan_{tag}", [f"fxn_{tag}", "areg"], f"""
SELECT f.*, r.communities_id, r.event_id, r.initLoginAt AS login_ms, r.isLoggedIn, r.localCreatedAt,
       r.email AS platform_email,
       count(r.communities_id) OVER (PARTITION BY f.organiser_Id, f.prospect_id, f.recordType, f.SF_Id) AS matched_registrations,
       CASE WHEN f.email = r.email AND coalesce(r.isLoggedIn, false) AND f.Source = 'Platform' THEN 1
            WHEN f.email = r.email AND coalesce(r.isLoggedIn, false) THEN 2 ELSE 0 END AS touch_point,
       r.initLoginAt // 1000 AS initLoginAt,
       f.created_s AS touchpoint_timestamp,
       CAST(make_timestamp(f.created_s * 1000000) AS DATE) AS touchpoint_date,
       CAST(make_timestamp(f.created_s * 1000000) AS DATE) AS record_created_date,
       CAST({NOW} AS BIGINT) AS load_timestamp
FROM fxn_{tag} f LEFT JOIN areg r ON r.organiser_Id = f.organiser_Id AND r.email = f.email
WHERE f.SF_Id IS NOT NULL""")
    cte(f"att_{tag}", [f"fan_{tag}"], latest(f"fan_{tag}", "organiser_Id, prospect_id, recordType, SF_Id",
                                             ["localCreatedAt", "communities_id"]))
    cte(f"contacts_{tag}", [f"fan_{tag}"], latest(
        f"fan_{tag}", "organiser_Id, SF_Id",
        ["touchpoint_timestamp", "opportunity_Id", "prospect_id", "localCreatedAt", "communities_id"]))
    cte(f"opp_{tag}", [prosp], f"""
SELECT {", ".join(OPP_COLS)}, opp_created_s AS created_s, opp_modified_s AS last_modified_s, CAST({NOW} AS BIGINT) AS load_timestamp
FROM {prosp} WHERE opportunity_Id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY organiser_Id, opportunity_Id
                           ORDER BY opp_modified_s DESC NULLS LAST, prospect_id DESC NULLS LAST) = 1""")
    cte(f"fi_{tag}", [f"contacts_{tag}"], f"""
SELECT SF_Id, organiser_Id, event_id, opportunity_Id, amount_fx AS opportunity_Amount, recordType,
       CASE WHEN IsClosed AND IsWon THEN 1 ELSE 0 END AS ClosedWon
FROM contacts_{tag}""")
    cte(f"top_{tag}", [f"fi_{tag}"], latest(f"fi_{tag}", "organiser_Id, event_id, opportunity_Id",
                                            ["opportunity_Amount", "SF_Id"]))
    cte(f"piv_{tag}", [f"top_{tag}"], f"""
SELECT organiser_Id, event_id,
       count(DISTINCT opportunity_Id) FILTER (WHERE ClosedWon = 0) AS cnt_opportunity_0,
       sum(CAST(opportunity_Amount AS {MONEY})) FILTER (WHERE ClosedWon = 0) AS amt_opportunity_0,
       count(DISTINCT opportunity_Id) FILTER (WHERE ClosedWon = 1) AS cnt_opportunity_1,
       sum(CAST(opportunity_Amount AS {MONEY})) FILTER (WHERE ClosedWon = 1) AS amt_opportunity_1
FROM top_{tag} GROUP BY organiser_Id, event_id""")
    cte(f"leads_{tag}", [f"fi_{tag}"], f"""
SELECT organiser_Id, event_id, count(DISTINCT SF_Id) AS cnt_leads
FROM fi_{tag} WHERE recordType = 'LEAD' GROUP BY organiser_Id, event_id""")
    cte(f"keys_{tag}", [f"piv_{tag}", f"leads_{tag}"], f"""
SELECT organiser_Id, event_id FROM piv_{tag} UNION SELECT organiser_Id, event_id FROM leads_{tag}""")
    # legacy mechanism: plain-equality left joins (a NULL event never matches), then fill with 0
    cte(f"funnel_{tag}", [f"keys_{tag}", f"piv_{tag}", f"leads_{tag}", "att_metrics"], f"""
SELECT k.organiser_Id, coalesce(k.event_id, 0) AS event_id,
       CAST(coalesce(p.cnt_opportunity_0, 0) + coalesce(p.cnt_opportunity_1, 0) AS BIGINT) AS Opportunity_Count,
       CAST(coalesce(p.cnt_opportunity_1, 0) AS BIGINT) AS ClosedWon_Count,
       CAST(coalesce(p.amt_opportunity_0, 0) + coalesce(p.amt_opportunity_1, 0) AS {MONEY}) AS Opportunity_Amount,
       CAST(coalesce(p.amt_opportunity_1, 0) AS {MONEY}) AS ClosedWon_Amount,
       CAST(coalesce(l.cnt_leads, 0) AS BIGINT) AS leads_count,
       CAST(coalesce(a.att_0, 0) + coalesce(a.att_1, 0) AS BIGINT) AS regn,
       CAST(coalesce(a.att_1, 0) AS BIGINT) AS atts,
       CAST({NOW} AS BIGINT) AS load_timestamp
FROM keys_{tag} k
LEFT JOIN piv_{tag} p ON p.organiser_Id = k.organiser_Id AND p.event_id = k.event_id
LEFT JOIN leads_{tag} l ON l.organiser_Id = k.organiser_Id AND l.event_id = k.event_id
LEFT JOIN att_metrics a ON a.organiser_Id = k.organiser_Id AND a.event_id = k.event_id""")


def _funnel_keep() -> str:
    """The funnel with unattributed prospects under a NULL event: keys compare NULL-safe."""
    eq = lambda t: null_safe("k", t, ["organiser_Id", "event_id"])
    return build(["keys_all", "piv_all", "leads_all", "att_metrics"], f"""
SELECT k.organiser_Id, k.event_id,
       CAST(coalesce(p.cnt_opportunity_0, 0) + coalesce(p.cnt_opportunity_1, 0) AS BIGINT) AS Opportunity_Count,
       CAST(coalesce(p.cnt_opportunity_1, 0) AS BIGINT) AS ClosedWon_Count,
       CAST(coalesce(p.amt_opportunity_0, 0) + coalesce(p.amt_opportunity_1, 0) AS {MONEY}) AS Opportunity_Amount,
       CAST(coalesce(p.amt_opportunity_1, 0) AS {MONEY}) AS ClosedWon_Amount,
       CAST(coalesce(l.cnt_leads, 0) AS BIGINT) AS leads_count,
       CAST(coalesce(a.att_0, 0) + coalesce(a.att_1, 0) AS BIGINT) AS regn,
       CAST(coalesce(a.att_1, 0) AS BIGINT) AS atts, CAST({NOW} AS BIGINT) AS load_timestamp
FROM keys_all k LEFT JOIN piv_all p ON {eq("p")} LEFT JOIN leads_all l ON {eq("l")} LEFT JOIN att_metrics a ON {eq("a")}""")


# the joined table when the disabled tenants are erased after each of the first two change batches
cte("ur_e0", ["joined_f0", "disabled"], "SELECT * FROM joined_f0 WHERE organiser_id NOT IN (SELECT organiser_Id FROM disabled)")
for prev, cur, erased in (("e0", "f1", "e1"), ("e1", "f2", None)):
    cte(f"ur_{prev}_{cur}", [f"ur_{prev}", f"joined_{cur}"], f"""
SELECT * FROM ur_{prev} b WHERE NOT EXISTS (SELECT 1 FROM joined_{cur} s WHERE {null_safe('s', 'b', URK)})
UNION ALL SELECT * FROM joined_{cur}""")
    if erased:
        cte(f"ur_{erased}", [f"ur_{prev}_{cur}", "disabled"],
            f"SELECT * FROM ur_{prev}_{cur} WHERE organiser_id NOT IN (SELECT organiser_Id FROM disabled)")

_crm("all", "prosp_all")
_crm("b0", "prosp_b0")
_crm("b1", "prosp_b1")

CONTACT_SEL = """organiser_Id, SF_Id, recordType, prospect_id, email, Source, opportunity_Id,
       amount_fx AS opportunity_Amount, conversion_rate, IsWon, IsClosed, communities_id, event_id,
       matched_registrations, touch_point, initLoginAt, touchpoint_timestamp, touchpoint_date,
       record_created_date, load_timestamp"""
PROSPECT_SEL = """prospect_id, organiser_Id, opportunity_Id, lead_Id, lead_Email, record_timeStamp, opportunity_Amount,
       opportunity_Currency, opportunity_IsClosed, opportunity_IsWon, Opportunity_StageName,
       OpportunityCurrentStageDate, base_currency"""
FUNNEL_SEL = """organiser_Id, event_id, Opportunity_Count, ClosedWon_Count, Opportunity_Amount, ClosedWon_Amount,
       leads_count, regn, atts, load_timestamp"""


def _upsert(base: str, new: str, keys: list[str], sel: str) -> str:
    return build([base, new], f"""
SELECT {sel} FROM {base} b WHERE NOT EXISTS (SELECT 1 FROM {new} s WHERE {null_safe('s', 'b', keys)})
UNION ALL SELECT {sel} FROM {new}""")


def _erasure() -> str:
    parts = []
    for name, src, col in (("prospects", "prosp_all", "organiser_Id"), ("user_registrations", "areg", "organiser_Id"),
                           ("contacts", "contacts_all", "organiser_Id"), ("opportunities", "opp_all", "organiser_Id"),
                           ("event_agg", "funnel_all", "organiser_Id")):
        parts.append(f"""SELECT '{name}' AS table_name, {col} AS organiser_Id, count(*) AS n_rows FROM {src}
WHERE {col} NOT IN (SELECT organiser_Id FROM disabled) GROUP BY {col}""")
    return build(["prosp_all", "areg", "contacts_all", "opp_all", "funnel_all", "disabled"], "\nUNION ALL\n".join(parts))


RC = ", ".join(REG_COLS)
CC = ", ".join(CHANGE_COLS)
UC = ", ".join(UR_COLS)

ORACLES: dict[str, str] = {
    "cdc_envelope_decode": build(["fx_registrations", "fx_patches"], """
SELECT 'cdc.app.users' AS topic, 0 AS "partition", c_custkey AS "offset", 'app' AS db, 'users' AS collection,
       CAST(0 AS BIGINT) AS ts_ms, CAST(NULL AS VARCHAR) AS filter_oid, true AS has_after, CAST(NULL AS VARCHAR) AS v
FROM customer
UNION ALL
SELECT 'cdc.app.communities', 0, kafka_offset, 'app', 'communities', ts_ms, NULL, true, NULL FROM fx_registrations
UNION ALL
SELECT 'cdc.app.communities', 1, kafka_offset, 'app', 'communities', ts_ms, _id, false,
       CASE WHEN is_delete THEN NULL ELSE '2' END FROM fx_patches"""),
    "cdc_users_insert": build(["users_state"], "SELECT _id, organiser_id, email FROM users_state"),
    "cdc_registration_insert": build(["ins_all"], f"SELECT {RC} FROM ins_all"),
    "cdc_patch_decode": build(["chg"], f"SELECT {CC} FROM chg WHERE OPS = 'UPDATE'"),
    "cdc_change_union": build(["chg_raw"], f"SELECT {CC} FROM chg_raw"),
    "cdc_change_types": build(["chg_typed"], f"SELECT {CC} FROM chg_typed"),
    "registration_bucket": build(["chg"], "SELECT DISTINCT _id, bucket FROM chg"),
    "cdc_patch_latest": build(["pl_all"], f"SELECT {CC}, bucket FROM pl_all"),
    "cdc_patch_merge": build(["reg_all"], f"SELECT {RC} FROM reg_all"),
    "changed_registrations": build(["reg_f2", "keys_f2"], f"""
SELECT {RC} FROM reg_f2 r WHERE EXISTS (SELECT 1 FROM keys_f2 k WHERE {null_safe('k', 'r', ['_id', 'bucket'])})"""),
    "registration_user_join": build(["joined_f2"], f"SELECT {UC} FROM joined_f2"),
    "registration_upsert": build(["ur_f2"], f"SELECT {UC} FROM ur_f2"),
    "stream_cdc_apply": build(["ur_f2"], f"SELECT {UC} FROM ur_f2"),
    "prospect_flatten": build(["pmsg", "fx_contacts"], f"""
SELECT {", ".join(FLAT_COLS)}, opp_created_s AS opportunity_created_s, opp_modified_s AS opportunity_modified_s,
       lead_created_s, lead_modified_s, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_history,
       (SELECT count(*) FROM fx_contacts c WHERE c.o_orderkey = pmsg.o_orderkey) AS n_contacts
FROM pmsg"""),
    "time_parse": build(["pmsg"], """
SELECT record_timeStamp, opp_created_s AS opportunity_CreatedDate, lead_created_s AS lead_CreatedDate,
       opp_modified_s AS last_modified_s FROM pmsg"""),
    "prospect_latest_stage": build(["pmsg"], """
SELECT record_timeStamp, Opportunity_StageName, OpportunityCurrentStageDate FROM pmsg"""),
    "prospect_key_latest": build(["prosp_all"], f"SELECT {PROSPECT_SEL} FROM prosp_all"),
    "prospect_upsert": build(["prosp_up"], f"SELECT {PROSPECT_SEL} FROM prosp_up"),
    "tenant_restrict": build(["prosp_all", "fetched"], """
SELECT prospect_id, organiser_Id FROM prosp_all WHERE organiser_Id IN (SELECT organiser_Id FROM fetched)"""),
    "contact_explode": build(["prosp_all", "fx_contacts"], """
SELECT p.organiser_Id, p.prospect_id, c.contact_id AS SF_Id, c.email, c.name AS Name, c.lead_source AS Source,
       p.opportunity_Id
FROM prosp_all p JOIN fx_contacts c ON c.o_orderkey = p.o_orderkey"""),
    "lead_contact_union": build(["lc_all"], """
SELECT organiser_Id, prospect_id, recordType, SF_Id, email, Source, opportunity_Id, IsWon, IsClosed,
       CAST(make_timestamp(created_s * 1000000) AS DATE) AS record_created_date,
       created_s AS record_created_timestamp, modified_s AS LastSFModifiedDate
FROM lc_all"""),
    "fx_normalise": build(["fxn_all"], """
SELECT organiser_Id, prospect_id, recordType, SF_Id, opportunity_Currency, target_currency, conversion_rate,
       amount_fx AS opportunity_Amount
FROM fxn_all"""),
    "attribution_join": build(["fan_all"], """
SELECT organiser_Id, prospect_id, recordType, SF_Id, email, communities_id, event_id, matched_registrations
FROM fan_all"""),
    "touch_point": build(["att_all"], "SELECT organiser_Id, prospect_id, recordType, SF_Id, touch_point FROM att_all"),
    "contact_touchpoint": build(["att_all"], """
SELECT organiser_Id, prospect_id, recordType, SF_Id, initLoginAt, touchpoint_timestamp, touchpoint_date,
       load_timestamp FROM att_all"""),
    "contact_latest": build(["contacts_all"], f"SELECT {CONTACT_SEL} FROM contacts_all"),
    "contact_upsert": _upsert("contacts_b0", "contacts_b1", ["SF_Id", "organiser_Id"], CONTACT_SEL),
    "warehouse_append_latest": _upsert("contacts_b0", "contacts_b1", ["SF_Id", "organiser_Id"], CONTACT_SEL),
    "warehouse_append_only": build(["contacts_b0", "contacts_b1"],
                                   f"SELECT {CONTACT_SEL} FROM contacts_b0 UNION ALL SELECT {CONTACT_SEL} FROM contacts_b1"),
    "opportunity_latest": build(["opp_all"], "SELECT * FROM opp_all"),
    "opportunity_upsert": _upsert("opp_b0", "opp_b1", ["opportunity_Id", "organiser_Id"], "*"),
    "event_top_amount": build(["top_all"], """
SELECT organiser_Id, event_id, opportunity_Id, SF_Id, opportunity_Amount, ClosedWon FROM top_all"""),
    "event_opportunity_metrics": build(["top_all"], f"""
SELECT organiser_Id, event_id, ClosedWon, count(DISTINCT opportunity_Id) AS cnt_opportunity,
       sum(CAST(opportunity_Amount AS {MONEY})) AS amt_opportunity
FROM top_all GROUP BY organiser_Id, event_id, ClosedWon"""),
    "event_opportunity_pivot": build(["piv_all"], "SELECT * FROM piv_all"),
    "event_lead_count": build(["leads_all"], "SELECT * FROM leads_all"),
    "event_attendance": build(["att_metrics"], "SELECT * FROM att_metrics"),
    "event_keys_union": build(["keys_all"], "SELECT * FROM keys_all"),
    "event_funnel": build(["funnel_all"], f"SELECT {FUNNEL_SEL} FROM funnel_all"),
    "event_funnel_upsert": _upsert("funnel_b0", "funnel_b1", ["event_id", "organiser_Id"], FUNNEL_SEL),
    "sync_route": build(["fetched", "disabled"], """
SELECT organiser_Id, 'erase' AS route FROM disabled UNION ALL SELECT organiser_Id, 'recompute' FROM fetched"""),
    "tenant_erasure": _erasure(),
    "event_funnel_keep": _funnel_keep(),
    "cdc_dotted_patches": build(["ins_all", "pl_all"], """
SELECT b._id, coalesce(p.event_id, b.event_id) AS event_id, b.exhibitor_id, CASE WHEN p.firstName IS NULL THEN b.firstName END AS firstName, b.lastName,
       coalesce(p.initLoginAt, b.initLoginAt) AS initLoginAt, coalesce(p.isLoggedIn, b.isLoggedIn) AS isLoggedIn, b.localCreatedAt,
       b.organiser_id, CASE WHEN p.source IS NULL THEN b.source END AS source, b.speaker_id, b.userId, b.bucket
FROM ins_all b LEFT JOIN pl_all p ON p._id = b._id AND p.bucket = b.bucket"""),
    "time_forms": """
SELECT o_orderkey, o_orderkey % 13 AS form,
       CASE WHEN o_orderkey % 13 = 12 THEN NULL WHEN o_orderkey % 13 = 3 THEN s - s % 86400
            WHEN o_orderkey % 13 IN (2, 6, 8, 10) THEN s - s % 60 ELSE s END AS seconds
FROM (SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 + o_orderkey % 86400 AS s FROM orders)""",
    "message_fates": build(["msg_fates"], "SELECT decoder, fate, reason, count(*) AS n FROM msg_fates GROUP BY decoder, fate, reason"),
    "dead_letter_table": build(["msg_fates"], """
SELECT topic, "partition", "offset", decoder, reason, fate = 'kept' AS kept, organiser_Id
FROM msg_fates WHERE decoder <> 'notices' AND (fate = 'rejected' OR (fate = 'kept' AND reason IS NOT NULL))"""),
    "state_two_writers": build(["ur_e1_f2"], f"SELECT {UC} FROM ur_e1_f2"),
    "stream_sync_tables": build(["prosp_all", "areg", "contacts_all", "opp_all", "funnel_all", "disabled", "fetched"],
                                "\nUNION ALL\n".join(
        [f"SELECT '{n}' AS table_name, organiser_Id, count(*) AS n_rows FROM {t} WHERE organiser_Id NOT IN (SELECT organiser_Id FROM disabled) "
         "GROUP BY organiser_Id" for n, t in (("prospects", "prosp_all"), ("user_registrations", "areg"))]
        + [f"SELECT '{n}', organiser_Id, count(*) FROM {t} WHERE organiser_Id IN (SELECT organiser_Id FROM fetched) GROUP BY organiser_Id"
           for n, t in (("contacts", "contacts_all"), ("opportunities", "opp_all"), ("event_agg", "funnel_all"))]
        + ["SELECT 'notices', organiser_Id, 2 FROM fetched"])),
    "completion_notice": build(["fetched"], f"""
SELECT organiser_Id, '{{"context":{{"oId":' || CAST(organiser_Id AS VARCHAR)
       || ',"eId":0,"action":"ORGANISER_SF_DATA_PROCESSING_COMPLETED","actor":"SYSTEM"}},"timeStamp":{NOW}}}' AS value
FROM fetched"""),
    "stream_sync_gate": build(["funnel_all", "fetched"], f"""
SELECT {FUNNEL_SEL} FROM funnel_all WHERE organiser_Id IN (SELECT organiser_Id FROM fetched)"""),
}
