"""Registered queries for intake, records and lifecycle tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import lifecycle as L
from ..operators import scoring as S
from ..operators import screening as W
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import intake as I
from ..sources import reps
from ..sources import sinks as K
from . import oracle_rules as O
from .oracle import with_tables
from .registry import AS_OF, SQL_AS_OF, register
from .registry_rules import END

_K = "CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT)"
PAYLOAD_FIELDS = [f for f in I.LEAD_FIELDS if f in (
    "source_channel", "source_campaign", "form_type", "first_name", "last_name", "email", "phone",
    "linkedin_url", "company", "job_title", "company_size", "industry", "country", "message")]


def _k():
    return F.substring_index(F.col("lead_id"), "-", -1).cast("long")


def payloads(s, d):
    """Form bodies as JSON text: every 23rd lacks an email, every 7th lacks channel / form /
    opt-in (defaults apply), every 13th names an unknown channel (invalid)."""
    k = _k()
    cols = []
    for f in PAYLOAD_FIELDS:
        c = F.col(f)
        if f == "email":
            c = F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(c)
        if f in ("source_channel", "form_type"):
            c = F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(c)
        if f == "source_channel":
            c = F.when(k % 13 == 0, F.lit("carrier_pigeon")).otherwise(c)
        cols.append(c.alias(f))
    cols.append(F.when(k % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.col("opt_in_marketing"))
                .alias("opt_in_marketing"))
    return fx.raw_leads(s, d).select("lead_id", F.to_json(F.struct(*cols)).alias("payload"))


def _payload_field_sql(f: str) -> str:
    if f == "email":
        return f"CASE WHEN {_K} % 23 = 0 THEN NULL ELSE email END"
    if f == "source_channel":
        return f"CASE WHEN {_K} % 13 = 0 THEN 'carrier_pigeon' WHEN {_K} % 7 = 0 THEN NULL ELSE source_channel END"
    if f == "form_type":
        return f"CASE WHEN {_K} % 7 = 0 THEN NULL ELSE form_type END"
    return f


def _parsed_sql() -> str:
    sel = [f"{_payload_field_sql(f)} AS {f}" if f in PAYLOAD_FIELDS else f"CAST(NULL AS VARCHAR) AS {f}"
           for f in I.LEAD_FIELDS]
    return (f"SELECT lead_id, {', '.join(sel)}, CAST(NULL AS VARCHAR[]) AS interests, "
            f"CASE WHEN {_K} % 7 = 0 THEN NULL ELSE opt_in_marketing END AS opt_in_marketing, "
            f"CAST(NULL AS VARCHAR) AS page_load_time FROM raw_leads")


register("lead_intake", with_tables(f"""
SELECT * FROM ({_parsed_sql()}) p WHERE email IS NOT NULL AND email <> ''
""", "raw_leads"))(lambda s, d: I.parse_payloads(payloads(s, d), keep=["lead_id"]))

_DEFAULTED = f"""
SELECT lead_id, {', '.join(
    'coalesce(source_channel, ' + "'web_form') AS source_channel" if f == 'source_channel' else
    'coalesce(form_type, ' + "'contact_us') AS form_type" if f == 'form_type' else
    'coalesce(country, ' + "'US') AS country" if f == 'country' else f for f in I.LEAD_FIELDS)},
  coalesce(interests, []::VARCHAR[]) AS interests, coalesce(opt_in_marketing, true) AS opt_in_marketing,
  page_load_time
FROM ({_parsed_sql()}) p WHERE email IS NOT NULL AND email <> ''
"""
register("intake_defaults", with_tables(_DEFAULTED, "raw_leads"))(
    lambda s, d: I.apply_defaults(I.parse_payloads(payloads(s, d), keep=["lead_id"])))


def _invalid(s, d):
    parsed = payloads(s, d).select("lead_id", F.from_json("payload", I.LEAD_SCHEMA).alias("_p")).select(
        "lead_id", "_p.*")
    _, bad = I.split_valid(I.apply_defaults(parsed))
    return bad.select("lead_id", "source_channel", "form_type", "errors")


register("intake_invalid", with_tables(f"""
SELECT lead_id, source_channel, form_type, errors FROM (
  SELECT lead_id, source_channel, form_type, list_filter([
    CASE WHEN email IS NULL OR email = '' THEN 'email_required' END,
    CASE WHEN source_channel NOT IN {O.lst(I.SOURCE_CHANNELS)} THEN 'invalid_source_channel' END,
    CASE WHEN form_type NOT IN {O.lst(I.FORM_TYPES)} THEN 'invalid_form_type' END], lambda x: x IS NOT NULL) AS errors
  FROM (SELECT lead_id, email, coalesce(source_channel, 'web_form') AS source_channel,
               coalesce(form_type, 'contact_us') AS form_type FROM ({_parsed_sql()}) p0) p1
) p2 WHERE len(errors) > 0
""", "raw_leads"))(_invalid)


def _gid(prefix: str, ts_sql: str, key_sql: str) -> str:
    return f"'{prefix}-' || strftime({ts_sql}, '%Y%m%d') || '-' || upper(substr(sha256({key_sql}), 1, 8))"


register("gen_ids", with_tables(f"""
SELECT lead_id, {_gid('LD', 'created_at', 'lead_id')} AS ld_id, {_gid('MQL', SQL_AS_OF, 'lead_id')} AS mql_id,
       {_gid('EVT', SQL_AS_OF, "lead_id || '|' || '1'")} AS evt_id
FROM raw_leads
""", "raw_leads"))(lambda s, d: fx.raw_leads(s, d).select(
    "lead_id", L.gen_id("LD", F.col("created_at"), "lead_id").alias("ld_id"),
    L.gen_id("MQL", F.lit(AS_OF).cast("timestamp"), "lead_id").alias("mql_id"),
    L.gen_id("EVT", F.lit(AS_OF).cast("timestamp"), "lead_id", F.lit("1")).alias("evt_id")))


def _raw_append(s, d):
    leads = I.apply_defaults(I.parse_payloads(payloads(s, d), keep=["lead_id"]))
    return K.to_raw_leads(leads.withColumnRenamed("lead_id", "source_key"), AS_OF, key_col="source_key")


def _raw_append_sql() -> str:
    js = "to_json(struct_pack(" + ", ".join(f"{f} := {f}" for f in K.RECORD_FIELDS) + "))"
    return with_tables(f"""
SELECT {_gid('LD', SQL_AS_OF, 'lead_id')} AS lead_id, upper(sha256(lead_id)) AS lead_key, {SQL_AS_OF} AS created_at, {SQL_AS_OF} AS updated_at,
  {', '.join(K.RECORD_FIELDS)}, 'new' AS status, CAST(NULL AS VARCHAR) AS rejection_reason, {js} AS raw_payload
FROM ({_DEFAULTED}) x
""", "raw_leads")


register("raw_lead_append", _raw_append_sql())(_raw_append)

_MP = O.mql_parts()
_BP = O.bant_parts()
_EMP = O.company_employees()


def mql_scored(s, d):
    """Scored leads with what an agent's answer adds; every 5th lead's answer names no confidence, every 3rd no technologies."""
    k = _k()
    leads = fx.raw_leads(s, d)
    emp = F.regexp_extract("company_size", r"^([0-9]+)", 1).try_cast("int")
    sc = S.score_mql(leads, keep=["lead_id", "company", "industry", "form_type", "company_size"])
    return sc.select(
        "lead_id", "score_breakdown", "mql_score", "qualified", F.col("company").alias("enriched_company"),
        F.col("industry").alias("enriched_industry"), emp.alias("enriched_employees"),
        F.when(emp >= 1000, "$100M+").alias("enriched_revenue"),
        F.when(k % 3 == 1, F.array(F.lit("Spark"), F.lit("Delta"))).when(k % 3 == 2, F.array(F.lit("Python"))).alias("technologies_used"),
        F.when(k % 2 == 0, "Technical_Buyer").otherwise("Economic_Buyer").alias("persona"),
        F.when(k % 2 == 0, "decision").otherwise("consideration").alias("buying_stage"),
        F.array("form_type").alias("product_interest"),
        F.concat(F.lit("Score "), F.col("mql_score").cast("string")).alias("agent_reasoning"),
        F.when(k % 5 != 0, (32 + k % 33) / F.lit(64.0)).alias("confidence_score"),
        F.when(emp >= 1000, "enterprise_track").otherwise("smb_track").alias("nurture_track"))


register("mql_append", with_tables(f"""
SELECT {_gid('MQL', SQL_AS_OF, 'lead_id')} AS mql_id, upper(sha256(lead_id)) AS mql_key, lead_id,
  {SQL_AS_OF} AS created_at, {SQL_AS_OF} AS updated_at, {SQL_AS_OF} AS qualified_at, mql_score,
  to_json(struct_pack({', '.join(f'{p} := {p}' for p in S.MQL_PARTS)})) AS score_breakdown,
  company AS enriched_company, ind AS enriched_industry, emp AS enriched_employees,
  CASE WHEN emp >= 1000 THEN '$100M+' END AS enriched_revenue,
  CASE k % 3 WHEN 1 THEN ['Spark', 'Delta'] WHEN 2 THEN ['Python'] ELSE []::VARCHAR[] END AS technologies_used,
  CASE WHEN k % 2 = 0 THEN 'Technical_Buyer' ELSE 'Economic_Buyer' END AS persona,
  CASE WHEN k % 2 = 0 THEN 'decision' ELSE 'consideration' END AS buying_stage, [ft] AS product_interest,
  []::VARCHAR[] AS pain_points, '1.0.0' AS agent_version, 'Score ' || mql_score AS agent_reasoning,
  CASE WHEN k % 5 <> 0 THEN (32 + k % 33) / 64.0 ELSE 0.8 END AS confidence_score, false AS human_reviewed,
  'mql_new' AS status, CASE WHEN emp >= 1000 THEN 'enterprise_track' ELSE 'smb_track' END AS nurture_track
FROM (SELECT lead_id, {_K} AS k, company, raw_leads.industry AS ind, raw_leads.form_type AS ft,
             CAST(regexp_extract(raw_leads.company_size, '^([0-9]+)', 1) AS INTEGER) AS emp,
             {', '.join(f'CAST({_MP[p]} AS INTEGER) AS {p}' for p in S.MQL_PARTS)},
             CAST({' + '.join(_MP[p] for p in S.MQL_PARTS)} AS INTEGER) AS mql_score FROM raw_leads) m
WHERE mql_score >= 50
""", "raw_leads"))(lambda s, d: K.to_mql_leads(mql_scored(s, d), AS_OF))


def sql_scored(s, d):
    """BANT-scored leads with what an agent's answer adds."""
    k = _k()
    return S.score_bant(fx.raw_leads(s, d), as_of=AS_OF, keep=["lead_id", "company"]).select(
        "*", F.concat(F.lit("Evaluation at "), F.coalesce("company", F.lit("unknown"))).alias("use_case_summary"),
        F.when(k % 4 == 0, "incumbent vendor").alias("competitive_context"),
        F.when(F.col("estimated_deal_size") == "$200K+", "executive_briefing").otherwise("discovery_call").alias("next_step"),
        F.when(k % 7 != 0, F.concat(F.lit("BANT "), F.col("sql_score").cast("string"))).alias("agent_reasoning"),
        F.when(k % 5 != 0, (32 + k % 33) / F.lit(64.0)).alias("confidence_score"))


register("sql_lead_append", with_tables(f"""
WITH av AS (SELECT rep_id, concat_ws(' ', first_name, last_name) AS name, email, team, current_load FROM sales_reps
            WHERE is_active AND current_load < max_load),
bt AS (SELECT team, arg_min(av, (current_load, rep_id)) AS r FROM av GROUP BY team),
ba AS (SELECT arg_min(av, (current_load, rep_id)) AS r FROM av)
SELECT {_gid('SQL', SQL_AS_OF, 'lead_id')} AS sql_id, upper(sha256(lead_id)) AS sql_key,
  {_gid('MQL', SQL_AS_OF, 'lead_id')} AS mql_id, upper(sha256(lead_id)) AS mql_key, lead_id,
  {SQL_AS_OF} AS created_at, {SQL_AS_OF} AS updated_at, {SQL_AS_OF} AS qualified_at, total AS sql_score,
  b AS bant_score_budget, a AS bant_score_authority, n AS bant_score_need, t AS bant_score_timeline, deal AS estimated_deal_size,
  CAST(CAST({SQL_AS_OF} AS DATE) + CAST(CASE t WHEN 25 THEN 30 WHEN 20 THEN 90 WHEN 10 THEN 180
       WHEN 5 THEN 365 END AS INTEGER) AS DATE) AS estimated_close_date,
  'Evaluation at ' || coalesce(company, 'unknown') AS use_case_summary,
  CASE WHEN k % 4 = 0 THEN 'incumbent vendor' END AS competitive_context,
  CASE WHEN deal = '$200K+' THEN 'executive_briefing' ELSE 'discovery_call' END AS next_step, x.assigned_team,
  coalesce(bt.r, ba.r).rep_id AS assigned_rep_id, coalesce(bt.r, ba.r).name AS assigned_rep_name,
  coalesce(bt.r, ba.r).email AS assigned_rep_email,
  CASE WHEN bt.r IS NOT NULL THEN 'team' WHEN ba.r IS NOT NULL THEN 'fallback_any_team' ELSE 'no_rep_available' END AS assignment_reason,
  '1.0.0' AS agent_version, CASE WHEN k % 7 <> 0 THEN 'BANT ' || total END AS agent_reasoning,
  CASE WHEN k % 5 <> 0 THEN (32 + k % 33) / 64.0 ELSE 0.8 END AS confidence_score,
  'sql_new' AS status, false AS handoff_confirmed
FROM (SELECT *, b + a + n + t AS total,
        CASE WHEN emp >= 1000 AND n >= 15 THEN '$200K+' WHEN emp >= 1000 THEN '$50K-$200K'
             WHEN emp >= 200 THEN '$10K-$50K' ELSE '<$10K' END AS deal,
        CASE WHEN emp >= 1000 THEN 'enterprise_sales' WHEN emp >= 200 THEN 'mid_market_sales' ELSE 'smb_sales' END AS assigned_team
      FROM (SELECT lead_id, {_K} AS k, company, {_EMP} AS emp, CAST({_BP['budget']} AS INTEGER) AS b,
                   CAST({_BP['authority']} AS INTEGER) AS a, CAST({_BP['need']} AS INTEGER) AS n,
                   CAST({_BP['timeline']} AS INTEGER) AS t FROM raw_leads) y) x
LEFT JOIN bt ON bt.team = x.assigned_team CROSS JOIN ba
WHERE total >= 70
""", "raw_leads", "sales_reps"))(lambda s, d: K.to_sql_leads(sql_scored(s, d), AS_OF, fx.sales_reps(s, d)))


# ----------------------------------------------------------------- S9, S10, S13, S14

def status_updates(s, d):
    """Triage outcome 30 s after capture, and for every 4th lead a later move to ``mql``."""
    t = S.triage_leads(fx.raw_leads(s, d), keep=["lead_id", "created_at"])
    first = t.select("lead_id", F.col("triage_status").alias("status"),
                     F.col("triage_reason").alias("rejection_reason"),
                     F.timestamp_add("SECOND", F.lit(30), F.col("created_at")).alias("updated_at"))
    k = _k()
    second = t.filter(k % 4 == 0).select("lead_id", F.lit("mql").alias("status"),
                                          F.lit(None).cast("string").alias("rejection_reason"),
                                          F.timestamp_add("SECOND", F.lit(600), F.col("created_at")).alias("updated_at"))
    return first.unionByName(second)


_SPAM_T = O.spam_keyword(keywords=S.DEFAULT["scoring"]["triage_spam_keywords"])
_TRIAGE_REASON = (f"CASE WHEN {O.blank('email')} THEN 'invalid_email' WHEN {O.blank('company')} THEN "
                  f"'incomplete_data' WHEN {_SPAM_T} IS NOT NULL THEN 'spam' END")
UPDATES_SQL = f"""
SELECT lead_id, CASE WHEN ({_TRIAGE_REASON}) IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS status,
       {_TRIAGE_REASON} AS rejection_reason, created_at + INTERVAL 30 SECOND AS updated_at FROM raw_leads
UNION ALL
SELECT lead_id, 'mql', NULL, created_at + INTERVAL 600 SECOND FROM raw_leads WHERE {_K} % 4 = 0
"""

# the reason is that of the last update that gave one
LATEST_SQL = f"""
SELECT lead_id, arg_max(status, ROW(updated_at, status)) AS status, max(updated_at) AS updated_at,
       arg_max(rejection_reason, ROW(updated_at, status)) FILTER (WHERE rejection_reason IS NOT NULL) AS reason
FROM ({UPDATES_SQL}) u0 GROUP BY lead_id
"""

register("status_update", with_tables(f"""
SELECT r.lead_id, coalesce(u.status, r.status) AS status,
       coalesce(u.reason, r.rejection_reason) AS rejection_reason,
       coalesce(u.updated_at, r.updated_at) AS updated_at
FROM raw_leads r LEFT JOIN (
  {LATEST_SQL}) u
  ON r.lead_id = u.lead_id
""", "raw_leads"))(lambda s, d: L.apply_status_updates(
    fx.raw_leads(s, d).select("lead_id", "status", "rejection_reason", "updated_at"), status_updates(s, d)))

register("lead_lookup", with_tables("""
SELECT * FROM raw_leads WHERE lead_id IN (SELECT lead_id FROM sql_leads)
""", "raw_leads", "sql_leads"))(lambda s, d: L.lead_by_id(fx.raw_leads(s, d), fx.sql_leads(s, d)))

register("mql_lookup", with_tables("""
SELECT * FROM mql_leads WHERE mql_id IN (SELECT mql_id FROM sql_leads)
""", "mql_leads", "sql_leads"))(lambda s, d: L.lead_by_id(fx.mql_leads(s, d), fx.sql_leads(s, d), key="mql_id"))

register("audit_retention", with_tables(f"""
SELECT * FROM lead_events WHERE event_timestamp >= {SQL_AS_OF} - INTERVAL 365 DAY
""", "lead_events"))(lambda s, d: K.audit_window(fx.lead_events(s, d), "event_timestamp", AS_OF, 365))


def _snapshots(s, d):
    leads = fx.raw_leads(s, d).select("lead_id", "status", "rejection_reason", "updated_at", "email")
    k = _k()
    old = leads.filter(k % 19 != 0)
    new = L.apply_status_updates(leads, status_updates(s, d)).filter(k % 17 != 0)
    return L.snapshot_diff(old, new)


register("snapshot_diff", with_tables(f"""
WITH upd AS (
  SELECT r.lead_id, coalesce(u.status, r.status) AS status, coalesce(u.reason, r.rejection_reason) AS rr,
         coalesce(u.updated_at, r.updated_at) AS ua, r.email
  FROM raw_leads r LEFT JOIN (
    {LATEST_SQL}) u
    ON r.lead_id = u.lead_id
  WHERE {_K.replace('lead_id', 'r.lead_id')} % 17 <> 0
),
old AS (SELECT lead_id, status, rejection_reason AS rr, updated_at AS ua, email FROM raw_leads WHERE {_K} % 19 <> 0)
SELECT coalesce(o.lead_id, n.lead_id) AS lead_id,
  CASE WHEN o.lead_id IS NULL THEN 'insert' WHEN n.lead_id IS NULL THEN 'delete' ELSE 'update' END AS change
FROM old o FULL OUTER JOIN upd n ON o.lead_id = n.lead_id
WHERE o.lead_id IS NULL OR n.lead_id IS NULL
   OR o.status IS DISTINCT FROM n.status OR o.rr IS DISTINCT FROM n.rr OR o.ua IS DISTINCT FROM n.ua
   OR o.email IS DISTINCT FROM n.email
""", "raw_leads"))(_snapshots)


# ----------------------------------------------------------------- S15

def mql_answers(s, d):
    """Agent answers as JSON text: every 11th missing, the next malformed, the next with an
    out-of-range score; others carry the rule scores."""
    sc = S.score_mql(fx.raw_leads(s, d), keep=["lead_id"])
    k = _k()
    body = F.to_json(F.struct("lead_id", "qualified", "mql_score",
                              F.when(k % 11 == 3, F.lit(1.5)).otherwise(F.lit(0.75)).alias("confidence_score"),
                              F.lit("technical_buyer").alias("persona")))
    ans = (F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 11 == 1, F.lit("{not json"))
           .when(k % 11 == 2, F.regexp_replace(body, r'"mql_score":\d+', '"mql_score":150'))
           .otherwise(body))
    return sc.select("lead_id", ans.alias("answer"))


register("parse_mql_results", with_tables(f"""
SELECT lead_id,
  CASE WHEN ok THEN q ELSE false END AS qualified, CASE WHEN ok THEN sc ELSE 0 END AS mql_score,
  CASE WHEN ok THEN persona ELSE 'unknown' END AS persona,
  CASE WHEN ok THEN stage ELSE 'awareness' END AS buying_stage,
  CASE WHEN ok THEN coalesce(conf, 0.8) ELSE 0.5 END AS confidence_score,
  NOT ok AS used_fallback, len(errs) = 0 AS valid, errs AS errors
FROM (
  SELECT *, list_filter([
    CASE WHEN ok AND q IS NULL THEN 'qualified_required' END,
    CASE WHEN ok AND (sc IS NULL OR sc NOT BETWEEN 0 AND 100) THEN 'mql_score_out_of_range' END,
    CASE WHEN ok AND conf IS NOT NULL AND conf NOT BETWEEN 0.0 AND 1.0 THEN 'confidence_out_of_range' END],
    lambda x: x IS NOT NULL) AS errs
  FROM (
    SELECT lead_id, coalesce(answer IS NOT NULL AND json_valid(answer), false) AS ok,
      TRY_CAST(CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.qualified') END AS BOOLEAN) AS q,
      TRY_CAST(CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.mql_score') END AS INTEGER) AS sc,
      CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.persona') END AS persona,
      CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.buying_stage') END AS stage,
      TRY_CAST(CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.confidence_score') END AS DOUBLE) AS conf
    FROM (
      SELECT lead_id, CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 11 = 1 THEN '{{not json'
        ELSE '{{"lead_id":"' || lead_id || '","qualified":' || CASE WHEN mql_score >= 50 THEN 'true' ELSE 'false' END
             || ',"mql_score":' || CASE WHEN {_K} % 11 = 2 THEN '150' ELSE CAST(mql_score AS VARCHAR) END
             || ',"confidence_score":' || CASE WHEN {_K} % 11 = 3 THEN '1.5' ELSE '0.75' END
             || ',"persona":"technical_buyer"}}' END AS answer
      FROM (SELECT lead_id, CAST({' + '.join(_MP[p] for p in S.MQL_PARTS)} AS INTEGER) AS mql_score FROM raw_leads) m
    ) a
  ) b
) c
""", "raw_leads"))(lambda s, d: I.parse_mql_results(mql_answers(s, d)))


def _spoilt(body, k):
    """Every 11th answer missing, the next malformed."""
    return F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 11 == 1, F.lit("{not json")).otherwise(body)


def triage_answers(s, d):
    """Triage answers as JSON text with the rule decision; some missing, malformed or out of range."""
    t, k = S.triage_leads(fx.raw_leads(s, d), keep=["lead_id"]), _k()
    body = F.to_json(F.struct(
        F.when(k % 11 == 2, F.lit("maybe")).otherwise(F.col("decision")).alias("decision"),
        F.when(F.col("decision") == "accepted", "mql_agent").otherwise("none").alias("next_agent"),
        F.when(k % 11 != 4, F.lit("by rule")).alias("reasoning"), F.col("triage_reason").alias("rejection_reason"),
        F.when(k % 11 == 3, F.lit(1.5)).otherwise(F.lit(0.75)).alias("confidence")))
    return t.select("lead_id", _spoilt(body, k).alias("answer"))


_JSON_OK = "coalesce(answer IS NOT NULL AND json_valid(answer), false)"


def _field(name: str, kind: str = "VARCHAR") -> str:
    return f"TRY_CAST(CASE WHEN json_valid(answer) THEN json_extract_string(answer, '$.{name}') END AS {kind}) AS {name}"


register("parse_triage_results", with_tables(f"""
SELECT lead_id, CASE WHEN ok THEN decision ELSE 'needs_review' END AS decision,
  CASE WHEN ok THEN next_agent ELSE 'human_review' END AS next_agent,
  CASE WHEN ok THEN reasoning ELSE 'Agent did not return structured decision' END AS reasoning,
  CASE WHEN ok THEN rejection_reason END AS rejection_reason, CASE WHEN ok THEN confidence ELSE 0.5 END AS confidence,
  NOT ok AS used_fallback, len(errs) = 0 AS valid, errs AS errors
FROM (
  SELECT *, list_filter([
    CASE WHEN ok AND (decision IS NULL OR decision NOT IN {O.lst(I.TRIAGE_DECISIONS)}) THEN 'decision_invalid' END,
    CASE WHEN ok AND reasoning IS NULL THEN 'reasoning_required' END,
    CASE WHEN ok AND (confidence IS NULL OR confidence NOT BETWEEN 0.0 AND 1.0) THEN 'confidence_out_of_range' END],
    lambda x: x IS NOT NULL) AS errs
  FROM (SELECT lead_id, {_JSON_OK} AS ok, {_field('decision')}, {_field('next_agent')}, {_field('reasoning')},
               {_field('rejection_reason')}, {_field('confidence', 'DOUBLE')}
        FROM (SELECT lead_id, CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 11 = 1 THEN '{{not json' ELSE to_json(struct_pack(
                decision := CASE WHEN {_K} % 11 = 2 THEN 'maybe' WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END,
                next_agent := CASE WHEN reason IS NULL THEN 'mql_agent' ELSE 'none' END,
                reasoning := CASE WHEN {_K} % 11 <> 4 THEN 'by rule' END, rejection_reason := reason,
                confidence := CASE WHEN {_K} % 11 = 3 THEN 1.5 ELSE 0.75 END))::VARCHAR END AS answer
              FROM (SELECT lead_id, {_TRIAGE_REASON} AS reason FROM raw_leads) m) a) b) c
""", "raw_leads"))(lambda s, d: I.parse_triage_results(triage_answers(s, d)))


def bant_answers(s, d):
    """BANT answers as JSON text with the rule scores; some missing, malformed or out of range."""
    b, k = S.score_bant(fx.raw_leads(s, d), as_of=AS_OF, keep=["lead_id"]), _k()
    body = F.to_json(F.struct(
        F.when(k % 11 != 4, F.col("qualified")).alias("qualified"), "sql_score",
        F.when(k % 11 == 2, F.lit(26)).otherwise(F.col("bant_score_budget")).alias("bant_score_budget"),
        "bant_score_authority", "bant_score_need", F.when(k % 11 != 5, F.col("bant_score_timeline")).alias("bant_score_timeline"),
        F.lit("by rule").alias("agent_reasoning"), F.when(k % 11 == 3, F.lit(1.5)).when(k % 11 != 6, F.lit(0.75)).alias("confidence_score")))
    return b.select("lead_id", _spoilt(body, k).alias("answer"))


register("parse_bant_results", with_tables(f"""
SELECT lead_id, CASE WHEN ok THEN qualified ELSE false END AS qualified,
  {', '.join(f'CASE WHEN ok THEN {f} ELSE 0 END AS {f}' for f in I.BANT_BOUNDS)},
  CASE WHEN ok THEN agent_reasoning ELSE 'Agent processing error' END AS agent_reasoning,
  CASE WHEN ok THEN coalesce(confidence_score, 0.8) ELSE 0.0 END AS confidence_score,
  NOT ok AS used_fallback, len(errs) = 0 AS valid, errs AS errors
FROM (
  SELECT *, list_filter([
    CASE WHEN ok AND qualified IS NULL THEN 'qualified_required' END,
    {', '.join(f"CASE WHEN ok AND ({f} IS NULL OR {f} NOT BETWEEN 0 AND {top}) THEN '{f}_out_of_range' END" for f, top in I.BANT_BOUNDS.items())},
    CASE WHEN ok AND confidence_score NOT BETWEEN 0.0 AND 1.0 THEN 'confidence_out_of_range' END],
    lambda x: x IS NOT NULL) AS errs
  FROM (SELECT lead_id, {_JSON_OK} AS ok, {_field('qualified', 'BOOLEAN')}, {', '.join(_field(f, 'INTEGER') for f in I.BANT_BOUNDS)},
               {_field('agent_reasoning')}, {_field('confidence_score', 'DOUBLE')}
        FROM (SELECT lead_id, CASE WHEN {_K} % 11 = 0 THEN NULL WHEN {_K} % 11 = 1 THEN '{{not json' ELSE to_json(struct_pack(
                qualified := CASE WHEN {_K} % 11 <> 4 THEN b + a + n + t >= 70 END, sql_score := b + a + n + t,
                bant_score_budget := CASE WHEN {_K} % 11 = 2 THEN 26 ELSE b END, bant_score_authority := a, bant_score_need := n,
                bant_score_timeline := CASE WHEN {_K} % 11 <> 5 THEN t END, agent_reasoning := 'by rule',
                confidence_score := CASE WHEN {_K} % 11 = 3 THEN 1.5 WHEN {_K} % 11 <> 6 THEN 0.75 END))::VARCHAR END AS answer
              FROM (SELECT lead_id, CAST({_BP['budget']} AS INTEGER) AS b, CAST({_BP['authority']} AS INTEGER) AS a,
                           CAST({_BP['need']} AS INTEGER) AS n, CAST({_BP['timeline']} AS INTEGER) AS t FROM raw_leads) m) a0) b0) c
""", "raw_leads"))(lambda s, d: I.parse_bant_results(bant_answers(s, d)))


def form_answers(s, d):
    """Form-stage answers beside the lead's fields and its rule screening; some missing, malformed, incomplete or out of range."""
    k = _k()
    sc = W.screen_leads(fx.raw_leads(s, d), end_col=END, keep=["lead_id", *I.FORM_NAMES])
    body = F.to_json(F.struct(
        F.upper("first_name").alias("normalized_first_name"), F.upper("last_name").alias("normalized_last_name"),
        F.coalesce("company", F.lit("")).alias("normalized_company"), F.coalesce("job_title", F.lit("")).alias("normalized_job_title"),
        F.col("industry").alias("normalized_industry"), F.when(k % 11 == 2, "burning").otherwise("high").alias("detected_intent"),
        F.when(k % 11 != 3, F.array(F.lit("budget"))).alias("intent_signals"), F.when(k % 11 == 4, 101).otherwise(F.col("bot_score")).alias("bot_risk_score"),
        F.lit("low").alias("bot_risk_level"), F.col("flags").alias("bot_risk_reasons"), F.col("quality_score").alias("lead_quality_score"),
        F.col("flags").alias("red_flags"), F.lit("accept").alias("recommendation")))
    return sc.select("lead_id", *I.FORM_NAMES, "bot_score", "flags", _spoilt(body, k).alias("answer"))


_FORM_OK = f"({_K} % 11 NOT IN (0, 1))"
register("parse_form_results", with_tables(f"""
SELECT lead_id, CASE WHEN ok THEN upper(first_name) ELSE coalesce(first_name, '') END AS normalized_first_name,
  CASE WHEN ok THEN upper(last_name) ELSE coalesce(last_name, '') END AS normalized_last_name,
  coalesce(company, '') AS normalized_company, coalesce(job_title, '') AS normalized_job_title,
  CASE WHEN ok THEN industry ELSE coalesce(industry, '') END AS normalized_industry,
  CASE WHEN NOT ok THEN 'unclear' WHEN k = 2 THEN 'burning' ELSE 'high' END AS detected_intent,
  CASE WHEN NOT ok THEN []::VARCHAR[] WHEN k <> 3 THEN ['budget'] END AS intent_signals,
  CAST(CASE WHEN ok AND k = 4 THEN 101 ELSE bot_score END AS INTEGER) AS bot_risk_score,
  CASE WHEN ok THEN 'low' ELSE {O.risk_level('bot_score')} END AS bot_risk_level, flags AS bot_risk_reasons,
  CAST(CASE WHEN ok THEN quality_score ELSE 50 END AS INTEGER) AS lead_quality_score, flags AS red_flags,
  CAST(NULL AS VARCHAR) AS enrichment_notes, CASE WHEN ok THEN 'accept' ELSE 'review' END AS recommendation,
  NOT ok AS used_fallback, k NOT IN (2, 3, 4) AS valid,
  CASE k WHEN 2 THEN ['detected_intent_invalid'] WHEN 3 THEN ['intent_signals_required'] WHEN 4 THEN ['bot_risk_score_out_of_range']
         ELSE []::VARCHAR[] END AS errors
FROM (SELECT lead_id, {_K} % 11 AS k, {_FORM_OK} AS ok, {', '.join(I.FORM_NAMES)}, {O.screen_select(end=END)} FROM raw_leads) x
""", "raw_leads"))(lambda s, d: I.parse_form_results(form_answers(s, d)))


# ----------------------------------------------------------------- S11

def _roster(s, d):
    """The roster as stored, as seeded, and as assumed where the table is missing."""
    base = f"{ensure_checkpoint_dir(s).rstrip('/')}/roster-{uuid.uuid4().hex}"
    fx.sales_reps(s, d).write.parquet(f"{base}/reps")
    cols = ["rep_id", "first_name", "last_name", "email", "team", "is_active", "current_load", "max_load"]
    kinds = {"stored": reps.load_reps(s, f"{base}/reps"), "seeded": reps.seed_reps(s), "assumed": reps.load_reps(s, f"{base}/none")}
    out = None
    for kind, df in kinds.items():
        own = df.select(F.lit(kind).alias("roster"), *cols)
        out = own if out is None else out.unionByName(own)
    return out


def _reps_sql(kind: str, rows: list) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS roster, " + ", ".join(f"'{v}' AS {c}" for c, v in zip(("rep_id", "first_name", "last_name", "email", "team"), r[:5]))
        + f", {r[7]} AS is_active, {r[8]}::INTEGER AS current_load, {r[9]}::INTEGER AS max_load" for r in rows)


register("rep_load", with_tables(f"""
SELECT 'stored' AS roster, rep_id, first_name, last_name, email, team, is_active, current_load, max_load FROM sales_reps
UNION ALL {_reps_sql('seeded', reps.SEED_REPS)} UNION ALL {_reps_sql('assumed', reps.FALLBACK_REPS)}
""", "sales_reps"))(_roster)


# ----------------------------------------------------------------- F6

register("lead_status_rows", with_tables("""
SELECT r.lead_id, r.status, r.email, r.company, e.event_id, e.event_type AS event, e.agent_name AS agent,
       e.from_status AS "from", e.to_status AS "to", e.score_at_event AS score, e.event_timestamp AS "timestamp"
FROM raw_leads r LEFT JOIN lead_events e ON r.lead_id = e.lead_id
""", "raw_leads", "lead_events"))(lambda s, d: L.lead_status_rows(fx.raw_leads(s, d), fx.lead_events(s, d)))


def _status_doc(s, d):
    leads = fx.raw_leads(s, d)
    ids = leads.select("lead_id")  # every lead's status document
    # the JSON text is what the status page serves; nested rows stay in ``timeline``
    return L.lead_status_doc(leads, fx.lead_events(s, d), ids).drop("timeline")


register("lead_status_doc", with_tables(f"""
SELECT lead_id, status, email, company, to_json(timeline) AS timeline_json FROM (
SELECT r.lead_id, r.status, r.email, r.company,
  list({{'event': e.event_type, 'agent': e.agent_name, 'from': e.from_status, 'to': e.to_status,
        'score': e.score_at_event, 'timestamp': CAST(e.event_timestamp AS VARCHAR)}}
       ORDER BY e.event_timestamp, e.event_id) AS timeline
FROM raw_leads r LEFT JOIN lead_events e ON r.lead_id = e.lead_id
GROUP BY r.lead_id, r.status, r.email, r.company) d
""", "raw_leads", "lead_events"))(_status_doc)
