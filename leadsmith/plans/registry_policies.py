"""Registered queries for the governance policies."""

from __future__ import annotations

import copy

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import spread
from ..operators import payloads as P2
from ..operators import policies as P
from ..operators import scoring as S
from ..operators import screening as W
from ..sources import fixtures as fx
from . import oracle_rules as O
from .oracle import TABLES, with_tables
from .registry import AS_OF, SQL_AS_OF, register

_CFG = DEFAULT["policies"]
_K = "CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT)"


def _k():
    return F.substring_index(F.col("lead_id"), "-", -1).cast("long")


# ----------------------------------------------------------------- P1, P2, P13

_CM = "CAST(round(cost_usd * 1000000) AS BIGINT)"
SPEND_SQL = f"""
SELECT call_id, lead_id, ts, cost_usd, CAST(run AS DOUBLE) / 1000000.0 AS run_cost_usd,
  CASE WHEN cm > 150000 THEN 'deny' WHEN run > 500000 THEN 'deny' WHEN run >= 400000 THEN 'warn'
       ELSE 'allow' END AS action,
  CASE WHEN cm > 150000 THEN 'per_call_limit' WHEN run > 500000 THEN 'per_run_limit' END AS reason
FROM (SELECT *, {_CM} AS cm,
             sum({_CM}) OVER (PARTITION BY lead_id ORDER BY ts, call_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
      FROM tool_calls) x
"""
register("spend_guard", with_tables(SPEND_SQL, "tool_calls"))(
    lambda s, d: P.spend_guard(fx.tool_calls(s, d)))

register("lead_spend", with_tables(f"""
SELECT lead_id, count(*) AS calls, CAST(sum({_CM}) AS DOUBLE) / 1000000.0 AS spend_usd
FROM tool_calls GROUP BY lead_id
""", "tool_calls"))(lambda s, d: P.lead_spend(fx.tool_calls(s, d)))


def _switch(s, d):
    cfg = copy.deepcopy(_CFG)
    cfg["enabled"]["spend_guard"] = False
    return P.spend_guard(fx.tool_calls(s, d), cfg)


register("policy_switch", with_tables("""
SELECT call_id, lead_id, ts, cost_usd, CAST(NULL AS DOUBLE) AS run_cost_usd, 'allow' AS action,
       CAST(NULL AS VARCHAR) AS reason FROM tool_calls
""", "tool_calls"))(_switch)


# ----------------------------------------------------------------- P3-P5

def _pii_hits(fields: list[str]) -> list[tuple[str, str, str, str, str]]:
    return [(f, t, p, sev, act) for f in fields for t, p, sev, act in _CFG["pii_patterns"]]


def _pii_array_sql(fields: list[str]) -> str:
    items = [f"CASE WHEN regexp_matches(coalesce(CAST({f} AS VARCHAR), ''), {O.q('(?i)' + p)}) THEN "
             f"{{'field': {O.q(f)}, 'pii_type': {O.q(t)}, 'severity': {O.q(sev)}, 'action': {O.q(act)}}} END"
             for f, t, p, sev, act in _pii_hits(fields)]
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


LEAD_PII_FIELDS = ["message", "first_name", "last_name", "company"]

register("pii_findings", with_tables(f"""
SELECT lead_id, f.field AS field, f.pii_type AS pii_type, f.severity AS severity, f.action AS action
FROM (SELECT lead_id, unnest({_pii_array_sql(LEAD_PII_FIELDS)}) AS f FROM raw_leads) x
""", "raw_leads"))(lambda s, d: P.pii_findings(fx.raw_leads(s, d)))

register("pii_documents", f"""
SELECT doc_id, f.field AS field, f.pii_type AS pii_type, f.severity AS severity, f.action AS action
FROM (SELECT doc_id, unnest({_pii_array_sql(['text'])}) AS f FROM documents) x
""")(lambda s, d: P.pii_findings(spread(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")),
                                 key="doc_id", fields=["text"]))

_RANK = "(CASE x.action WHEN 'deny' THEN 2 WHEN 'escalate' THEN 1 ELSE 0 END)"
register("pii_verdict", with_tables(f"""
SELECT lead_id,
  CASE WHEN len(list_filter(f, lambda x: x.severity <> 'low')) > 0 THEN
    CASE list_max(list_transform(f, lambda x: {_RANK})) WHEN 2 THEN 'deny' WHEN 1 THEN 'escalate' ELSE 'allow' END
  ELSE 'allow' END AS pii_action,
  len(list_filter(f, lambda x: x.severity <> 'low')) > 0 AS pii_triggered,
  list_transform(list_filter(f, lambda x: x.severity <> 'low'), lambda x: x.pii_type) AS pii_types
FROM (SELECT lead_id, {_pii_array_sql(LEAD_PII_FIELDS)} AS f FROM raw_leads) y
""", "raw_leads"))(lambda s, d: P.pii_verdict(fx.raw_leads(s, d)))


def _mask_sql(col: str) -> str:
    v = col
    for t, p, _, _ in _CFG["pii_patterns"]:
        v = f"regexp_replace({v}, {O.q('(?i)' + p)}, {O.q(f'[REDACTED:{t}]')}, 'g')"
    return v


register("pii_mask", with_tables(f"""
SELECT lead_id, {', '.join(f'{_mask_sql(c)} AS {c}' for c in LEAD_PII_FIELDS)} FROM raw_leads
""", "raw_leads"))(lambda s, d: P.pii_mask(fx.raw_leads(s, d).select("lead_id", *LEAD_PII_FIELDS)))

register("pii_mask_documents", f"""
SELECT doc_id, {_mask_sql('text')} AS text FROM documents
""")(lambda s, d: P.pii_mask(spread(s.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")),
                             fields=["text"]))


def nested_payloads(s, d):
    """Lead payloads as nested JSON: contact details, tags, a card number as a number for every 5th lead."""
    k = _k()
    card = F.when(k % 5 == 0, F.lit(4_000_000_000_000_000) + k)
    body = F.struct(F.struct("email", "phone").alias("contact"), F.array(F.col("message"), F.col("company")).alias("texts"),
                    F.struct(card.alias("card"), k.alias("order")).alias("billing"), (k % 2 == 0).alias("agreed"))
    return fx.raw_leads(s, d).select("lead_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("raw_payload"))


def _masked_payloads(s, d):
    m = P2.mask_payloads(nested_payloads(s, d))
    return m.select("lead_id", "raw_payload", F.size("pii_found").alias("n_found"), "payload_parsed")


def _hit_sql(col: str) -> str:
    """How many pattern kinds replace something in a column, the patterns one after another."""
    v, n = col, []
    for t, p, _, _ in _CFG["pii_patterns"]:
        n.append(f"CASE WHEN coalesce(regexp_matches({v}, {O.q('(?i)' + p)}), false) THEN 1 ELSE 0 END")
        v = f"regexp_replace({v}, {O.q('(?i)' + p)}, {O.q(f'[REDACTED:{t}]')}, 'g')"
    return "(" + " + ".join(n) + ")"


register("pii_mask_payload", with_tables(f"""
SELECT lead_id, to_json(struct_pack(
    contact := struct_pack(email := {_mask_sql('email')}, phone := {_mask_sql('phone')}), texts := [{_mask_sql('message')}, {_mask_sql('company')}],
    billing := struct_pack(card := CASE WHEN k % 5 = 0 THEN {_mask_sql('card')} END, "order" := k), agreed := k % 2 = 0)) AS raw_payload,
  CAST({' + '.join(_hit_sql(c) for c in ('email', 'phone', 'message', 'company', 'card'))} AS INTEGER) AS n_found, true AS payload_parsed
FROM (SELECT *, CASE WHEN k % 5 = 0 THEN CAST(4000000000000000 + k AS VARCHAR) END AS card
      FROM (SELECT *, CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT) AS k FROM raw_leads) x) y
""", "raw_leads"))(_masked_payloads)


# ----------------------------------------------------------------- P6

def approvals(s, d):
    """Operator answers to approval requests, derived from the lead key: k % 5 = 0 'no',
    1 'yes', 2 'Y', 3 '' (enter), 4 none; answered k % 200 seconds after the request."""
    k = _k()
    return (fx.lead_keys(s, d).filter(k % 5 != 4)
            .select("lead_id", F.when(k % 5 == 0, "no").when(k % 5 == 1, "yes").when(k % 5 == 2, "Y")
                    .otherwise("").alias("answer"),
                    F.timestamp_add("SECOND", (k % 200).cast("int"), F.col("created_at")).alias("answered_at")))


def _approval(s, d):
    scored = S.score_bant(fx.raw_leads(s, d), as_of=AS_OF, keep=["lead_id", "created_at"])
    q = scored.filter("qualified").select("lead_id", "created_at", "sql_score", "estimated_deal_size")
    return P.approval_gate(q, approvals(s, d), AS_OF, requested_col="created_at").select(
        "lead_id", "sql_score", "estimated_deal_size", "needs_approval", "approval_action",
        "approval_resolved_by")


def _approval_sql() -> str:
    bp = O.bant_parts()
    emp = O.company_employees()
    dl = "created_at + INTERVAL 120 SECOND"
    return with_tables(f"""
WITH sc AS (
  SELECT lead_id, created_at, b + a + n + t AS sql_score,
    CASE WHEN emp >= 1000 AND n >= 15 THEN '$200K+' WHEN emp >= 1000 THEN '$50K-$200K'
         WHEN emp >= 200 THEN '$10K-$50K' ELSE '<$10K' END AS estimated_deal_size
  FROM (SELECT lead_id, created_at, {emp} AS emp, {bp['budget']} AS b, {bp['authority']} AS a,
               {bp['need']} AS n, {bp['timeline']} AS t FROM raw_leads) x
  WHERE b + a + n + t >= 70
),
ap AS (
  SELECT lead_id, arg_min(answer, answered_at) AS answer, min(answered_at) AS answered_at FROM (
    SELECT lead_id, CASE {_K} % 5 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN 'Y' ELSE '' END AS answer,
           created_at + to_seconds(CAST({_K} % 200 AS INTEGER)) AS answered_at
    FROM raw_leads WHERE {_K} % 5 <> 4) a0 GROUP BY lead_id
)
SELECT sc.lead_id, sql_score, estimated_deal_size,
  (estimated_deal_size = '$200K+' OR sql_score < 60) AS needs_approval,
  CASE WHEN NOT (estimated_deal_size = '$200K+' OR sql_score < 60) THEN 'allow'
       WHEN answered_at IS NOT NULL AND answered_at <= {dl} AND lower(trim(coalesce(answer, ''))) IN ('y','yes','')
         THEN 'allow'
       WHEN answered_at IS NOT NULL AND answered_at <= {dl} THEN 'deny'
       WHEN {SQL_AS_OF} < {dl} THEN 'pending' ELSE 'allow' END AS approval_action,
  CASE WHEN NOT (estimated_deal_size = '$200K+' OR sql_score < 60) THEN 'not_required'
       WHEN answered_at IS NOT NULL AND answered_at <= {dl} THEN 'operator'
       WHEN {SQL_AS_OF} < {dl} THEN 'waiting' ELSE 'timeout' END AS approval_resolved_by
FROM sc LEFT JOIN ap ON sc.lead_id = ap.lead_id
""", "raw_leads")


register("approval_gate", _approval_sql())(_approval)


# ----------------------------------------------------------------- P7, P8

def _failures(s, d):
    return fx.tool_calls(s, d).filter(F.col("status") != "success")


register("retry_plan", with_tables("""
SELECT call_id, lead_id, agent, tool, ts, attempt,
  CASE WHEN attempt <= 1 THEN 'retry' ELSE 'escalate' END AS action,
  CASE WHEN attempt <= 1 THEN 2 * pow(2.0, attempt - 1) END AS delay_seconds
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lead_id, agent ORDER BY ts, call_id) AS INTEGER) AS attempt
      FROM tool_calls WHERE status <> 'success') x
""", "tool_calls"))(lambda s, d: P.retry_plan(_failures(s, d)))

AUDIT_INPUT = ["company", "email", "lead_id"]


def decisions(s, d):
    """Triage decisions with their reasoning (the rule flags) and a confidence."""
    sc = W.screen_leads(fx.raw_leads(s, d), end_col="created_at",
                        keep=["lead_id", "email", "company", "message", "first_name", "last_name",
                              "job_title", "form_type", "company_size", "phone", "linkedin_url",
                              "page_load_time", "created_at", "industry"])
    tri = S.triage_leads(sc)
    return tri.select("lead_id", "email", "company", F.lit("TriageAgent").alias("agent"),
                      "decision", F.array_join("flags", "; ").alias("reasoning"),
                      ((_k() % 101) / 100.0).alias("confidence"), F.col("created_at").alias("decided_at"))


def _audit_sql() -> str:
    spam = O.spam_keyword(keywords=DEFAULT["scoring"]["triage_spam_keywords"])
    js = " || ', ' || ".join(f"'\"{c}\": ' || coalesce(to_json({c}), 'null')" for c in sorted(AUDIT_INPUT))
    return with_tables(f"""
SELECT *, left(sha256(lead_id || '|' || agent || '|' || input_hash), 8) AS audit_id,
  CAST(0 AS BIGINT) AS duration_ms, 'unknown' AS llm_model, CAST(0 AS BIGINT) AS tokens_used
FROM (SELECT lead_id, created_at AS timestamp_utc, 'TriageAgent' AS agent,
  CASE WHEN {O.blank('email')} OR {O.blank('company')} OR {spam} IS NOT NULL THEN 'rejected' ELSE 'accepted' END
    AS decision,
  left(array_to_string(flags, '; '), 200) AS reasoning,
  CAST(trunc((({_K} % 101) / 100.0) * 100) AS INTEGER) AS confidence_pct,
  left(sha256('{{' || {js} || '}}'), 16) AS input_hash,
  {O.q(_CFG['policy_pack'])} AS policy_pack
FROM (SELECT *, {O.screen_select(end='created_at')} FROM raw_leads) x) y
""", "raw_leads")


register("decision_audit", _audit_sql())(
    lambda s, d: P.decision_audit(decisions(s, d), AUDIT_INPUT))


# ----------------------------------------------------------------- P9

DUP_SQL = with_tables("""
WITH RECURSIVE s AS (
  SELECT lead_id, created_at AS ts, lower(trim(email)) AS em FROM raw_leads
  WHERE email IS NOT NULL AND trim(email) <> ''
),
anchors(em, ts, lead_id) AS (
  SELECT em, min(ts), arg_min(lead_id, (ts, lead_id)) FROM s GROUP BY em
  UNION ALL
  SELECT a.em, min(s.ts), arg_min(s.lead_id, (s.ts, s.lead_id))
  FROM anchors a JOIN s ON s.em = a.em AND s.ts >= a.ts + INTERVAL 31 DAY GROUP BY a.em
)
SELECT s.lead_id, CASE WHEN s.lead_id = a.lead_id THEN 'allow' ELSE 'deny' END AS dup_action,
       a.lead_id AS anchor_id,
       CASE WHEN s.lead_id = a.lead_id THEN 0 ELSE date_sub('day', a.ts, s.ts) END AS days_since_anchor
FROM s ASOF JOIN anchors a ON s.em = a.em AND s.ts >= a.ts
UNION ALL
SELECT lead_id, 'allow', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT) FROM raw_leads
WHERE email IS NULL OR trim(email) = ''
""", "raw_leads")

register("duplicate_lookback", DUP_SQL)(lambda s, d: P.duplicate_lookback(fx.raw_leads(s, d)))
def hot_leads(s, d):
    """The leads with one email on every third of them."""
    return fx.raw_leads(s, d).withColumn("email", F.when(_k() % 3 == 0, "hot@corp.example").otherwise(F.col("email")))


def hot_sql(sql: str) -> str:
    """An oracle over the hot leads: the table's definition stays, its readers take the hot one."""
    hot = ("hot_leads AS (SELECT * REPLACE (CASE WHEN CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT) % 3 = 0 "
           "THEN 'hot@corp.example' ELSE email END AS email) FROM raw_leads),\n")
    head, tail = sql.split(TABLES["raw_leads"], 1)
    at = tail.index("),") + 2
    return head + TABLES["raw_leads"] + tail[:at] + "\n" + hot + tail[at:].replace("FROM raw_leads", "FROM hot_leads")


register("duplicate_lookback_hot", hot_sql(DUP_SQL))(lambda s, d: P.duplicate_lookback(hot_leads(s, d)))


# ----------------------------------------------------------------- P10-P12

def _expected_sql() -> str:
    rows = [(a, t) for a, ts_ in _CFG["expected_tools_per_agent"].items() for t in ts_]
    return "(VALUES " + ", ".join(f"({O.q(a)}, {O.q(t)})" for a, t in rows) + ") e(agent, tool)"


UNEXPECTED_SQL = f"""
SELECT call_id, lead_id, agent, tool, ts, 'escalate' AS action FROM tool_calls c
WHERE NOT EXISTS (SELECT 1 FROM {_expected_sql()} WHERE e.agent = c.agent AND e.tool = c.tool)
"""
register("unexpected_tools", with_tables(UNEXPECTED_SQL, "tool_calls"))(
    lambda s, d: P.unexpected_tools(fx.tool_calls(s, d), P.expected_tools(s)))

register("tool_access_map", with_tables("""
SELECT lead_id, agent, tool, count(*) AS calls, avg(duration_ms) AS avg_duration_ms,
  max(duration_ms) AS max_duration_ms, count_if(status <> 'success') AS errors,
  min(ts) AS first_call, max(ts) AS last_call
FROM tool_calls GROUP BY lead_id, agent, tool
""", "tool_calls"))(lambda s, d: P.tool_access_map(fx.tool_calls(s, d)))

register("tool_call_timeline", with_tables("""
SELECT lead_id, call_id, ts, agent, tool, status, duration_ms,
  CAST(row_number() OVER (PARTITION BY lead_id ORDER BY ts, call_id) AS INTEGER) AS seq
FROM tool_calls
""", "tool_calls"))(lambda s, d: P.tool_call_timeline(fx.tool_calls(s, d)))

CALL_LOG_SQL = f"""
SELECT lead_id, 'spend_guard' AS policy_id, action, ts FROM ({SPEND_SQL}) sg WHERE action = 'deny'
UNION ALL
SELECT lead_id, 'retry_fallback', CASE WHEN row_number() OVER (PARTITION BY lead_id, agent ORDER BY ts, call_id) <= 1
                                       THEN 'allow' ELSE 'escalate' END, ts
FROM tool_calls WHERE status <> 'success'
UNION ALL
SELECT lead_id, 'tool_transparency', action, ts FROM ({UNEXPECTED_SQL}) u
"""

#: Policy versions, in days from the first tool call: (policy, from, to, enabled).
VERSIONS = [("tool_transparency", 0, None, True), ("tool_transparency", 7, 14, False), ("spend_guard", -30, 3, True),
            ("spend_guard", 3, 5, False), ("spend_guard", 5, None, True), ("retry_fallback", 2, 40, True)]


def policy_versions(s, d):
    """Versions over the time of the tool calls; transparency is off for a week, retries have no version at first."""
    start = F.date_trunc("day", F.min("ts"))
    rows = F.array(*[F.struct(F.lit(p).alias("policy_id"), F.timestamp_add("DAY", F.lit(lo), F.col("start")).alias("valid_from"),
                              (F.timestamp_add("DAY", F.lit(hi), F.col("start")) if hi is not None
                               else F.lit(None).cast("timestamp_ntz")).cast("timestamp_ntz").alias("valid_to"),
                              F.lit(on).alias("enabled")) for p, lo, hi, on in VERSIONS])
    first = fx.tool_calls(s, d).agg(start.cast("timestamp_ntz").alias("start"))
    return first.select(F.inline(rows))


def _policy_timeline(s, d):
    log = P.audit_log(s, fx.tool_calls(s, d))
    return P.policies_in_force(log, policy_versions(s, d)).groupBy("policy_id", "action", "in_force").agg(
        F.count(F.lit(1)).alias("entries"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


_VERSIONS_SQL = " UNION ALL ".join(
    f"SELECT '{p}' AS policy_id, start + INTERVAL ({lo}) DAY AS valid_from, "
    + (f"start + INTERVAL ({hi}) DAY" if hi is not None else "CAST(NULL AS TIMESTAMP)") + f" AS valid_to, {on} AS enabled FROM t0"
    for p, lo, hi, on in VERSIONS)
register("policy_timeline", with_tables(f"""
WITH t0 AS (SELECT CAST(date_trunc('day', min(ts)) AS TIMESTAMP) AS start FROM tool_calls),
v AS ({_VERSIONS_SQL}), log AS (SELECT *, row_number() OVER () AS n FROM ({CALL_LOG_SQL}) l0),
state AS (SELECT l.n, any_value(l.policy_id) AS policy_id, any_value(l.action) AS action, any_value(l.ts) AS ts,
                 coalesce(arg_max(v.enabled, v.valid_from), false) AS in_force
          FROM log l LEFT JOIN v ON v.policy_id = l.policy_id AND v.valid_from <= l.ts AND (v.valid_to IS NULL OR l.ts < v.valid_to)
          GROUP BY l.n)
SELECT policy_id, action, in_force, count(*) AS entries, min(ts) AS first_ts, max(ts) AS last_ts
FROM state GROUP BY policy_id, action, in_force
""", "tool_calls"))(_policy_timeline)
