"""DuckDB text of the derived lead tables (the oracle side of the fixtures).

Each entry is a SELECT over the pre-registered test views; ``with_tables``
prefixes a query with the CTEs it needs.  The expressions mirror
``leadsmith.sources.fixtures`` term for term.
"""

from __future__ import annotations

from ..sources import fixtures as fx


def _case(index: str, values: list, else_: str = "NULL") -> str:
    parts = " ".join(f"WHEN {index} = {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {parts} ELSE {else_} END)"


def _case_map(col: str, mapping: dict) -> str:
    parts = " ".join(f"WHEN {col} = {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {parts} END)"


def _q(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("'", "''") + "'"


def _lead_id(k: str = "o_orderkey", d: str = "o_orderdate") -> str:
    return f"('LD-' || strftime({d}, '%Y%m%d') || '-' || CASE WHEN {k} < 100000000 THEN lpad(CAST({k} AS VARCHAR), 8, '0') ELSE CAST({k} AS VARCHAR) END)"


_CREATED = "(o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 86400 AS INTEGER)))"
_MQL_Q = f"({_CREATED} + to_seconds(CAST(600 + (o_orderkey * 104729) % 172800 AS INTEGER)))"
_SQL_Q = f"({_MQL_Q} + to_seconds(CAST(3600 + (o_orderkey * 15485863) % 432000 AS INTEGER)))"

TABLES: dict[str, str] = {}

TABLES["raw_leads"] = f"""
SELECT
  {_lead_id()} AS lead_id,
  {_CREATED} AS created_at,
  {_CREATED} AS updated_at,
  CASE WHEN o_orderkey % 10 < 5 THEN {_case('o_orderkey % 10', fx.CHANNELS)} ELSE 'web_form' END AS source_channel,
  'campaign_' || CAST(o_orderkey % 5 AS VARCHAR) AS source_campaign,
  {_case('CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1', fx.FORM_BY_PRIORITY)} AS form_type,
  {_case('o_orderkey % 11', fx.FIRST_NAMES)} AS first_name,
  {_case('o_orderkey % 13', fx.LAST_NAMES)} AS last_name,
  'user' || CAST(o_custkey AS VARCHAR) || '@' ||
    CASE WHEN o_custkey % 4 = 0 THEN 'gmail.com' WHEN o_custkey % 4 = 1 THEN 'yahoo.com'
         ELSE 'corp' || CAST(c_nationkey AS VARCHAR) || '.com' END AS email,
  CASE WHEN o_orderkey % 3 <> 0 THEN '+1-555-' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') END AS phone,
  CASE WHEN o_orderkey % 5 <> 0 THEN 'https://linkedin.com/in/user' || CAST(o_custkey AS VARCHAR) END AS linkedin_url,
  CASE WHEN o_orderkey % 9 <> 0 THEN c_name END AS company,
  {_case('o_orderkey % 8', fx.JOB_TITLES)} AS job_title,
  CASE WHEN o_totalprice >= 400000 THEN '5000+' WHEN o_totalprice >= 300000 THEN '1001-5000'
       WHEN o_totalprice >= 200000 THEN '201-1000' WHEN o_totalprice >= 100000 THEN '51-200'
       ELSE '11-50' END AS company_size,
  coalesce({_case_map('c_mktsegment', fx.INDUSTRY_BY_SEGMENT)}, 'Other') AS industry,
  'US' AS country,
  {_case('o_orderkey % 16', fx.MESSAGES)} AS message,
  (o_orderkey % 2 = 0) AS opt_in_marketing,
  {_case('o_orderkey % 20', fx.STATUS_BY_K20)} AS status,
  CASE WHEN o_orderkey % 20 < 6 THEN {_case('o_orderkey % 3', ['spam', 'incomplete_data', 'invalid_email'])} END
    AS rejection_reason,
  {_CREATED} - to_seconds(CAST(o_orderkey % 12 AS INTEGER)) AS page_load_time
FROM orders JOIN customer ON o_custkey = c_custkey
"""

TABLES["mql_leads"] = f"""
SELECT
  'MQL-' || substr({_lead_id()}, 4) AS mql_id,
  {_lead_id()} AS lead_id,
  CAST(50 + o_orderkey % 51 AS INTEGER) AS mql_score,
  {_case('o_orderkey % 4', fx.PERSONAS)} AS persona,
  {_case('o_orderkey % 3', fx.STAGES)} AS buying_stage,
  (32 + o_orderkey % 33) / 64.0 AS confidence_score,
  ((32 + o_orderkey % 33) / 64.0 < 0.7) AS human_reviewed,
  'mql_new' AS status,
  {_MQL_Q} AS qualified_at,
  {_MQL_Q} AS created_at
FROM orders WHERE o_orderkey % 20 BETWEEN 12 AND 18
"""

TABLES["sql_leads"] = f"""
SELECT
  'SQL-' || substr('MQL-' || substr({_lead_id()}, 4), 5) AS sql_id,
  'MQL-' || substr({_lead_id()}, 4) AS mql_id,
  {_lead_id()} AS lead_id,
  CAST(40 + o_orderkey % 16 + (o_orderkey * 7) % 16 + (o_orderkey * 11) % 16 + (o_orderkey * 13) % 16 AS INTEGER)
    AS sql_score,
  CAST(10 + o_orderkey % 16 AS INTEGER) AS bant_score_budget,
  CAST(10 + (o_orderkey * 7) % 16 AS INTEGER) AS bant_score_authority,
  CAST(10 + (o_orderkey * 11) % 16 AS INTEGER) AS bant_score_need,
  CAST(10 + (o_orderkey * 13) % 16 AS INTEGER) AS bant_score_timeline,
  {_case('o_orderkey % 4', fx.DEAL_SIZES)} AS estimated_deal_size,
  CAST(CAST({_SQL_Q} AS DATE) + CAST(30 * (1 + o_orderkey % 4) AS INTEGER) AS DATE) AS estimated_close_date,
  {_case('o_orderkey % 3', fx.TEAMS)} AS assigned_team,
  'REP' || lpad(CAST(o_orderkey % 10 AS VARCHAR), 3, '0') AS assigned_rep_id,
  'Rep ' || lpad(CAST(o_orderkey % 10 AS VARCHAR), 3, '0') AS assigned_rep_name,
  (o_orderkey % 2 = 0) AS handoff_confirmed,
  CASE WHEN o_orderkey % 2 = 0 THEN {_SQL_Q} + to_seconds(CAST(o_orderkey % 7200 AS INTEGER)) END AS handoff_at,
  {_case('o_orderkey % 5', fx.SQL_STATUSES)} AS status,
  {_SQL_Q} AS qualified_at,
  {_SQL_Q} AS created_at
FROM orders WHERE o_orderkey % 20 BETWEEN 16 AND 18
"""

_REP_NUM = "(CASE WHEN s_suppkey < 1000 THEN lpad(CAST(s_suppkey AS VARCHAR), 3, '0') ELSE CAST(s_suppkey AS VARCHAR) END)"
TABLES["sales_reps"] = f"""
SELECT
  'REP' || {_REP_NUM} AS rep_id,
  'Rep' AS first_name,
  {_REP_NUM} AS last_name,
  lower('REP' || {_REP_NUM}) || '@sales.example.com' AS email,
  {_case('s_suppkey % 3', fx.TEAMS)} AS team,
  (s_suppkey % 7 <> 0) AS is_active,
  CAST(CAST(floor(abs(s_acctbal)) AS BIGINT) % 60 AS INTEGER) AS current_load,
  50 AS max_load
FROM supplier
"""

TABLES["tool_calls"] = f"""
SELECT
  event_id AS call_id,
  'RUN-' || CAST(user_id AS VARCHAR) AS lead_id,
  ts,
  {_case_map('event_type', fx.AGENT_BY_EVENT)} AS agent,
  {_case('event_id % 4', fx.TOOLS)} AS tool,
  value / 2000.0 AS cost_usd,
  CAST(floor(value * 10) AS BIGINT) AS duration_ms,
  CASE WHEN event_id % 50 <> 0 THEN 'success' ELSE 'error: timeout' END AS status
FROM events
"""

_TRIAGE_TS = f"({_CREATED} + to_seconds(CAST(30 + o_orderkey % 300 AS INTEGER)))"
_HANDOFF = f"({_SQL_Q} + to_seconds(CAST(o_orderkey % 7200 AS INTEGER)))"
TABLES["lead_events"] = f"""
SELECT 'EVT-' || strftime(event_timestamp, '%Y%m%d') || '-' || CASE WHEN k < 100000000 THEN lpad(CAST(k AS VARCHAR), 8, '0') ELSE CAST(k AS VARCHAR) END || '-'
         || CAST(seq AS VARCHAR) AS event_id,
       lead_id, event_timestamp, event_type, from_status, to_status, agent_name, score_at_event
FROM (
  SELECT o_orderkey AS k, {_lead_id()} AS lead_id, 1 AS seq, 'lead_captured' AS event_type,
         {_CREATED} AS event_timestamp, CAST(NULL AS VARCHAR) AS from_status, 'new' AS to_status,
         'WebFormAgent' AS agent_name, CAST(NULL AS INTEGER) AS score_at_event
  FROM orders
  UNION ALL
  SELECT o_orderkey, {_lead_id()}, 2, 'triage_completed', {_TRIAGE_TS}, 'processing',
         CASE WHEN o_orderkey % 20 < 6 THEN 'rejected' WHEN o_orderkey % 20 = 19 THEN 'processing'
              ELSE 'accepted' END,
         'TriageAgent', CAST(NULL AS INTEGER)
  FROM orders
  UNION ALL
  SELECT o_orderkey, {_lead_id()}, 3, 'mql_qualified', {_MQL_Q}, 'accepted', 'mql', 'MQLAgent',
         CAST(50 + o_orderkey % 51 AS INTEGER)
  FROM orders WHERE o_orderkey % 20 BETWEEN 12 AND 18
  UNION ALL
  SELECT o_orderkey, {_lead_id()}, 4, 'sql_qualified', {_SQL_Q}, 'mql', 'sql', 'SQLAgent',
         CAST(40 + o_orderkey % 61 AS INTEGER)
  FROM orders WHERE o_orderkey % 20 BETWEEN 16 AND 18
  UNION ALL
  SELECT o_orderkey, {_lead_id()}, 5, 'sales_assigned', {_HANDOFF}, 'sql', 'sales_owned', 'SQLAgent',
         CAST(NULL AS INTEGER)
  FROM orders WHERE o_orderkey % 20 = 18
) ev
"""


def with_tables(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named derived tables (in the order given)."""
    ctes = ",\n".join(f"{n} AS ({TABLES[n]})" for n in names)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":  # merge the query's own CTEs after ours
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
