"""Registered queries for routing (R1-R5) and the lifecycle / whole-batch run."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import lifecycle as L
from ..operators import policies as P
from ..operators import routing as R
from ..operators import scoring as S
from ..sources import fixtures as fx
from . import oracle_rules as O
from .oracle import with_tables
from .registry import AS_OF, SQL_AS_OF, register
from .registry_policies import CALL_LOG_SQL, _pii_array_sql, approvals, hot_leads, hot_sql, LEAD_PII_FIELDS
from .registry_rules import ANSWERS_SQL, END, review_answers

_K = "CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT)"


# ----------------------------------------------------------------- R2-R5

AVAIL_SQL = """
SELECT rep_id, concat_ws(' ', first_name, last_name) AS name, email, team, current_load, max_load
FROM sales_reps WHERE is_active AND current_load < max_load
"""
register("available_reps", with_tables(AVAIL_SQL, "sales_reps"))(
    lambda s, d: R.available_reps(fx.sales_reps(s, d)))
register("rep_roster", with_tables("SELECT * FROM sales_reps", "sales_reps"))(
    lambda s, d: fx.sales_reps(s, d))


def qualified_leads(s, d):
    sc = S.score_bant(fx.raw_leads(s, d), as_of=AS_OF, keep=["lead_id"])
    return sc.filter("qualified").select("lead_id", "assigned_team")


_BP = O.bant_parts()
_EMP = O.company_employees()
QUALIFIED_SQL = f"""
SELECT lead_id, CASE WHEN {_EMP} >= 1000 THEN 'enterprise_sales' WHEN {_EMP} >= 200 THEN 'mid_market_sales'
                     ELSE 'smb_sales' END AS assigned_team
FROM raw_leads WHERE ({_BP['budget']}) + ({_BP['authority']}) + ({_BP['need']}) + ({_BP['timeline']}) >= 70
"""

BEST_SQL = f"""
av AS ({AVAIL_SQL}),
bt AS (SELECT team, arg_min(rep_id, (current_load, rep_id)) AS rid, arg_min(name, (current_load, rep_id)) AS rname,
              arg_min(email, (current_load, rep_id)) AS remail FROM av GROUP BY team),
ba AS (SELECT arg_min(rep_id, (current_load, rep_id)) AS rid, arg_min(name, (current_load, rep_id)) AS rname,
              arg_min(email, (current_load, rep_id)) AS remail FROM av)
"""


def _assign_sql(src: str, reason_prefix: str = "") -> str:
    return f"""
SELECT q.lead_id, q.assigned_team, coalesce(bt.rid, ba.rid) AS assigned_rep_id,
  coalesce(bt.rname, ba.rname) AS assigned_rep_name, coalesce(bt.remail, ba.remail) AS assigned_rep_email,
  '{reason_prefix}' || CASE WHEN bt.rid IS NOT NULL THEN 'team' WHEN ba.rid IS NOT NULL THEN 'fallback_any_team'
       ELSE 'no_rep_available' END AS assignment_reason
FROM ({src}) q LEFT JOIN bt ON q.assigned_team = bt.team CROSS JOIN ba
"""


register("assign_rep", with_tables(f"WITH {BEST_SQL} {_assign_sql(QUALIFIED_SQL)}", "raw_leads", "sales_reps"))(
    lambda s, d: R.assign_rep(qualified_leads(s, d), fx.sales_reps(s, d)))

register("assign_balanced", with_tables(f"""
WITH {BEST_SQL},
q AS ({QUALIFIED_SQL}),
ranked AS (SELECT lead_id, assigned_team,
                  row_number() OVER (PARTITION BY assigned_team ORDER BY sha256(lead_id), lead_id) AS n FROM q),
slots AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY slot_load, rep_id) AS n
          FROM (SELECT rep_id, name, email, team, unnest(range(current_load, max_load)) AS slot_load FROM av) x),
lo AS (SELECT r.*, r.n > coalesce(f.free, 0) AS beyond
       FROM ranked r LEFT JOIN (SELECT team, count(*) AS free FROM slots GROUP BY team) f ON f.team = r.assigned_team),
ln AS (SELECT *, CASE WHEN beyond THEN row_number() OVER (PARTITION BY beyond ORDER BY assigned_team NULLS FIRST, n) ELSE n END AS place FROM lo),
so AS (SELECT s.*, s.n > coalesce(w.wanted, 0) AS beyond
       FROM slots s LEFT JOIN (SELECT assigned_team, count(*) AS wanted FROM q GROUP BY assigned_team) w ON w.assigned_team = s.team),
sn AS (SELECT *, CASE WHEN beyond THEN row_number() OVER (PARTITION BY beyond ORDER BY slot_load, rep_id) ELSE n END AS place FROM so)
SELECT ln.lead_id, ln.assigned_team, sn.rep_id AS assigned_rep_id, sn.name AS assigned_rep_name, sn.email AS assigned_rep_email,
  CASE WHEN sn.rep_id IS NULL THEN 'no_capacity' WHEN ln.beyond THEN 'overflow_other_team' ELSE 'balanced' END AS assignment_reason
FROM ln LEFT JOIN sn ON sn.beyond = ln.beyond AND sn.place = ln.place AND (ln.beyond OR sn.team = ln.assigned_team)
""", "raw_leads", "sales_reps"))(lambda s, d: R.assign_balanced(qualified_leads(s, d), fx.sales_reps(s, d)))


def _outbox(s, d):
    t = fx.load_tables(s, d)
    return R.handoff_outbox(t["sql_leads"], t["raw_leads"], t["sales_reps"])


register("handoff_outbox", with_tables("""
SELECT s.sql_id, s.lead_id, s.assigned_rep_id, r.email AS rep_email, s.estimated_deal_size, s.sql_score,
  'New SQL assigned to ' || coalesce(s.assigned_rep_name, '') || ': ' || concat_ws(' ', l.first_name, l.last_name)
    || ' @ ' || coalesce(l.company, '') AS notification
FROM sql_leads s LEFT JOIN raw_leads l ON s.lead_id = l.lead_id LEFT JOIN sales_reps r ON s.assigned_rep_id = r.rep_id
WHERE NOT s.handoff_confirmed
""", "raw_leads", "sql_leads", "sales_reps"))(_outbox)


# ----------------------------------------------------------------- F1-F6

def qualified_run(s, d, leads=None, columns=None):
    return L.qualify_leads(fx.raw_leads(s, d) if leads is None else leads, fx.sales_reps(s, d), review_answers(s, d), approvals(s, d),
                           AS_OF, END, columns=columns)


QUALIFY_COLS = ["lead_id", "email", "review_decision", "dup_action", "pii_action", "decision", "mql_score",
                "sql_score", "estimated_deal_size", "approval_action", "final_status", "assigned_rep_id"]


def _qualify_sql(final: str) -> str:
    mp = O.mql_parts()
    bp = O.bant_parts()
    spam = O.spam_keyword(keywords=DEFAULT["scoring"]["triage_spam_keywords"])
    rank = "(CASE x.action WHEN 'deny' THEN 2 WHEN 'escalate' THEN 1 ELSE 0 END)"
    f = _pii_array_sql(LEAD_PII_FIELDS)
    dl_r = "created_at + INTERVAL 60 SECOND"
    dl_a = "created_at + INTERVAL 120 SECOND"
    allow = O.lst(DEFAULT["policies"]["allow_resubmit_statuses"])
    return with_tables(f"""
WITH RECURSIVE sc_dummy AS (SELECT 1 AS one),
sc AS (SELECT *, {O.screen_select(end=END)} FROM raw_leads),
rt AS (SELECT *, {O.route('bot_score', 'quality_score')} AS route FROM sc),
ans AS (SELECT lead_id AS a_lead, arg_min(answer, answered_at) AS answer, min(answered_at) AS answered_at
        FROM ({ANSWERS_SQL}) a0 GROUP BY lead_id),
rv AS (
  SELECT rt.*, CASE WHEN route = 'accept' THEN 'accepted' WHEN route = 'reject' THEN 'rejected'
    WHEN answered_at IS NOT NULL AND answered_at <= {dl_r} AND lower(trim(coalesce(answer, ''))) IN ('y','yes','')
      THEN 'accepted'
    WHEN answered_at IS NOT NULL AND answered_at <= {dl_r} THEN 'rejected'
    WHEN {SQL_AS_OF} < {dl_r} THEN 'pending' ELSE 'accepted' END AS review_decision
  FROM rt LEFT JOIN ans ON rt.lead_id = ans.a_lead
),
st AS (
  SELECT lead_id, email, created_at, review_decision, f, first_name, last_name, company,
    CASE WHEN {O.blank('email')} OR {O.blank('company')} OR {spam} IS NOT NULL THEN 'rejected' ELSE 'accepted' END
      AS decision,
    CASE WHEN {O.blank('email')} THEN 'invalid_email' WHEN {O.blank('company')} THEN 'incomplete_data'
         WHEN {spam} IS NOT NULL THEN 'spam' END AS reason,
    CAST({' + '.join(mp[p] for p in S.MQL_PARTS)} AS INTEGER) AS mql_score,
    CAST(({bp['budget']}) + ({bp['authority']}) + ({bp['need']}) + ({bp['timeline']}) AS INTEGER) AS sql_score,
    CAST({bp['need']} AS INTEGER) AS need, {_EMP} AS emp,
    CASE WHEN {_EMP} >= 1000 THEN 'enterprise_sales' WHEN {_EMP} >= 200 THEN 'mid_market_sales'
         ELSE 'smb_sales' END AS assigned_team
  FROM (SELECT *, {f} AS f FROM rv) y
),
st2 AS (
  SELECT *,
    CASE WHEN len(list_filter(f, lambda x: x.severity <> 'low')) > 0 THEN
      CASE list_max(list_transform(f, lambda x: {rank})) WHEN 2 THEN 'deny' WHEN 1 THEN 'escalate' ELSE 'allow' END
    ELSE 'allow' END AS pii_action,
    mql_score >= 50 AS mql_qualified, sql_score >= 70 AS sql_qualified,
    CASE WHEN emp >= 1000 AND need >= 15 THEN '$200K+' WHEN emp >= 1000 THEN '$50K-$200K'
         WHEN emp >= 200 THEN '$10K-$50K' ELSE '<$10K' END AS estimated_deal_size
  FROM st
),
ap AS (
  SELECT lead_id AS p_lead, arg_min(answer, answered_at) AS p_answer, min(answered_at) AS p_at FROM (
    SELECT lead_id, CASE {_K} % 5 WHEN 0 THEN 'no' WHEN 1 THEN 'yes' WHEN 2 THEN 'Y' ELSE '' END AS answer,
           created_at + to_seconds(CAST({_K} % 200 AS INTEGER)) AS answered_at
    FROM raw_leads WHERE {_K} % 5 <> 4) a0 GROUP BY lead_id
),
st3 AS (
  SELECT st2.*,
    CASE WHEN NOT (estimated_deal_size = '$200K+' OR sql_score < 60) THEN 'allow'
      WHEN p_at IS NOT NULL AND p_at <= {dl_a} AND lower(trim(coalesce(p_answer, ''))) IN ('y','yes','') THEN 'allow'
      WHEN p_at IS NOT NULL AND p_at <= {dl_a} THEN 'deny'
      WHEN {SQL_AS_OF} < {dl_a} THEN 'pending' ELSE 'allow' END AS approval_action
  FROM st2 LEFT JOIN ap ON st2.lead_id = ap.p_lead
),
oc AS (
  SELECT *, CASE WHEN pii_action = 'deny' THEN 'processing' WHEN decision = 'rejected' THEN 'rejected'
    WHEN NOT mql_qualified THEN 'accepted' WHEN sql_qualified AND approval_action = 'allow' THEN 'sales_owned'
    ELSE 'accepted' END AS outcome
  FROM st3
),
seq AS (
  SELECT lead_id, lower(trim(email)) AS em, created_at AS ts, outcome, pii_action = 'deny' AS keeps,
         row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY created_at, lead_id) AS rn
  FROM oc WHERE review_decision = 'accepted' AND email IS NOT NULL AND trim(email) <> ''
),
fold(em, rn, lead_id, act, aid, ats, stt) AS (
  SELECT em, rn, lead_id, 'allow', lead_id, ts, outcome FROM seq WHERE rn = 1
  UNION ALL
  SELECT s.em, s.rn, s.lead_id,
    CASE WHEN f.stt IN {allow} THEN 'allow' WHEN s.ts < f.ats + INTERVAL 31 DAY THEN 'deny' ELSE 'allow' END,
    CASE WHEN f.stt IN {allow} OR s.ts < f.ats + INTERVAL 31 DAY THEN f.aid ELSE s.lead_id END,
    CASE WHEN f.stt IN {allow} OR s.ts < f.ats + INTERVAL 31 DAY THEN f.ats ELSE s.ts END,
    CASE WHEN f.stt IN {allow} AND s.keeps THEN f.stt WHEN f.stt IN {allow} THEN s.outcome WHEN s.ts < f.ats + INTERVAL 31 DAY THEN f.stt ELSE s.outcome END
  FROM fold f JOIN seq s ON s.em = f.em AND s.rn = f.rn + 1
),
fin AS (
  SELECT oc.*, CASE WHEN oc.review_decision = 'accepted' THEN coalesce(fold.act, 'allow') END AS dup_action
  FROM oc LEFT JOIN fold ON oc.lead_id = fold.lead_id
),
fs AS (
  SELECT *, CASE WHEN review_decision = 'rejected' THEN 'rejected' WHEN review_decision = 'pending' THEN 'pending_review'
    WHEN dup_action = 'deny' THEN 'rejected_duplicate' WHEN pii_action = 'deny' THEN 'rejected_pii'
    WHEN decision = 'rejected' THEN 'rejected' WHEN NOT mql_qualified THEN 'nurture'
    WHEN sql_qualified AND approval_action = 'deny' THEN 'rejected_by_operator'
    WHEN sql_qualified AND approval_action = 'pending' THEN 'pending_approval'
    WHEN sql_qualified THEN 'sales_owned' ELSE 'mql_nurture' END AS final_status
  FROM fin
),
{BEST_SQL},
qa AS (
  SELECT fs.*,
    CASE WHEN sql_qualified AND final_status IN ('sales_owned','rejected_by_operator','pending_approval','mql_nurture')
         THEN coalesce(bt.rid, ba.rid) END AS assigned_rep_id,
    CASE WHEN sql_qualified AND final_status IN ('sales_owned','rejected_by_operator','pending_approval','mql_nurture')
         THEN coalesce(bt.rname, ba.rname) END AS assigned_rep_name
  FROM fs LEFT JOIN bt ON fs.assigned_team = bt.team CROSS JOIN ba
)
{final}
""", "raw_leads", "sales_reps")


QUALIFY_SQL = _qualify_sql(f"SELECT {', '.join(QUALIFY_COLS)} FROM qa")
register("qualify_leads", QUALIFY_SQL)(lambda s, d: qualified_run(s, d, columns=QUALIFY_COLS).select(*QUALIFY_COLS))
register("qualify_leads_hot", hot_sql(QUALIFY_SQL))(lambda s, d: qualified_run(s, d, hot_leads(s, d), QUALIFY_COLS).select(*QUALIFY_COLS))
register("final_status", _qualify_sql("SELECT final_status, count(*) AS leads FROM qa GROUP BY final_status"))(
    lambda s, d: qualified_run(s, d, columns=["final_status"]).groupBy("final_status").agg(F.count(F.lit(1)).alias("leads")))

_MQL_RAN = "('nurture','sales_owned','mql_nurture','rejected_by_operator','pending_approval')"
_SQL_RAN = "('sales_owned','mql_nurture','rejected_by_operator','pending_approval')"
FEED_SQL = f"""
SELECT CASE WHEN review_decision <> 'rejected' AND final_status NOT IN ('rejected_duplicate', 'rejected_pii')
       THEN lead_id END AS lead_id,
  trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS name, company, email, final_status,
  CASE WHEN final_status IN {_MQL_RAN} THEN mql_score END AS mql_score,
  CASE WHEN final_status IN {_SQL_RAN} THEN sql_score END AS sql_score,
  CASE WHEN final_status IN {_SQL_RAN} THEN assigned_rep_name END AS assigned_rep,
  created_at AS submitted_at
FROM qa
"""


def feed(s, d):
    return L.result_feed(qualified_run(s, d, columns=L.FEED_READS))


register("result_feed", _qualify_sql(FEED_SQL))(feed)
register("recent_results", _qualify_sql(
    f"SELECT * FROM ({FEED_SQL}) r ORDER BY submitted_at DESC, email DESC, lead_id DESC NULLS LAST LIMIT 50"))(
    lambda s, d: L.recent_results(feed(s, d)))
register("dashboard_counts", _qualify_sql(f"""
SELECT count(*) AS total, count_if(final_status = 'sales_owned') AS sales_owned,
  count_if(final_status = 'sql') AS sql, count_if(final_status = 'mql') AS mql,
  count_if(final_status IN ('nurture', 'mql_nurture')) AS nurture, count_if(final_status = 'rejected') AS rejected,
  count_if(final_status = 'rejected_duplicate') AS rejected_duplicate,
  count_if(final_status = 'rejected_pii') AS rejected_pii,
  count_if(final_status = 'rejected_by_operator') AS rejected_by_operator
FROM ({FEED_SQL}) r
"""))(lambda s, d: L.dashboard_counts(feed(s, d)))


# ----------------------------------------------------------------- S8 / T3

def _events(s, d):
    from ..sources import sinks as K

    k = F.substring_index("lead_id", "-", -1).cast("long")
    return K.events_from_stages(qualified_run(s, d, columns=K.EVENT_READS), AS_OF, durations={"triage_completed": k % 300, "mql_scored": k % 90},
                                errors={"mql_scored": F.when(k % 97 == 0, "timeout")})


def _events_sql() -> str:
    key = "sha256(lead_id || '|' || '{i}')"
    details = {
        "triage_completed": "struct_pack(decision := decision, triage_reason := reason)",
        "mql_scored": "struct_pack(mql_qualified := mql_qualified, mql_score := mql_score)",
        "sql_scored": "struct_pack(sql_qualified := sql_qualified, sql_score := sql_score, assigned_team := assigned_team, "
                      "estimated_deal_size := estimated_deal_size)",
        "sales_assigned": "struct_pack(assigned_rep_id := assigned_rep_id)"}
    seconds = {"triage_completed": f"{_K} % 300", "mql_scored": f"{_K} % 90"}
    gid = ("'EVT-' || strftime({t}, '%Y%m%d') || '-' || upper(substr(sha256(lead_id || '|' || '{i}'), 1, 8))")
    started = ("(final_status NOT IN ('rejected_duplicate', 'rejected_pii', 'pending_review') "
               "AND review_decision = 'accepted')")
    mql_ran = "final_status IN ('nurture','sales_owned','mql_nurture','rejected_by_operator','pending_approval')"
    sql_ran = "final_status IN ('sales_owned','mql_nurture','rejected_by_operator','pending_approval')"
    parts = [
        (0, "lead_captured", "NULL", "'new'", "WebFormAgent", "NULL", "review_decision = 'accepted'"),
        (1, "triage_started", "'new'", "'processing'", "TriageAgent", "NULL", started),
        (2, "triage_completed", "'processing'",
         "CASE decision WHEN 'accepted' THEN 'accepted' WHEN 'rejected' THEN 'rejected' ELSE 'processing' END",
         "TriageAgent", "NULL", started),
        (3, "mql_scored", "'accepted'", "CASE WHEN mql_qualified THEN 'mql' ELSE 'accepted' END", "MQLAgent",
         "mql_score", f"{started} AND {mql_ran}"),
        (4, "sql_scored", "'mql'", "CASE WHEN sql_qualified THEN 'sql' ELSE 'mql' END", "SQLAgent", "sql_score",
         f"{started} AND {sql_ran}"),
        (5, "sales_assigned", "'sql'", "'sales_owned'", "SQLAgent", "NULL", f"{started} AND final_status = 'sales_owned'"),
    ]
    sel = "\nUNION ALL\n".join(
        f"SELECT {gid.format(t=SQL_AS_OF, i=i)} AS event_id, upper({key.format(i=i)}) AS event_key, lead_id, {i} AS seq, {SQL_AS_OF} + INTERVAL {i} MILLISECOND AS event_timestamp, "
        f"'{e}' AS event_type, CAST({frm} AS VARCHAR) AS from_status, {to} AS to_status, '{agent}' AS agent_name, "
        f"CAST({score} AS INTEGER) AS score_at_event, "
        + (f"to_json({details[e]}) AS event_details, " if e in details else "'{}' AS event_details, ")
        + f"CAST({seconds.get(e, 'NULL')} AS INTEGER) AS duration_seconds, "
        + ("CASE WHEN " + _K + " % 97 = 0 THEN 'timeout' END" if e == "mql_scored" else "CAST(NULL AS VARCHAR)")
        + f" AS error_message FROM qa WHERE {cond}"
        for i, e, frm, to, agent, score, cond in parts)
    return _qualify_sql(sel)


register("lead_event_append", _events_sql())(_events)


# ----------------------------------------------------------------- P12

def _audit_summary(s, d):
    calls = P.audit_log(s, fx.tool_calls(s, d)).select("lead_id", "policy_id", "action")
    return P.audit_summary(calls.unionByName(P.run_audit_log(qualified_run(s, d)).select("lead_id", "policy_id", "action")))


_REACHED = "review_decision = 'accepted'"
_CHECKED = f"{_REACHED} AND dup_action <> 'deny'"
_DECIDED = f"{_CHECKED} AND pii_action <> 'deny'"
_MQL_AT = f"{_DECIDED} AND decision = 'accepted'"
_SQL_AT = f"{_MQL_AT} AND mql_qualified"
register("audit_summary", with_tables(f"""
WITH RECURSIVE run AS ({_qualify_sql("SELECT * FROM qa")}),
log AS (
  SELECT lead_id, policy_id, action FROM ({CALL_LOG_SQL}) c
  UNION ALL SELECT lead_id, 'duplicate_detection', 'deny' FROM run WHERE {_REACHED} AND dup_action = 'deny'
  UNION ALL SELECT lead_id, 'pii_detection', pii_action FROM run
            WHERE {_CHECKED} AND len(list_filter(f, lambda x: x.severity <> 'low')) > 0
  UNION ALL SELECT lead_id, 'approval_gate', approval_action FROM run
            WHERE {_SQL_AT} AND sql_qualified AND (estimated_deal_size = '$200K+' OR sql_score < 60) AND approval_action <> 'pending'
  UNION ALL SELECT lead_id, 'decision_audit', 'allow' FROM run, (VALUES (1), (2)) t(n) WHERE {_DECIDED}
  UNION ALL SELECT lead_id, 'decision_audit', 'allow' FROM run, (VALUES (1), (2)) t(n) WHERE {_MQL_AT}
  UNION ALL SELECT lead_id, 'decision_audit', 'allow' FROM run, (VALUES (1), (2)) t(n) WHERE {_SQL_AT}
)
SELECT policy_id, action, count(*) AS entries, count(DISTINCT lead_id) AS leads FROM log GROUP BY policy_id, action
""", "tool_calls"))(_audit_summary)
