"""Registered queries for the per-lead rules: screening, triage, MQL, BANT."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.helpers import with_helpers
from ..operators import screening as W
from ..operators import scoring as S
from ..sources import fixtures as fx
from . import oracle_rules as O
from .oracle import with_tables
from .registry import AS_OF, SQL_AS_OF, register

END = "created_at"  # submission time of the derived leads (fill time = page_load -> submit)


def _leads(s, d):
    return fx.raw_leads(s, d)


# ----------------------------------------------------------------- W1-W17

register("email_domain", with_tables(f"""
SELECT lead_id, email, {O.email_domain()} AS email_domain FROM raw_leads
""", "raw_leads"))(lambda s, d: _leads(s, d).select("lead_id", "email", W.email_domain().alias("email_domain")))

_RULES = {
    "screen_email": (lambda: W.screen_email(), lambda: O.screen_email()),
    "screen_required": (lambda: W.screen_required(), lambda: O.screen_required()),
    "screen_spam": (lambda: W.screen_spam(), lambda: O.screen_spam()),
    "screen_names": (lambda: W.screen_names(), lambda: O.screen_names()),
    "screen_common_name": (lambda: W.screen_common_name(sensitivity="high"),
                           lambda: O.screen_common_name(sensitivity="high")),
    "screen_timing": (lambda: W.screen_timing(end_col=END), lambda: O.screen_timing(end=END)),
    "screen_message": (lambda: W.screen_message(), lambda: O.screen_message()),
    "screen_title": (lambda: W.screen_title(), lambda: O.screen_title()),
    "screen_firmographic": (lambda: W.screen_firmographic(), lambda: O.screen_firmographic()),
}


def _rule_query(spark_rule):
    return lambda s, d: W.rule_columns(_leads(s, d), spark_rule())


for _key, (_sp, _or) in _RULES.items():
    _b, _q, _f = _or()
    register(_key, with_tables(f"""
SELECT lead_id, {_b} AS bot_points, {_q} AS quality_points, {O.arr(_f)} AS flags FROM raw_leads
""", "raw_leads"))(_rule_query(_sp))

SCREEN_SQL = f"""
SELECT lead_id, flags, bot_score, quality_score, {O.risk_level('bot_score')} AS risk_level,
       {O.route('bot_score', 'quality_score')} AS route
FROM (SELECT lead_id, created_at, {O.screen_select(end=END)} FROM raw_leads) x
"""


def screened(s, d):
    return W.screen_leads(_leads(s, d), end_col=END, keep=["lead_id", "created_at"])


register("screen_leads", with_tables(SCREEN_SQL, "raw_leads"))(
    lambda s, d: screened(s, d).drop("created_at"))

register("screen_route", with_tables(f"""
SELECT risk_level, route, count(*) AS leads, CAST(sum(bot_score) AS BIGINT) AS bot_points,
       CAST(sum(quality_score) AS BIGINT) AS quality_points
FROM ({SCREEN_SQL}) x GROUP BY risk_level, route
""", "raw_leads"))(
    lambda s, d: screened(s, d).groupBy("risk_level", "route").agg(
        F.count(F.lit(1)).alias("leads"), F.sum("bot_score").cast("long").alias("bot_points"),
        F.sum("quality_score").cast("long").alias("quality_points")))

# Operator answers for reviewed leads, derived from the lead key k:
# k % 4 = 0 'n', 1 'y', 2 '' (enter), 3 no answer; answered k % 90 seconds after submission.
_K = "CAST(regexp_extract(lead_id, '[0-9]+$') AS BIGINT)"


def review_answers(s, d):
    k = F.substring_index(F.col("lead_id"), "-", -1).cast("long")
    return (fx.lead_keys(s, d).filter(k % 4 != 3)
            .select("lead_id",
                    F.when(k % 4 == 0, "n").when(k % 4 == 1, " Y ").otherwise("").alias("answer"),
                    F.timestamp_add("SECOND", (k % 90).cast("int"), F.col("created_at")).alias("answered_at")))


ANSWERS_SQL = f"""
SELECT lead_id, CASE WHEN {_K} % 4 = 0 THEN 'n' WHEN {_K} % 4 = 1 THEN ' Y ' ELSE '' END AS answer,
       created_at + to_seconds(CAST({_K} % 90 AS INTEGER)) AS answered_at
FROM raw_leads WHERE {_K} % 4 <> 3
"""


def _review(s, d):
    return W.resolve_reviews(screened(s, d), review_answers(s, d), "created_at", AS_OF).select(
        "lead_id", "route", "review_decision", "resolved_by")


register("review_resolution", with_tables(f"""
SELECT sc.lead_id, sc.route,
  CASE WHEN sc.route = 'accept' THEN 'accepted' WHEN sc.route = 'reject' THEN 'rejected'
       WHEN a.answered_at IS NOT NULL AND a.answered_at <= sc.created_at + INTERVAL 60 SECOND
            AND lower(trim(coalesce(a.answer, ''))) IN ('y', 'yes', '') THEN 'accepted'
       WHEN a.answered_at IS NOT NULL AND a.answered_at <= sc.created_at + INTERVAL 60 SECOND THEN 'rejected'
       WHEN {SQL_AS_OF} < sc.created_at + INTERVAL 60 SECOND THEN 'pending'
       ELSE 'accepted' END AS review_decision,
  CASE WHEN sc.route <> 'review' THEN 'rules'
       WHEN a.answered_at IS NOT NULL AND a.answered_at <= sc.created_at + INTERVAL 60 SECOND THEN 'operator'
       WHEN {SQL_AS_OF} < sc.created_at + INTERVAL 60 SECOND THEN 'waiting' ELSE 'timeout' END AS resolved_by
FROM (SELECT lead_id, created_at, {O.route('bot_score', 'quality_score')} AS route
      FROM (SELECT lead_id, created_at, {O.screen_select(end=END)} FROM raw_leads) y) sc
LEFT JOIN (SELECT lead_id, arg_min(answer, answered_at) AS answer, min(answered_at) AS answered_at
           FROM ({ANSWERS_SQL}) a0 GROUP BY lead_id) a ON sc.lead_id = a.lead_id
""", "raw_leads"))(_review)


def normalizer_results(s, d):
    """Normalised fields as an enrichment step returns them: upper-cased, or '' (no opinion)."""
    k = F.substring_index(F.col("lead_id"), "-", -1).cast("long")
    return _leads(s, d).select("lead_id", *[
        F.when(k % 3 == 0, F.lit("")).otherwise(F.upper(F.trim(F.col(f)))).alias(f"normalized_{f}")
        for f in W.NORMALIZED_FIELDS])


def _merge(s, d):
    cols = ["lead_id", *W.NORMALIZED_FIELDS]
    return W.merge_normalized(_leads(s, d).select(*cols), normalizer_results(s, d))


register("merge_normalized", with_tables(f"""
SELECT r.lead_id, {', '.join(
    f"coalesce(nullif(CASE WHEN {_K.replace('lead_id', 'r.lead_id')} % 3 = 0 THEN '' ELSE upper(trim(r.{f})) END, ''), r.{f}) AS {f}"
    for f in W.NORMALIZED_FIELDS)}
FROM raw_leads r
""", "raw_leads"))(_merge)


def _flag_union(s, d):
    sc = W.screen_leads(_leads(s, d), end_col=END, keep=["lead_id", "rejection_reason", "status"])
    extra = F.filter(F.array(F.col("rejection_reason"), F.concat(F.lit("Status: "), F.col("status")),
                             F.try_element_at(F.col("flags"), F.lit(1))), lambda x: x.isNotNull())
    return sc.select("lead_id", W.flag_union(F.col("flags"), extra).alias("all_flags"))


register("flag_union", with_tables(f"""
SELECT lead_id, list_filter(l, lambda x, i: list_position(l, x) = i) AS all_flags
FROM (
  SELECT lead_id, list_concat(flags, list_filter([rejection_reason, 'Status: ' || status, flags[1]],
                                                 lambda x: x IS NOT NULL)) AS l
  FROM (SELECT lead_id, rejection_reason, status, {O.screen_select(end=END)} FROM raw_leads) y
) z
""", "raw_leads"))(_flag_union)


# ----------------------------------------------------------------- T1-T2

def _triage(s, d):
    return S.triage_leads(_leads(s, d), keep=["lead_id"])


register("triage_rules", with_tables(f"""
SELECT lead_id, decision, triage_reason,
  CASE decision WHEN 'accepted' THEN 'accepted' WHEN 'rejected' THEN 'rejected' ELSE 'processing' END
    AS triage_status,
  CASE decision WHEN 'accepted' THEN 'mql_agent' WHEN 'rejected' THEN 'none' ELSE 'human_review' END AS next_agent
FROM (
  SELECT lead_id, CASE WHEN reason IS NOT NULL THEN 'rejected' ELSE 'accepted' END AS decision,
         reason AS triage_reason
  FROM (SELECT lead_id, CASE WHEN {O.blank('email')} THEN 'invalid_email'
                             WHEN {O.blank('company')} THEN 'incomplete_data'
                             WHEN {O.spam_keyword(keywords=S.DEFAULT['scoring']['triage_spam_keywords'])} IS NOT NULL
                             THEN 'spam' END AS reason
        FROM raw_leads) a
) b
""", "raw_leads"))(_triage)

register("triage_status", with_tables(f"""
SELECT triage_status, next_agent, count(*) AS leads FROM (
  SELECT CASE WHEN {O.blank('email')} OR {O.blank('company')} OR
              {O.spam_keyword(keywords=S.DEFAULT['scoring']['triage_spam_keywords'])} IS NOT NULL
              THEN 'rejected' ELSE 'accepted' END AS triage_status,
         CASE WHEN {O.blank('email')} OR {O.blank('company')} OR
              {O.spam_keyword(keywords=S.DEFAULT['scoring']['triage_spam_keywords'])} IS NOT NULL
              THEN 'none' ELSE 'mql_agent' END AS next_agent
  FROM raw_leads) t GROUP BY triage_status, next_agent
""", "raw_leads"))(
    lambda s, d: _triage(s, d).groupBy("triage_status", "next_agent").agg(F.count(F.lit(1)).alias("leads")))


# ----------------------------------------------------------------- M1-M9

_MP = O.mql_parts()
for _p in S.MQL_PARTS:
    def _one(s, d, _p=_p):
        return with_helpers(_leads(s, d)).select("lead_id", S.mql_parts()[_p].cast("int").alias("points"))
    register(f"mql_{_p}", with_tables(f"SELECT lead_id, CAST({_MP[_p]} AS INTEGER) AS points FROM raw_leads",
                                      "raw_leads"))(_one)

MQL_SQL = f"""
SELECT lead_id, {', '.join(f'CAST({_MP[p]} AS INTEGER) AS {p}' for p in S.MQL_PARTS)}
FROM raw_leads
"""


def _mql_score(s, d):
    sc = S.score_mql(_leads(s, d), keep=["lead_id"])
    return sc.select("lead_id", *[F.col(f"score_breakdown.{p}").alias(p) for p in S.MQL_PARTS],
                     "mql_score", "qualified")


register("mql_score", with_tables(f"""
SELECT *, {' + '.join(S.MQL_PARTS)} AS mql_score, ({' + '.join(S.MQL_PARTS)}) >= 50 AS qualified
FROM ({MQL_SQL}) m
""", "raw_leads"))(_mql_score)


# ----------------------------------------------------------------- B1-B8

_BP = O.bant_parts()
for _p in ("budget", "authority", "need", "timeline"):
    def _bone(s, d, _p=_p):
        return with_helpers(_leads(s, d)).select("lead_id", S.bant_parts()[_p].cast("int").alias("points"))
    register(f"bant_{_p}", with_tables(f"SELECT lead_id, CAST({_BP[_p]} AS INTEGER) AS points FROM raw_leads",
                                       "raw_leads"))(_bone)

register("timeline_days", with_tables(f"""
SELECT lead_id, message, {O.timeline_days()} AS timeline_days FROM raw_leads
""", "raw_leads"))(lambda s, d: with_helpers(_leads(s, d)).select("lead_id", "message", S.timeline_days().alias("timeline_days")))

_EMP = O.company_employees()
BANT_SQL = f"""
SELECT lead_id, b, a, n, t, b + a + n + t AS sql_score, (b + a + n + t) >= 70 AS qualified,
  CASE WHEN emp >= 1000 AND n >= 15 THEN '$200K+' WHEN emp >= 1000 THEN '$50K-$200K'
       WHEN emp >= 200 THEN '$10K-$50K' ELSE '<$10K' END AS estimated_deal_size,
  CAST(CAST({SQL_AS_OF} AS DATE) + CAST(CASE t WHEN 25 THEN 30 WHEN 20 THEN 90 WHEN 10 THEN 180
       WHEN 5 THEN 365 END AS INTEGER) AS DATE) AS estimated_close_date,
  CASE WHEN emp >= 1000 THEN 'enterprise_sales' WHEN emp >= 200 THEN 'mid_market_sales'
       ELSE 'smb_sales' END AS assigned_team
FROM (SELECT lead_id, {_EMP} AS emp, CAST({_BP['budget']} AS INTEGER) AS b,
             CAST({_BP['authority']} AS INTEGER) AS a, CAST({_BP['need']} AS INTEGER) AS n,
             CAST({_BP['timeline']} AS INTEGER) AS t FROM raw_leads) x
"""


def _bant(s, d):
    return S.score_bant(_leads(s, d), as_of=AS_OF, keep=["lead_id"]).select(
        "lead_id", F.col("bant_score_budget").alias("b"), F.col("bant_score_authority").alias("a"),
        F.col("bant_score_need").alias("n"), F.col("bant_score_timeline").alias("t"), "sql_score",
        "qualified", "estimated_deal_size", "estimated_close_date", "assigned_team")


register("bant_score", with_tables(BANT_SQL, "raw_leads"))(_bant)
register("deal_size", with_tables(f"""
SELECT estimated_deal_size, count(*) AS leads FROM ({BANT_SQL}) x GROUP BY estimated_deal_size
""", "raw_leads"))(lambda s, d: _bant(s, d).groupBy("estimated_deal_size").agg(F.count(F.lit(1)).alias("leads")))
register("close_date", with_tables(f"""
SELECT estimated_close_date, count(*) AS leads FROM ({BANT_SQL}) x GROUP BY estimated_close_date
""", "raw_leads"))(lambda s, d: _bant(s, d).groupBy("estimated_close_date").agg(F.count(F.lit(1)).alias("leads")))
register("assign_team", with_tables(f"""
SELECT lead_id, {_EMP} AS employees,
  CASE WHEN {_EMP} >= 1000 THEN 'enterprise_sales' WHEN {_EMP} >= 200 THEN 'mid_market_sales'
       ELSE 'smb_sales' END AS assigned_team
FROM raw_leads
""", "raw_leads"))(lambda s, d: with_helpers(_leads(s, d)).select("lead_id", S.employees().alias("employees"),
                                                    S.assign_team_col().alias("assigned_team")))


# ----------------------------------------------------------------- W12, W13, M9, B8 (separate keys)

register("screen_scores", with_tables(f"""
SELECT lead_id, bot_score, quality_score FROM ({SCREEN_SQL}) x
""", "raw_leads"))(lambda s, d: screened(s, d).select("lead_id", "bot_score", "quality_score"))

register("risk_level", with_tables(f"""
SELECT lead_id, bot_score, risk_level FROM ({SCREEN_SQL}) x
""", "raw_leads"))(lambda s, d: screened(s, d).select("lead_id", "bot_score", "risk_level"))

_TRIAGE_OK = (f"NOT ({O.blank('email')} OR {O.blank('company')} OR "
              f"{O.spam_keyword(keywords=S.DEFAULT['scoring']['triage_spam_keywords'])} IS NOT NULL)")


def _triaged(s, d):
    t = S.triage_leads(_leads(s, d))
    return t.filter(F.col("decision") == "accepted")


def mql_route(s, d):
    """M9: MQL scoring of triage-accepted leads; qualified -> status mql, else the lead
    stays accepted and goes to nurture."""
    sc = S.score_mql(_triaged(s, d), keep=["lead_id"])
    return sc.select("lead_id", "mql_score", F.when(F.col("qualified"), "mql").otherwise("accepted")
                     .alias("new_status"), (~F.col("qualified")).alias("nurture"))


register("mql_route", with_tables(f"""
SELECT lead_id, mql_score, CASE WHEN mql_score >= 50 THEN 'mql' ELSE 'accepted' END AS new_status,
       mql_score < 50 AS nurture
FROM (SELECT lead_id, CAST({' + '.join(_MP[p] for p in S.MQL_PARTS)} AS INTEGER) AS mql_score
      FROM raw_leads WHERE {_TRIAGE_OK}) m
""", "raw_leads"))(mql_route)


def bant_route(s, d):
    """BANT scoring of MQL-qualified leads; qualified -> status sql, else back to mql."""
    m = S.score_mql(_triaged(s, d)).filter("qualified").drop("qualified", "score_breakdown", "mql_score")
    sc = S.score_bant(m, as_of=AS_OF, keep=["lead_id"])
    return sc.select("lead_id", "sql_score", F.when(F.col("qualified"), "sql").otherwise("mql").alias("new_status"),
                     "estimated_deal_size")


register("bant_route", with_tables(f"""
SELECT lead_id, sql_score, CASE WHEN sql_score >= 70 THEN 'sql' ELSE 'mql' END AS new_status, estimated_deal_size
FROM (SELECT lead_id, b + a + n + t AS sql_score,
        CASE WHEN emp >= 1000 AND n >= 15 THEN '$200K+' WHEN emp >= 1000 THEN '$50K-$200K'
             WHEN emp >= 200 THEN '$10K-$50K' ELSE '<$10K' END AS estimated_deal_size
      FROM (SELECT lead_id, {_EMP} AS emp, CAST({_BP['budget']} AS INTEGER) AS b,
                   CAST({_BP['authority']} AS INTEGER) AS a, CAST({_BP['need']} AS INTEGER) AS n,
                   CAST({_BP['timeline']} AS INTEGER) AS t
            FROM raw_leads WHERE {_TRIAGE_OK}
              AND CAST({' + '.join(_MP[p] for p in S.MQL_PARTS)} AS INTEGER) >= 50) x) y
""", "raw_leads"))(bant_route)
