"""Registered queries: key -> (Spark plan over the test tables, DuckDB oracle text).

Every query reads the supplied tables (through the derived lead tables) and
runs over them whole.  Time-relative reports use the fixed ``AS_OF`` of the
fixtures so both engines see the same window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.common import sql_round_ratio
from ..operators import reports as R
from ..sources import fixtures as fx
from .oracle import with_tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

AS_OF = fx.AS_OF
SQL_AS_OF = f"TIMESTAMP '{AS_OF}'"


def _wrap_calls(sql: str, fname: str, cast: str) -> str:
    """Wrap every ``fname(...)`` call in ``CAST(... AS cast)`` (matching parentheses)."""
    out, i, token = [], 0, fname + "("
    while True:
        j = sql.find(token, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(token)])
            i = j + len(token)
            continue
        depth, k = 0, j + len(fname)
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _wrap_calls(sql[j + len(token):k], fname, cast)
        out.append(sql[i:j] + f"CAST({fname}({inner}) AS {cast})")
        i = k + 1


def duck_types(sql: str) -> str:
    """Align DuckDB result types with Spark's: ``count_if`` is BIGINT, JSON text is VARCHAR."""
    return _wrap_calls(_wrap_calls(sql, "count_if", "BIGINT"), "to_json", "VARCHAR")


def register(key: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = duck_types(oracle)
        return fn
    return deco


def win(col: str = "created_at", days: int = 30) -> str:
    return f"{col} >= {SQL_AS_OF} - INTERVAL {days} DAY"


def rate_sql(num: str, den: str) -> str:
    return f"coalesce({sql_round_ratio(num, den, 4, 'half_even')}, 0.0)"


def pct_sql(num: str, den: str) -> str:
    return sql_round_ratio(num, den, 1, "half_up", scale=100)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return fx.load_tables(spark, sf_dir)


# ----------------------------------------------------------------- reports A1-A22

register("funnel_stats", with_tables(f"""
SELECT status, count(*) AS "count" FROM raw_leads WHERE {win()} GROUP BY status
""", "raw_leads"))(lambda s, d: R.funnel_stats(fx.raw_leads(s, d), AS_OF, 30))


def _funnel_sql(where: str, by: list[str], cumulative: bool, period: int | None) -> str:
    if cumulative:
        acc, mql, sql = ("status IN ('accepted','mql','sql','sales_owned')",
                         "status IN ('mql','sql','sales_owned')", "status IN ('sql','sales_owned')")
    else:
        acc, mql, sql = "status = 'accepted'", "status = 'mql'", "status = 'sql'"
    keys = ", ".join(by)
    sel_keys = f"{keys}, " if by else ""
    group = f"GROUP BY {keys}" if by else ""
    head = f"CAST({period} AS INTEGER) AS period_days, " if period is not None else ""
    return f"""
SELECT {sel_keys}{head}leads_captured, leads_rejected, leads_accepted, leads_mql, leads_sql, leads_sales_owned,
  {rate_sql('leads_accepted', 'leads_captured')} AS acceptance_rate,
  {rate_sql('leads_mql', 'leads_accepted')} AS mql_conversion_rate,
  {rate_sql('leads_sql', 'leads_mql')} AS sql_conversion_rate,
  {rate_sql('leads_sales_owned', 'leads_sql')} AS sales_conversion_rate,
  {rate_sql('leads_sales_owned', 'leads_captured')} AS overall_funnel_rate
FROM (
  SELECT {sel_keys}count(*) AS leads_captured, count_if(status = 'rejected') AS leads_rejected,
    count_if({acc}) AS leads_accepted, count_if({mql}) AS leads_mql, count_if({sql}) AS leads_sql,
    count_if(status = 'sales_owned') AS leads_sales_owned
  FROM raw_leads {where} {group}
) g
"""


register("funnel_metrics", with_tables(_funnel_sql(f"WHERE {win()}", [], False, 30), "raw_leads"))(
    lambda s, d: R.funnel_metrics(fx.raw_leads(s, d), AS_OF, 30))
register("funnel_metrics_cumulative",
         with_tables(_funnel_sql(f"WHERE {win()}", [], True, 30), "raw_leads"))(
    lambda s, d: R.funnel_metrics(fx.raw_leads(s, d), AS_OF, 30, cumulative=True))
register("funnel_by_industry", with_tables(_funnel_sql("", ["industry"], False, None), "raw_leads"))(
    lambda s, d: R.funnel_metrics(fx.raw_leads(s, d), AS_OF, None, by=["industry"]))


def _velocity(s, d):
    t = tables(s, d)
    return R.funnel_velocity(t["raw_leads"], t["mql_leads"], t["sql_leads"], AS_OF, 30)


def _h(a: str, b: str) -> str:
    return f"date_sub('hour', {a}, {b})"


register("funnel_velocity", with_tables(f"""
SELECT
  coalesce({sql_round_ratio('sum(h1)', 'count(h1)', 1, 'half_even')}, 0.0) AS avg_time_to_mql,
  coalesce({sql_round_ratio('sum(h2)', 'count(h2)', 1, 'half_even')}, 0.0) AS avg_time_to_sql,
  coalesce({sql_round_ratio('sum(h3)', 'count(h3)', 1, 'half_even')}, 0.0) AS avg_time_to_handoff
FROM (
  SELECT {_h('r.created_at', 'm.qualified_at')} AS h1, {_h('m.qualified_at', 's.qualified_at')} AS h2,
         {_h('s.qualified_at', 's.handoff_at')} AS h3
  FROM raw_leads r LEFT JOIN mql_leads m ON r.lead_id = m.lead_id
       LEFT JOIN sql_leads s ON m.mql_id = s.mql_id
  WHERE {win('r.created_at')}
) j
""", "raw_leads", "mql_leads", "sql_leads"))(_velocity)

register("handoff_velocity", with_tables(f"""
SELECT count(h) AS handoffs,
       coalesce({sql_round_ratio('sum(h)', 'count(h)', 1, 'half_even')}, 0.0) AS avg_time_to_handoff
FROM (SELECT {_h('qualified_at', 'handoff_at')} AS h FROM sql_leads) x
""", "sql_leads"))(lambda s, d: R.handoff_velocity(fx.sql_leads(s, d)))


def _benchmarks(s, d):
    t = tables(s, d)
    m = R.funnel_metrics(t["raw_leads"], AS_OF, 30).crossJoin(
        R.funnel_velocity(t["raw_leads"], t["mql_leads"], t["sql_leads"], AS_OF, 30))
    return R.benchmark_flags(s, m)


def _bench_sql() -> str:
    from ..config import DEFAULT

    ranges = " UNION ALL ".join(
        f"SELECT '{n}' AS metric, CAST({lo} AS DOUBLE) AS target_low, CAST({hi} AS DOUBLE) AS target_high"
        for n, lo, hi in DEFAULT["analytics"]["benchmarks"])
    metrics = _funnel_sql(f"WHERE {win()}", [], False, 30)
    return with_tables(f"""
WITH fm AS ({metrics}),
vel AS (
  SELECT coalesce({sql_round_ratio('sum(h1)', 'count(h1)', 1, 'half_even')}, 0.0) AS avg_time_to_mql
  FROM (SELECT {_h('r.created_at', 'm.qualified_at')} AS h1
        FROM raw_leads r LEFT JOIN mql_leads m ON r.lead_id = m.lead_id WHERE {win('r.created_at')}) j
),
vals AS (
  SELECT 'mql_conversion_rate' AS metric, CAST(mql_conversion_rate AS DOUBLE) AS value FROM fm
  UNION ALL SELECT 'sql_conversion_rate', CAST(sql_conversion_rate AS DOUBLE) FROM fm
  UNION ALL SELECT 'avg_time_to_mql', CAST(avg_time_to_mql AS DOUBLE) FROM vel
  UNION ALL SELECT 'overall_funnel_rate', CAST(overall_funnel_rate AS DOUBLE) FROM fm
),
rng AS ({ranges})
SELECT v.metric, v.value, r.target_low, r.target_high,
  CASE WHEN v.value < r.target_low THEN 'below' WHEN v.value > r.target_high THEN 'above' ELSE 'within' END
    AS assessment
FROM vals v JOIN rng r ON v.metric = r.metric
""", "raw_leads", "mql_leads")


register("benchmark_flags", _bench_sql())(_benchmarks)

def _timeline(s, d):
    # every lead's timeline (a lookup of one lead is the same call with one id)
    return R.lead_timeline(fx.lead_events(s, d), fx.raw_leads(s, d).select("lead_id"))


register("lead_timeline", with_tables(f"""
SELECT lead_id, event_id, event_timestamp, event_type, agent_name, from_status, to_status, score_at_event
FROM lead_events WHERE lead_id IN (SELECT lead_id FROM raw_leads)
ORDER BY lead_id, event_timestamp, event_id
""", "raw_leads", "lead_events"))(_timeline)

_FF_SQL = f"""
SELECT r.lead_id, r.created_at AS captured_at, r.source_channel, r.source_campaign, r.form_type,
  r.first_name, r.last_name, r.email, r.company, r.job_title, r.industry, r.company_size, r.country,
  r.status AS current_status, r.rejection_reason, m.mql_id, m.mql_score, m.persona, m.buying_stage,
  m.qualified_at AS mql_qualified_at, m.confidence_score AS mql_confidence, s.sql_id, s.sql_score,
  s.bant_score_budget, s.bant_score_authority, s.bant_score_need, s.bant_score_timeline,
  s.estimated_deal_size, s.estimated_close_date, s.assigned_team, s.assigned_rep_name,
  s.qualified_at AS sql_qualified_at, s.handoff_confirmed, s.status AS sql_status,
  {_h('r.created_at', 'm.qualified_at')} AS hours_to_mql,
  {_h('m.qualified_at', 's.qualified_at')} AS hours_to_sql
FROM raw_leads r LEFT JOIN mql_leads m ON r.lead_id = m.lead_id LEFT JOIN sql_leads s ON m.mql_id = s.mql_id
"""


def _full_funnel(s, d):
    t = tables(s, d)
    return R.full_funnel(t["raw_leads"], t["mql_leads"], t["sql_leads"]).select(*R.FULL_FUNNEL_COLS)


register("full_funnel", with_tables(_FF_SQL, "raw_leads", "mql_leads", "sql_leads"))(_full_funnel)

register("report_funnel_summary", with_tables(f"""
SELECT total_leads, accepted, rejected, mql, sql_leads, sales_owned,
  {pct_sql('q', 'accepted')} AS mql_rate_pct, {pct_sql('s', 'mql')} AS sql_rate_pct
FROM (
  SELECT count(*) AS total_leads, count_if(status = 'accepted') AS accepted,
    count_if(status = 'rejected') AS rejected, count_if(status = 'mql') AS mql,
    count_if(status = 'sql') AS sql_leads, count_if(status = 'sales_owned') AS sales_owned,
    count_if(status IN ('mql','sql','sales_owned')) AS q, count_if(status IN ('sql','sales_owned')) AS s
  FROM raw_leads WHERE {win()}
) g
""", "raw_leads"))(lambda s, d: R.report_funnel_summary(fx.raw_leads(s, d), AS_OF, 30))

REPORT_BY_CHANNEL_SQL = with_tables(f"""
SELECT source_channel, total, accepted, qualified, {pct_sql('qualified', 'total')} AS qual_rate_pct
FROM (
  SELECT source_channel, count(*) AS total,
    count_if(status NOT IN ('rejected','new')) AS accepted,
    count_if(status IN ('mql','sql','sales_owned')) AS qualified
  FROM raw_leads WHERE {win()} GROUP BY source_channel
) g ORDER BY total DESC, source_channel
""", "raw_leads")
register("report_by_channel", REPORT_BY_CHANNEL_SQL)(
    lambda s, d: R.report_by_channel(fx.raw_leads(s, d), AS_OF, 30))

register("report_mql_segments", with_tables(f"""
SELECT persona, buying_stage, count(*) AS total_mqls, avg(mql_score) AS avg_score,
       avg(confidence_score) AS avg_confidence
FROM mql_leads WHERE {win()} GROUP BY persona, buying_stage
""", "mql_leads"))(lambda s, d: R.report_mql_segments(fx.mql_leads(s, d), AS_OF, 30))

register("report_bant", with_tables(f"""
SELECT assigned_team, count(*) AS total_sqls, avg(sql_score) AS avg_bant_score,
  avg(bant_score_budget) AS avg_budget, avg(bant_score_authority) AS avg_authority,
  avg(bant_score_need) AS avg_need, avg(bant_score_timeline) AS avg_timeline,
  count_if(estimated_deal_size = '$200K+') AS enterprise_deals
FROM sql_leads WHERE {win()} GROUP BY assigned_team
""", "sql_leads"))(lambda s, d: R.report_bant(fx.sql_leads(s, d), AS_OF, 30))


def _report_velocity(s, d):
    t = tables(s, d)
    return R.report_velocity(t["raw_leads"], t["mql_leads"], t["sql_leads"], AS_OF, 30)


register("report_velocity", with_tables(f"""
SELECT source_channel, count(*) AS leads,
  {sql_round_ratio('sum(h1)', 'count(h1)', 1)} AS avg_hrs_to_mql,
  {sql_round_ratio('sum(h2)', 'count(h2)', 1)} AS avg_hrs_to_sql,
  {sql_round_ratio('sum(h3)', 'count(h3)', 1)} AS avg_total_hrs
FROM (
  SELECT r.source_channel, {_h('r.created_at', 'm.qualified_at')} AS h1,
         {_h('m.qualified_at', 's.qualified_at')} AS h2, {_h('r.created_at', 's.qualified_at')} AS h3
  FROM raw_leads r JOIN mql_leads m ON r.lead_id = m.lead_id JOIN sql_leads s ON m.mql_id = s.mql_id
  WHERE {win('r.created_at')}
) j GROUP BY source_channel
""", "raw_leads", "mql_leads", "sql_leads"))(_report_velocity)

register("report_reps", with_tables(f"""
SELECT assigned_rep_name, assigned_team, count(*) AS total_sqls,
  CAST(sum(CASE WHEN status = 'closed_won' THEN 1 ELSE 0 END) AS BIGINT) AS closed_won,
  avg(sql_score) AS avg_bant_score,
  count_if(estimated_deal_size = '$200K+') AS enterprise_deals,
  count_if(handoff_confirmed = true) AS confirmed_handoffs
FROM sql_leads WHERE {win()} GROUP BY assigned_rep_name, assigned_team
""", "sql_leads"))(lambda s, d: R.report_reps(fx.sql_leads(s, d), AS_OF, 30))


def _recent(s, d):
    return R.report_recent_funnel(_full_funnel(s, d), AS_OF, 7, 20)


register("report_recent_funnel", with_tables(f"""
SELECT * FROM ({_FF_SQL}) ff WHERE {win('captured_at', 7)} ORDER BY captured_at DESC, lead_id DESC LIMIT 20
""", "raw_leads", "mql_leads", "sql_leads"))(_recent)

register("stuck_leads", with_tables(f"""
SELECT lead_id, to_status AS last_status, event_timestamp AS last_event_at,
       date_sub('day', event_timestamp, {SQL_AS_OF}) AS days_stuck
FROM (
  SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY event_timestamp DESC, event_id DESC) AS rn
  FROM lead_events WHERE event_timestamp <= {SQL_AS_OF}
) e
WHERE rn = 1 AND to_status IN ('new','processing','accepted','mql','sql')
  AND event_timestamp < {SQL_AS_OF} - INTERVAL 7 DAY
""", "lead_events"))(lambda s, d: R.stuck_leads(fx.lead_events(s, d), AS_OF, 7))

register("pipeline_value", with_tables("""
SELECT assigned_team, count(*) AS open_sqls,
  coalesce(sum(CASE estimated_deal_size WHEN '<$10K' THEN 5000.0 WHEN '$10K-$50K' THEN 30000.0
                WHEN '$50K-$200K' THEN 125000.0 WHEN '$200K+' THEN 200000.0 ELSE 0.0 END)::DOUBLE, 0.0)
    AS pipeline_value
FROM sql_leads WHERE status NOT IN ('closed_won','closed_lost') GROUP BY assigned_team
""", "sql_leads"))(lambda s, d: R.pipeline_value(fx.sql_leads(s, d)))

register("top_reps", with_tables("""
WITH c AS (SELECT assigned_rep_id, assigned_rep_name, count(*) AS total_sqls FROM sql_leads
           GROUP BY assigned_rep_id, assigned_rep_name)
SELECT * FROM c WHERE total_sqls = (SELECT max(total_sqls) FROM c)
""", "sql_leads"))(
    lambda s, d: R.top_reps(fx.sql_leads(s, d)))


def _summary(s, d):
    t = tables(s, d)
    return R.analytics_summary(t["raw_leads"], t["mql_leads"], t["sql_leads"], AS_OF)


def _summary_sql(source: str = "raw_leads", ctes: str = "") -> str:
    """The oracle of the summary over ``source``, a table or one of ``ctes``."""
    def avg_h(h: str) -> str:
        return f"coalesce({sql_round_ratio(f'sum({h})', f'count({h})', 1, 'half_even')}, 0.0)"

    body = f"""{ctes}
SELECT 'SUM-' || upper(substr(sha256(report_period || '|' || CAST(report_date AS VARCHAR) || '|' ||
         coalesce(source_channel, '*')), 1, 16)) AS summary_id,
  report_date, report_period, source_channel, (grouping(source_channel) = 1) AS all_channels,
  count(*) AS leads_captured, count_if(status = 'accepted') AS leads_accepted,
  count_if(status = 'rejected') AS leads_rejected, count_if(status = 'mql') AS leads_mql,
  count_if(status = 'sql') AS leads_sql, count_if(status = 'sales_owned') AS leads_sales_owned,
  {rate_sql("count_if(status = 'accepted')", 'count(*)')} AS acceptance_rate,
  {rate_sql("count_if(status = 'mql')", "count_if(status = 'accepted')")} AS mql_conversion_rate,
  {rate_sql("count_if(status = 'sql')", "count_if(status = 'mql')")} AS sql_conversion_rate,
  {rate_sql("count_if(status = 'sales_owned')", "count_if(status = 'sql')")} AS sales_conversion_rate,
  {rate_sql("count_if(status = 'sales_owned')", 'count(*)')} AS overall_funnel_rate,
  {avg_h('h1')} AS avg_time_to_mql, {avg_h('h2')} AS avg_time_to_sql, {avg_h('h3')} AS avg_time_to_handoff,
  avg(mql_score) AS avg_mql_score, avg(sql_score) AS avg_sql_score,
  avg(confidence_score) AS avg_agent_confidence,
  {rate_sql('count_if(confidence_score < 0.7)', 'count(confidence_score)')} AS human_review_rate,
  coalesce(sum(deal_value), 0.0)::DOUBLE AS estimated_pipeline_value,
  {SQL_AS_OF} AS computed_at, 'scheduled_job' AS computed_by
FROM (
  SELECT p.report_period,
    CAST(CASE p.report_period WHEN 'daily' THEN CAST(b.created_at AS DATE)
         WHEN 'weekly' THEN date_trunc('week', CAST(b.created_at AS DATE))
         ELSE date_trunc('month', CAST(b.created_at AS DATE)) END AS DATE) AS report_date,
    b.*
  FROM (
    SELECT r.source_channel, r.status, r.created_at, m.mql_score, s.sql_score, m.confidence_score,
      {_h('r.created_at', 'm.qualified_at')} AS h1, {_h('m.qualified_at', 's.qualified_at')} AS h2,
      {_h('s.qualified_at', 's.handoff_at')} AS h3,
      CASE s.estimated_deal_size WHEN '<$10K' THEN 5000.0 WHEN '$10K-$50K' THEN 30000.0
           WHEN '$50K-$200K' THEN 125000.0 WHEN '$200K+' THEN 200000.0 END AS deal_value
    FROM {source} r LEFT JOIN mql_leads m ON r.lead_id = m.lead_id LEFT JOIN sql_leads s ON m.mql_id = s.mql_id
  ) b CROSS JOIN (VALUES ('daily'), ('weekly'), ('monthly')) p(report_period)
) x
GROUP BY GROUPING SETS ((report_period, report_date, source_channel), (report_period, report_date))
"""
    return with_tables(body, "raw_leads", "mql_leads", "sql_leads")


register("analytics_summary", _summary_sql())(_summary)

_PREV_SQL = """
SELECT event_type, lag(event_type) OVER w AS prev_type,
       epoch(event_timestamp)::BIGINT - epoch(lag(event_timestamp) OVER w)::BIGINT AS seconds
FROM lead_events WINDOW w AS (PARTITION BY lead_id ORDER BY event_timestamp, event_id)
"""
register("stage_durations", with_tables(f"""
SELECT prev_type, event_type, count(*) AS transitions, avg(seconds) AS avg_seconds,
       min(seconds) AS min_seconds, max(seconds) AS max_seconds
FROM ({_PREV_SQL}) x WHERE prev_type IS NOT NULL GROUP BY prev_type, event_type
""", "lead_events"))(lambda s, d: R.stage_durations(fx.lead_events(s, d)))
register("stage_duration_quantiles", with_tables(f"""
SELECT prev_type, event_type, min(seconds) FILTER (WHERE upto * 2 >= total) AS p50_seconds,
       min(seconds) FILTER (WHERE upto * 10 >= total * 9) AS p90_seconds
FROM (SELECT *, row_number() OVER (PARTITION BY prev_type, event_type ORDER BY seconds) AS upto,
             count(*) OVER (PARTITION BY prev_type, event_type) AS total
      FROM ({_PREV_SQL}) x WHERE prev_type IS NOT NULL) y
GROUP BY prev_type, event_type
""", "lead_events"))(lambda s, d: R.stage_duration_quantiles(fx.lead_events(s, d)))

register("human_review_rate", with_tables(f"""
SELECT count(*) AS decisions, count_if(confidence_score < 0.7) AS needs_review,
  {rate_sql('count_if(confidence_score < 0.7)', 'count(*)')} AS human_review_rate
FROM mql_leads
""", "mql_leads"))(lambda s, d: R.human_review_rate(fx.mql_leads(s, d)))


def _workload(s, d):
    t = tables(s, d)
    return R.rep_workload(t["sql_leads"], t["sales_reps"])


register("rep_workload", with_tables("""
SELECT r.rep_id, r.team, r.is_active, r.current_load, r.max_load,
  CAST(coalesce(o.open_sqls, 0) AS BIGINT) AS open_sqls,
  r.current_load + CAST(coalesce(o.open_sqls, 0) AS BIGINT) AS projected_load,
  r.max_load - (r.current_load + CAST(coalesce(o.open_sqls, 0) AS BIGINT)) AS capacity_left
FROM sales_reps r LEFT JOIN (
  SELECT assigned_rep_id AS rep_id, count(*) AS open_sqls FROM sql_leads
  WHERE status IN ('sql_new','contacted') GROUP BY assigned_rep_id) o ON r.rep_id = o.rep_id
""", "sql_leads", "sales_reps"))(_workload)

