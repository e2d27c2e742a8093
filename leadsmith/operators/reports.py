"""Funnel analytics and reports.

Every report is one scan per input table, filters first (pushed to Parquet),
and single-pass conditional aggregates (``count_if``) so Spark runs one
partial + final hash aggregate per report.  Averages that later roll up are
carried as sum + count; rounding of ratios is exact (``round_ratio``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import AsOf, days_before, hours_between, round_ratio, ts

OPEN_SQL = ("sql_new", "contacted")
QUALIFIED = ("mql", "sql", "sales_owned")


def in_window(df: DataFrame, col: str, as_of: AsOf, days: int | None) -> DataFrame:
    """Rows with ``col`` in the last ``days`` days; on a lead table stored by capture day
    (``created_date`` partitions) the same bound also prunes the day folders."""
    if days is None:
        return df
    since = days_before(as_of, days)
    cond = F.col(col) >= since
    if col == "created_at" and "created_date" in df.columns:
        cond = (F.col("created_date") >= F.to_date(since)) & cond
    return df.filter(cond)


def _cnt(status: str, *values: str) -> Column:
    return F.count_if(F.col(status).isin(*values))


def _rate(num: Column, den: Column) -> Column:
    """Python-style ``round(num/den, 4)`` with ``0.0`` for an empty denominator."""
    return F.coalesce(round_ratio(num, den, 4, "half_even"), F.lit(0.0))


# --------------------------------------------------------------------- A1, A2, A16

def funnel_stats(leads: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """A1: current-status counts of leads captured in the last ``days`` days."""
    return (in_window(leads, "created_at", as_of, days)
            .groupBy("status").agg(F.count(F.lit(1)).alias("count")))


def _funnel_counts(cumulative: bool) -> list[Column]:
    s = "status"
    if cumulative:  # "reached at least this stage"
        return [
            F.count(F.lit(1)).alias("leads_captured"),
            _cnt(s, "rejected").alias("leads_rejected"),
            _cnt(s, "accepted", *QUALIFIED).alias("leads_accepted"),
            _cnt(s, *QUALIFIED).alias("leads_mql"),
            _cnt(s, "sql", "sales_owned").alias("leads_sql"),
            _cnt(s, "sales_owned").alias("leads_sales_owned"),
        ]
    return [
        F.count(F.lit(1)).alias("leads_captured"),
        _cnt(s, "rejected").alias("leads_rejected"),
        _cnt(s, "accepted").alias("leads_accepted"),
        _cnt(s, "mql").alias("leads_mql"),
        _cnt(s, "sql").alias("leads_sql"),
        _cnt(s, "sales_owned").alias("leads_sales_owned"),
    ]


def _funnel_rates() -> list[Column]:
    c = F.col
    return [
        _rate(c("leads_accepted"), c("leads_captured")).alias("acceptance_rate"),
        _rate(c("leads_mql"), c("leads_accepted")).alias("mql_conversion_rate"),
        _rate(c("leads_sql"), c("leads_mql")).alias("sql_conversion_rate"),
        _rate(c("leads_sales_owned"), c("leads_sql")).alias("sales_conversion_rate"),
        _rate(c("leads_sales_owned"), c("leads_captured")).alias("overall_funnel_rate"),
    ]


def funnel_metrics(leads: DataFrame, as_of: AsOf = None, days: int | None = 30,
                   by: Sequence[str] | None = None, cumulative: bool = False) -> DataFrame:
    """A2 (and A16 with ``by=['industry']``): volumes and five conversion rates.

    Counts are of *current* status, as the reference computes them, so
    ``mql_conversion_rate`` may exceed 1; ``cumulative=True`` counts leads that
    reached at least each stage instead.
    """
    w = in_window(leads, "created_at", as_of, days)
    by = list(by or [])
    g = w.groupBy(*by).agg(*_funnel_counts(cumulative)) if by else w.agg(*_funnel_counts(cumulative))
    head = [F.lit(days).cast("int").alias("period_days")] if days is not None else []
    return g.select(*by, *head, "leads_captured", "leads_rejected", "leads_accepted", "leads_mql",
                    "leads_sql", "leads_sales_owned", *_funnel_rates())


# --------------------------------------------------------------------- A3, A4

def _stage_hours(leads: DataFrame, mql: DataFrame, sql: DataFrame, how: str) -> DataFrame:
    m = mql.select("lead_id", "mql_id", F.col("qualified_at").alias("mql_at"))
    s = sql.select("mql_id", F.col("qualified_at").alias("sql_at"), "handoff_at")
    return (leads.join(m, "lead_id", how).join(s, "mql_id", how)
            .withColumn("h_mql", hours_between("created_at", "mql_at"))
            .withColumn("h_sql", hours_between("mql_at", "sql_at"))
            .withColumn("h_handoff", hours_between("sql_at", "handoff_at")))


def funnel_velocity(leads: DataFrame, mql: DataFrame, sql: DataFrame, as_of: AsOf = None,
                    days: int = 30) -> DataFrame:
    """A3 (+A4): average whole hours lead->MQL, MQL->SQL and SQL->handoff (1 digit, 0 if none)."""
    w = in_window(leads, "created_at", as_of, days).select("lead_id", "created_at")
    j = _stage_hours(w, mql, sql, "left")
    aggs = []
    for h in ("h_mql", "h_sql", "h_handoff"):
        aggs += [F.sum(h).alias(f"{h}_sum"), F.count(h).alias(f"{h}_n")]
    g = j.agg(*aggs)

    def avg(h: str) -> Column:
        return F.coalesce(round_ratio(F.col(f"{h}_sum"), F.col(f"{h}_n"), 1, "half_even"), F.lit(0.0))

    return g.select(avg("h_mql").alias("avg_time_to_mql"), avg("h_sql").alias("avg_time_to_sql"),
                    avg("h_handoff").alias("avg_time_to_handoff"))


def handoff_velocity(sql: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """A4: average whole hours from SQL qualification to handoff."""
    h = hours_between("qualified_at", "handoff_at")
    by = list(by or [])
    aggs = [F.sum(h).alias("_s"), F.count(h).alias("handoffs")]
    g = sql.groupBy(*by).agg(*aggs) if by else sql.agg(*aggs)
    return g.select(*by, "handoffs",
                    F.coalesce(round_ratio(F.col("_s"), F.col("handoffs"), 1, "half_even"),
                               F.lit(0.0)).alias("avg_time_to_handoff"))


# --------------------------------------------------------------------- A5

def benchmark_flags(spark: SparkSession, metrics: DataFrame, ranges=None) -> DataFrame:
    """A5: each benchmarked metric against its target range (below / within / above)."""
    ranges = ranges or DEFAULT["analytics"]["benchmarks"]
    names = [r[0] for r in ranges]
    long = metrics.select(*[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        [], names, "metric", "value")
    rng = spark.createDataFrame([(n, float(lo), float(hi)) for n, lo, hi in ranges],
                                "metric string, target_low double, target_high double")
    # the range table is the fixed, config-sized benchmark list: broadcast is bounded
    return (long.join(F.broadcast(rng), "metric")
            .select("metric", "value", "target_low", "target_high",
                    F.when(F.col("value") < F.col("target_low"), "below")
                    .when(F.col("value") > F.col("target_high"), "above")
                    .otherwise("within").alias("assessment")))


# --------------------------------------------------------------------- A6, A7

TIMELINE_COLS = ["event_timestamp", "event_type", "agent_name", "from_status", "to_status",
                 "score_at_event"]


def lead_timeline(events: DataFrame, lead_id: str | DataFrame) -> DataFrame:
    """One lead's events in time order (a DataFrame of ids selects several)."""
    if isinstance(lead_id, DataFrame):
        ev = events.join(lead_id.select("lead_id"), "lead_id", "left_semi")
        return ev.select("lead_id", "event_id", *TIMELINE_COLS).orderBy(
            "lead_id", "event_timestamp", "event_id")
    return (events.filter(F.col("lead_id") == lead_id)
            .select("event_id", *TIMELINE_COLS).orderBy("event_timestamp", "event_id"))


def full_funnel(leads: DataFrame, mql: DataFrame, sql: DataFrame) -> DataFrame:
    """Raw leads with their MQL and SQL records (two left joins) and stage hours."""
    r = leads.select(
        "lead_id", F.col("created_at").alias("captured_at"), "source_channel", "source_campaign",
        "form_type", "first_name", "last_name", "email", "company", "job_title", "industry",
        "company_size", "country", F.col("status").alias("current_status"), "rejection_reason")
    m = mql.select("lead_id", "mql_id", "mql_score", "persona", "buying_stage",
                   F.col("qualified_at").alias("mql_qualified_at"),
                   F.col("confidence_score").alias("mql_confidence"))
    s = sql.select("mql_id", "sql_id", "sql_score", "bant_score_budget", "bant_score_authority",
                   "bant_score_need", "bant_score_timeline", "estimated_deal_size",
                   "estimated_close_date", "assigned_team", "assigned_rep_name",
                   F.col("qualified_at").alias("sql_qualified_at"), "handoff_confirmed",
                   F.col("status").alias("sql_status"))
    return (r.join(m, "lead_id", "left").join(s, "mql_id", "left")
            .withColumn("hours_to_mql", hours_between("captured_at", "mql_qualified_at"))
            .withColumn("hours_to_sql", hours_between("mql_qualified_at", "sql_qualified_at")))


FULL_FUNNEL_COLS = [
    "lead_id", "captured_at", "source_channel", "source_campaign", "form_type", "first_name",
    "last_name", "email", "company", "job_title", "industry", "company_size", "country",
    "current_status", "rejection_reason", "mql_id", "mql_score", "persona", "buying_stage",
    "mql_qualified_at", "mql_confidence", "sql_id", "sql_score", "bant_score_budget",
    "bant_score_authority", "bant_score_need", "bant_score_timeline", "estimated_deal_size",
    "estimated_close_date", "assigned_team", "assigned_rep_name", "sql_qualified_at",
    "handoff_confirmed", "sql_status", "hours_to_mql", "hours_to_sql",
]


# --------------------------------------------------------------------- A8-A14

def _pct(num: Column, den: Column) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), 1)`` computed exactly."""
    return round_ratio(num, den, 1, "half_up", scale=100)


def report_funnel_summary(leads: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Counts by status and the two stage rates in percent."""
    s = "status"
    g = in_window(leads, "created_at", as_of, days).agg(
        F.count(F.lit(1)).alias("total_leads"),
        _cnt(s, "accepted").alias("accepted"),
        _cnt(s, "rejected").alias("rejected"),
        _cnt(s, "mql").alias("mql"),
        _cnt(s, "sql").alias("sql_leads"),
        _cnt(s, "sales_owned").alias("sales_owned"),
        _cnt(s, *QUALIFIED).alias("_q"),
        _cnt(s, "sql", "sales_owned").alias("_s"),
    )
    return g.select("total_leads", "accepted", "rejected", "mql", "sql_leads", "sales_owned",
                    _pct(F.col("_q"), F.col("accepted")).alias("mql_rate_pct"),
                    _pct(F.col("_s"), F.col("mql")).alias("sql_rate_pct"))


def report_by_channel(leads: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Volume, accepted, qualified and qualification rate per source channel."""
    g = in_window(leads, "created_at", as_of, days).groupBy("source_channel").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("status").isin("rejected", "new")).alias("accepted"),
        _cnt("status", *QUALIFIED).alias("qualified"),
    )
    return (g.select("source_channel", "total", "accepted", "qualified",
                     _pct(F.col("qualified"), F.col("total")).alias("qual_rate_pct"))
            .orderBy(F.desc("total"), "source_channel"))


def report_mql_segments(mql: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """A10: MQLs by persona and buying stage."""
    return (in_window(mql, "created_at", as_of, days).groupBy("persona", "buying_stage")
            .agg(F.count(F.lit(1)).alias("total_mqls"), F.avg("mql_score").alias("avg_score"),
                 F.avg("confidence_score").alias("avg_confidence"))
            .orderBy(F.desc("total_mqls"), "persona", "buying_stage"))


def report_bant(sql: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """BANT averages by team and the count of ``$200K+`` deals."""
    return (in_window(sql, "created_at", as_of, days).groupBy("assigned_team")
            .agg(F.count(F.lit(1)).alias("total_sqls"),
                 F.avg("sql_score").alias("avg_bant_score"),
                 F.avg("bant_score_budget").alias("avg_budget"),
                 F.avg("bant_score_authority").alias("avg_authority"),
                 F.avg("bant_score_need").alias("avg_need"),
                 F.avg("bant_score_timeline").alias("avg_timeline"),
                 F.count_if(F.col("estimated_deal_size") == "$200K+").alias("enterprise_deals"))
            .orderBy(F.desc("avg_bant_score")))


def report_velocity(leads: DataFrame, mql: DataFrame, sql: DataFrame, as_of: AsOf = None,
                    days: int = 30) -> DataFrame:
    """Hours to MQL / SQL / total per channel over inner joins."""
    w = in_window(leads, "created_at", as_of, days).select("lead_id", "created_at", "source_channel")
    j = _stage_hours(w, mql, sql, "inner").withColumn(
        "h_total", hours_between("created_at", "sql_at"))
    g = j.groupBy("source_channel").agg(
        F.count(F.lit(1)).alias("leads"),
        F.sum("h_mql").alias("_m"), F.count("h_mql").alias("_mn"),
        F.sum("h_sql").alias("_s"), F.count("h_sql").alias("_sn"),
        F.sum("h_total").alias("_t"), F.count("h_total").alias("_tn"))
    return (g.select("source_channel", "leads",
                     round_ratio(F.col("_m"), F.col("_mn"), 1).alias("avg_hrs_to_mql"),
                     round_ratio(F.col("_s"), F.col("_sn"), 1).alias("avg_hrs_to_sql"),
                     round_ratio(F.col("_t"), F.col("_tn"), 1).alias("avg_total_hrs"))
            .orderBy("avg_total_hrs"))


def report_reps(sql: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """Per rep and team: SQLs, won, average BANT, big deals, confirmed handoffs."""
    return (in_window(sql, "created_at", as_of, days)
            .groupBy("assigned_rep_name", "assigned_team")
            .agg(F.count(F.lit(1)).alias("total_sqls"),
                 F.sum(F.when(F.col("status") == "closed_won", 1).otherwise(0)).cast("long")
                 .alias("closed_won"),
                 F.avg("sql_score").alias("avg_bant_score"),
                 F.count_if(F.col("estimated_deal_size") == "$200K+").alias("enterprise_deals"),
                 F.count_if(F.col("handoff_confirmed")).alias("confirmed_handoffs"))
            .orderBy(F.desc("total_sqls")))


def report_recent_funnel(funnel: DataFrame, as_of: AsOf = None, days: int = 7,
                         n: int = 20) -> DataFrame:
    """The newest ``n`` funnel rows of the last ``days`` days (top-k is the feature)."""
    return (in_window(funnel, "captured_at", as_of, days)
            .orderBy(F.desc("captured_at"), F.desc("lead_id")).limit(n))


# --------------------------------------------------------------------- A15, A17, A18

def stuck_leads(events: DataFrame, as_of: AsOf = None, days: int = 7,
                open_statuses: Sequence[str] | None = None) -> DataFrame:
    """Leads whose latest event (up to ``as_of``) left them in an open status
    for more than ``days`` days.  Latest event by ``max(struct(ts, id, status))`` —
    one hash aggregate, no sort, bounded state per lead."""
    open_statuses = list(open_statuses or DEFAULT["ours"]["stuck_statuses"])
    now = ts(as_of)
    last = (events.filter(F.col("event_timestamp") <= now)
            .groupBy("lead_id")
            .agg(F.max(F.struct("event_timestamp", "event_id", "to_status")).alias("_l")))
    return (last.select("lead_id", F.col("_l.to_status").alias("last_status"),
                        F.col("_l.event_timestamp").alias("last_event_at"))
            .filter(F.col("last_status").isin(*open_statuses)
                    & (F.col("last_event_at") < days_before(as_of, days)))
            .withColumn("days_stuck", F.timestamp_diff("DAY", F.col("last_event_at"), now)))


def pipeline_value(sql: DataFrame, midpoints: dict | None = None,
                   by: Sequence[str] = ("assigned_team",)) -> DataFrame:
    """Open pipeline value per team from deal-size label midpoints."""
    midpoints = midpoints or DEFAULT["ours"]["deal_size_midpoints"]
    value = None
    for label, v in midpoints.items():
        cond = F.col("estimated_deal_size") == label
        value = F.when(cond, F.lit(float(v))) if value is None else value.when(cond, F.lit(float(v)))
    open_ = sql.filter(~F.col("status").isin("closed_won", "closed_lost"))
    return (open_.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("open_sqls"),
                 F.coalesce(F.sum(value.otherwise(0.0)), F.lit(0.0)).alias("pipeline_value")))


def top_reps(sql: DataFrame) -> DataFrame:
    """The rep(s) with the most SQLs; ties are all kept.

    The per-rep counts are one row per rep; the maximum is a one-row aggregate
    broadcast back — no global window, no single-partition sort.
    """
    counts = sql.groupBy("assigned_rep_id", "assigned_rep_name").agg(
        F.count(F.lit(1)).alias("total_sqls"))
    best = counts.agg(F.max("total_sqls").alias("total_sqls"))
    return counts.join(F.broadcast(best), "total_sqls", "left_semi")


# --------------------------------------------------------------------- A19

PERIODS = ("daily", "weekly", "monthly")


def analytics_summary(leads: DataFrame, mql: DataFrame, sql: DataFrame, as_of: AsOf = None,
                      periods: Sequence[str] = PERIODS, midpoints: dict | None = None,
                      review_confidence: float | None = None) -> DataFrame:
    """The summary mart — period x start date x channel, plus all-channel rows.

    Plan: (1) one row per lead with its stage hours and scores (left joins on the
    keys), (2) pre-aggregate to (day, channel) with sums and counts — a partial
    aggregate, so the big shuffle carries one row per day and channel, (3) explode
    each (day, channel) into its period starts and roll up with GROUPING SETS.
    ``source_channel`` is NULL on the all-channel rows (``grouping`` tells them apart).
    """
    return summary_rollup(summary_partials(leads, mql, sql, midpoints, review_confidence), as_of, periods)


def summary_partials(leads: DataFrame, mql: DataFrame, sql: DataFrame, midpoints: dict | None = None,
                     review_confidence: float | None = None) -> DataFrame:
    """Mergeable sums (``s_…``) and counts (``n_…``) per capture day and channel."""
    midpoints = midpoints or DEFAULT["ours"]["deal_size_midpoints"]
    review_confidence = review_confidence or DEFAULT["ours"]["human_review_confidence"]
    m = mql.select("lead_id", "mql_id", F.col("qualified_at").alias("mql_at"), "mql_score",
                   "confidence_score")
    s = sql.select("mql_id", F.col("qualified_at").alias("sql_at"), "handoff_at", "sql_score",
                   "estimated_deal_size")
    value = None
    for label, v in midpoints.items():
        cond = F.col("estimated_deal_size") == label
        value = F.when(cond, F.lit(float(v))) if value is None else value.when(cond, F.lit(float(v)))
    st = F.col("status")
    per_lead = (leads.select("lead_id", "created_at", "source_channel", "status")
                .join(m, "lead_id", "left").join(s, "mql_id", "left")
                .select(F.to_date("created_at").alias("day"), "source_channel",
                        F.lit(1).alias("one"),
                        st.isin("accepted").cast("int").alias("acc"),
                        st.isin("rejected").cast("int").alias("rej"),
                        st.isin("mql").cast("int").alias("mq"),
                        st.isin("sql").cast("int").alias("sq"),
                        st.isin("sales_owned").cast("int").alias("own"),
                        hours_between("created_at", "mql_at").alias("h_mql"),
                        hours_between("mql_at", "sql_at").alias("h_sql"),
                        hours_between("sql_at", "handoff_at").alias("h_handoff"),
                        "mql_score", "sql_score", "confidence_score",
                        (F.col("confidence_score") < review_confidence).cast("int").alias("rev"),
                        value.alias("deal_value")))
    sums = ["one", "acc", "rej", "mq", "sq", "own", "h_mql", "h_sql", "h_handoff", "mql_score",
            "sql_score", "confidence_score", "rev", "deal_value"]
    counted = ["h_mql", "h_sql", "h_handoff", "mql_score", "sql_score", "confidence_score"]
    return per_lead.groupBy("day", "source_channel").agg(
        *[F.sum(c).alias(f"s_{c}") for c in sums], *[F.count(c).alias(f"n_{c}") for c in counted])


def summary_rollup(daily: DataFrame, as_of: AsOf = None, periods: Sequence[str] = PERIODS) -> DataFrame:
    """The summary rows of all periods in which the partials' days lie."""
    starts = []
    for p in periods:
        unit = {"daily": None, "weekly": "week", "monthly": "month"}[p]
        d = F.col("day") if unit is None else F.trunc("day", unit)
        starts.append(F.struct(F.lit(p).alias("report_period"), d.alias("report_date")))
    exploded = daily.select("*", F.inline(F.array(*starts)))
    measures = [c for c in exploded.columns if c.startswith(("s_", "n_"))]
    rolled = exploded.groupingSets(
        [["report_period", "report_date", "source_channel"], ["report_period", "report_date"]],
        "report_period", "report_date", "source_channel",
    ).agg(*[F.sum(c).alias(c) for c in measures],
          F.grouping("source_channel").alias("_all"))
    c = F.col

    def avg_hours(h: str) -> Column:
        return F.coalesce(round_ratio(c(f"s_{h}"), c(f"n_{h}"), 1, "half_even"), F.lit(0.0))

    def mean(x: str) -> Column:
        return c(f"s_{x}") / F.when(c(f"n_{x}") > 0, c(f"n_{x}"))

    key = F.concat_ws("|", c("report_period"), c("report_date").cast("string"),
                      F.coalesce(c("source_channel"), F.lit("*")))
    return rolled.select(
        F.concat(F.lit("SUM-"), F.upper(F.substring(F.sha2(key, 256), 1, 16))).alias("summary_id"),
        "report_date", "report_period", "source_channel",
        (c("_all") == 1).alias("all_channels"),
        c("s_one").alias("leads_captured"), c("s_acc").alias("leads_accepted"),
        c("s_rej").alias("leads_rejected"), c("s_mq").alias("leads_mql"),
        c("s_sq").alias("leads_sql"), c("s_own").alias("leads_sales_owned"),
        _rate(c("s_acc"), c("s_one")).alias("acceptance_rate"),
        _rate(c("s_mq"), c("s_acc")).alias("mql_conversion_rate"),
        _rate(c("s_sq"), c("s_mq")).alias("sql_conversion_rate"),
        _rate(c("s_own"), c("s_sq")).alias("sales_conversion_rate"),
        _rate(c("s_own"), c("s_one")).alias("overall_funnel_rate"),
        avg_hours("h_mql").alias("avg_time_to_mql"),
        avg_hours("h_sql").alias("avg_time_to_sql"),
        avg_hours("h_handoff").alias("avg_time_to_handoff"),
        mean("mql_score").alias("avg_mql_score"),
        mean("sql_score").alias("avg_sql_score"),
        mean("confidence_score").alias("avg_agent_confidence"),
        _rate(c("s_rev"), c("n_confidence_score")).alias("human_review_rate"),
        F.coalesce(c("s_deal_value"), F.lit(0.0)).alias("estimated_pipeline_value"),
        ts(as_of).alias("computed_at"),
        F.lit("scheduled_job").alias("computed_by"),
    )


# --------------------------------------------------------------------- A20-A22

def stage_durations(events: DataFrame) -> DataFrame:
    """Seconds spent before each stage (time since the lead's previous event).

    ``lag`` over (lead ordered by time, id); exact count/avg/min/max per
    (previous stage -> stage).  Use :func:`stage_duration_quantiles` for medians.
    """
    w = _with_previous(events)
    return (w.filter(F.col("prev_type").isNotNull())
            .groupBy("prev_type", "event_type")
            .agg(F.count(F.lit(1)).alias("transitions"),
                 F.avg("seconds").alias("avg_seconds"),
                 F.min("seconds").alias("min_seconds"),
                 F.max("seconds").alias("max_seconds")))


def _with_previous(events: DataFrame) -> DataFrame:
    """Each event with its lead's previous event (type, time); skew-safe two-level lag
    over day buckets, so a lead with a huge history is not one window partition."""
    from ..functions.windows import bucketed_lag

    ev = events.select("lead_id", "event_id", "event_type", "event_timestamp")
    w = bucketed_lag(ev, ["lead_id"], ["event_timestamp", "event_id"],
                     F.date_trunc("day", F.col("event_timestamp")), ["event_type", "event_timestamp"])
    return w.select("lead_id", "event_type", "event_timestamp", F.col("prev_event_type").alias("prev_type"),
                    F.timestamp_diff("SECOND", F.col("prev_event_timestamp"), F.col("event_timestamp"))
                    .alias("seconds"))


def stage_duration_quantiles(events: DataFrame) -> DataFrame:
    """A20 (bottlenecks): exact p50/p90 seconds per transition: the smallest duration that at least
    half (nine tenths) of the transitions do not exceed.

    Events are counted per (transition, seconds) first, so the running sum sees one row per
    distinct duration of a transition, not one per event."""
    pair = ["prev_type", "event_type"]
    counts = (_with_previous(events).filter(F.col("prev_type").isNotNull())
              .groupBy(*pair, "seconds").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy(*pair).orderBy("seconds").rowsBetween(Window.unboundedPreceding, 0)
    c = counts.select(*pair, "seconds", F.sum("n").over(upto).alias("upto"),
                      F.sum("n").over(Window.partitionBy(*pair)).alias("all"))
    return c.groupBy(*pair).agg(
        F.min(F.when(F.col("upto") * 2 >= F.col("all"), F.col("seconds"))).alias("p50_seconds"),
        F.min(F.when(F.col("upto") * 10 >= F.col("all") * 9, F.col("seconds"))).alias("p90_seconds"))


#: Leading bits of a duration that its sketch bucket keeps: a value is known to 1 part in 2**7.
SKETCH_BITS = 7


def sketch_bucket(x: Column) -> Column:
    """The bucket of a non-negative whole number: its leading bits and how many were cut off (exact integer arithmetic)."""
    shift = F.greatest(F.lit(0), F.length(F.bin(x)) - (SKETCH_BITS + 1))
    return shift.cast("long") * (2 << SKETCH_BITS) + F.call_function("shiftright", x, shift)


def bucket_floor(bucket: Column) -> Column:
    """The smallest number of a bucket; the largest is less than 1 part in 2**SKETCH_BITS above it."""
    size = F.lit(2 << SKETCH_BITS)
    return F.call_function("shiftleft", bucket % size, F.floor(bucket / size).cast("int"))


def duration_sketches(events: DataFrame) -> DataFrame:
    """A20 on growing logs: mergeable sketches of the seconds before each stage, as counts per day of the event,
    transition and bucket.  Sketches of days, files or regions are merged by adding their counts."""
    w = _with_previous(events).filter(F.col("prev_type").isNotNull())
    return (w.select(F.to_date("event_timestamp").alias("day"), "prev_type", "event_type",
                     sketch_bucket(F.greatest(F.col("seconds"), F.lit(0)).cast("long")).alias("bucket"))
            .groupBy("day", "prev_type", "event_type", "bucket").agg(F.count(F.lit(1)).alias("n")))


def sketch_quantiles(sketches: DataFrame, by: Sequence[str] = ("prev_type", "event_type")) -> DataFrame:
    """p50 and p90 seconds from sketches alone: never above the exact ones, and less than 1 part in 2**SKETCH_BITS below.

    The window sees one row per bucket of a group: a few thousand at most, whatever the log's size."""
    merged = sketches.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*by)
    c = merged.select(*by, "bucket", F.sum("n").over(w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
                      F.sum("n").over(w).alias("all"))
    p50, p90 = (F.min(F.when(F.col("upto") * den >= F.col("all") * num, F.col("bucket"))) for num, den in ((1, 2), (9, 10)))
    return c.groupBy(*by).agg(F.max("all").alias("transitions"), bucket_floor(p50).alias("p50_seconds"), bucket_floor(p90).alias("p90_seconds"))


def human_review_rate(mql: DataFrame, by: Sequence[str] = (), threshold: float | None = None
                      ) -> DataFrame:
    """Share of MQL decisions below the review confidence."""
    threshold = threshold or DEFAULT["ours"]["human_review_confidence"]
    by = list(by)
    aggs = [F.count(F.lit(1)).alias("decisions"),
            F.count_if(F.col("confidence_score") < threshold).alias("needs_review")]
    g = mql.groupBy(*by).agg(*aggs) if by else mql.agg(*aggs)
    return g.select(*by, "decisions", "needs_review",
                    _rate(F.col("needs_review"), F.col("decisions")).alias("human_review_rate"))


def rep_workload(sql: DataFrame, reps: DataFrame) -> DataFrame:
    """Open SQLs per rep against capacity (reps left-joined to per-rep counts)."""
    open_ = (sql.filter(F.col("status").isin(*OPEN_SQL))
             .groupBy(F.col("assigned_rep_id").alias("rep_id"))
             .agg(F.count(F.lit(1)).alias("open_sqls")))
    return (reps.select("rep_id", "team", "is_active", "current_load", "max_load")
            .join(open_, "rep_id", "left")
            .select("rep_id", "team", "is_active", "current_load", "max_load",
                    F.coalesce(F.col("open_sqls"), F.lit(0)).cast("long").alias("open_sqls"))
            .withColumn("projected_load", F.col("current_load") + F.col("open_sqls"))
            .withColumn("capacity_left", F.col("max_load") - F.col("projected_load")))
