"""Lead tables derived from the supplied star-schema tables.

There is no lead data in the test tables, so the lead model (raw leads, MQL and
SQL records, reps, agent tool calls, lifecycle events) is derived from
``orders``/``customer``/``supplier``/``events`` with integer arithmetic only.
The same derivation is written in DuckDB SQL (``leadsmith.plans.oracle``) so
both engines see identical inputs.  ``k`` below is ``o_orderkey``.

Everything is a narrow projection over one scan (plus one key join for
``raw_leads``), so Parquet column pruning and filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT

AS_OF = "2001-08-02 00:00:00"

# Fixed values of the derivation (shared with the DuckDB oracle text).
CHANNELS = ["linkedin", "twitter", "referral", "event", "paid_search"]  # k % 10 = 0..4, else web_form
FORM_BY_PRIORITY = ["demo_request", "contact_us", "free_trial", "whitepaper_download", "newsletter_signup"]
STATUS_BY_K20 = (["rejected"] * 6 + ["accepted"] * 6 + ["mql"] * 4 + ["sql"] * 2
                 + ["sales_owned", "processing"])
INDUSTRY_BY_SEGMENT = {
    "AUTOMOBILE": "Manufacturing", "BUILDING": "Financial Services",
    "FURNITURE": "Healthcare", "HOUSEHOLD": "Other", "MACHINERY": "Technology",
}
JOB_TITLES = ["VP of Engineering", "Director", "Analyst", "", "CTO",
              "Engineering Manager", "Head of Sales", "Chief Financial Officer"]
FIRST_NAMES = ["Alice", "Bob", "Carlos", "Dana", "test", "Eve", "John", "Priya", "", "Zo", "Mei"]
LAST_NAMES = ["Smith", "Nguyen", "Garcia", "Lee", "Doe", "user", "Okafor", "Kim", "Brown", "",
              "Aa", "Schmidt", "Patel"]
MESSAGES = [
    "We need pricing for 200 seats and a demo asap",
    "Looking for a platform to replace our legacy warehouse within 45 days",
    "Our budget is approved; procurement needs a quote within 2 weeks",
    "Click here to claim your free money, you are a winner",
    "Please call me, SSN 123-45-6789 attached for verification",
    "Card 4111 1111 1111 1111 for the trial purchase",
    "just curious",
    "",
    "We are evaluating vendors and struggling with data quality problems across many teams",
    "We are evaluating vendors and struggling with data quality problems across many teams today",
    "Interested in a product demo for our team within 3 months",
    "Contact me at jane.roe@example.com or +1 (555) 123-4567 about integrate options",
    "This is a test message for the latest release",
    "Our passport office id AB1234567 needs a trial",
    "Need to migrate and integrate the pipeline urgently, budget ready",
    "Hello there, what is the price",
]
PERSONAS = ["technical_buyer", "economic_buyer", "champion", "end_user"]
STAGES = ["awareness", "consideration", "decision"]
DEAL_SIZES = ["<$10K", "$10K-$50K", "$50K-$200K", "$200K+"]
TEAMS = ["enterprise_sales", "mid_market_sales", "smb_sales"]
SQL_STATUSES = ["sql_new", "contacted", "closed_won", "closed_lost", "sql_new"]
AGENT_BY_EVENT = {"view": "WebFormAgent", "click": "TriageAgent", "signup": "MQLAgent",
                  "purchase": "SQLAgent", "error": "AnalyticsAgent"}
# the tool names of the configured allow-list, in name order
TOOLS = sorted({t for tools in DEFAULT["policies"]["expected_tools_per_agent"].values() for t in tools})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_text(k):
    """A key as text of at least eight digits; longer keys keep all theirs."""
    return F.when(k < 100_000_000, F.lpad(k.cast("string"), 8, "0")).otherwise(k.cast("string"))


def _memo(fn):
    """Build each derived table once per session and folder.  Only the (lazy) plan is
    kept — no data is cached — so repeated queries skip re-building wide projections."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        memo = spark.__dict__.setdefault("_leadsmith_tables", {})
        key = (fn.__name__, sf_dir)
        if key not in memo:
            memo[key] = fn(spark, sf_dir)
        return memo[key]
    return wrapper


def _spread(df: DataFrame) -> DataFrame:
    from ..functions.common import spread

    return spread(df)


def _pick(index: Column, values: list) -> Column:
    """values[index] as a CASE chain (keeps the expression inside codegen)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v)
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def _seconds(ts: Column, n: Column) -> Column:
    return F.timestamp_add("SECOND", n.cast("int"), ts)


def _lead_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


@_memo
def raw_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _spread(_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"))
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("o_orderkey")
    cust = F.col("o_custkey")
    created = _seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    status = _pick(k % 20, STATUS_BY_K20)
    domain = (F.when(cust % 4 == 0, F.lit("gmail.com"))
              .when(cust % 4 == 1, F.lit("yahoo.com"))
              .otherwise(F.concat(F.lit("corp"), F.col("c_nationkey").cast("string"), F.lit(".com"))))
    price = F.col("o_totalprice")
    size = (F.when(price >= 400000, "5000+").when(price >= 300000, "1001-5000")
            .when(price >= 200000, "201-1000").when(price >= 100000, "51-200").otherwise("11-50"))
    industry = F.coalesce(
        _pick_map(F.col("c_mktsegment"), INDUSTRY_BY_SEGMENT), F.lit("Other"))
    priority = F.substring(F.col("o_orderpriority"), 1, 1).cast("int")
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return joined.select(
        F.concat(F.lit("LD-"), _lead_date(F.col("o_orderdate")), F.lit("-"),
                 key_text(k)).alias("lead_id"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.when(k % 10 < 5, _pick(k % 10, CHANNELS)).otherwise(F.lit("web_form")).alias("source_channel"),
        F.concat(F.lit("campaign_"), (k % 5).cast("string")).alias("source_campaign"),
        _pick(priority - 1, FORM_BY_PRIORITY).alias("form_type"),
        _pick(k % 11, FIRST_NAMES).alias("first_name"),
        _pick(k % 13, LAST_NAMES).alias("last_name"),
        F.concat(F.lit("user"), cust.cast("string"), F.lit("@"), domain).alias("email"),
        F.when(k % 3 != 0, F.concat(F.lit("+1-555-"), F.lpad((k % 10000).cast("string"), 4, "0")))
        .alias("phone"),
        F.when(k % 5 != 0, F.concat(F.lit("https://linkedin.com/in/user"), cust.cast("string")))
        .alias("linkedin_url"),
        F.when(k % 9 != 0, F.col("c_name")).alias("company"),
        _pick(k % 8, JOB_TITLES).alias("job_title"),
        size.alias("company_size"),
        industry.alias("industry"),
        F.lit("US").alias("country"),
        _pick(k % 16, MESSAGES).alias("message"),
        (k % 2 == 0).alias("opt_in_marketing"),
        status.alias("status"),
        F.when(status == "rejected", _pick(k % 3, ["spam", "incomplete_data", "invalid_email"]))
        .alias("rejection_reason"),
        _seconds(created, -(k % 12)).alias("page_load_time"),
    )


def _pick_map(col: Column, mapping: dict) -> Column:
    expr = None
    for key, v in mapping.items():
        expr = F.when(col == key, F.lit(v)) if expr is None else expr.when(col == key, F.lit(v))
    return expr


def _orders_k(spark: SparkSession, sf_dir: str, statuses: tuple[int, ...]) -> DataFrame:
    """Orders whose derived status (k % 20) is in ``statuses`` — pushed as a filter."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return _spread(o.filter((F.col("o_orderkey") % 20).isin(*statuses)))


@_memo
def mql_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MQL records for leads whose status is mql / sql / sales_owned (k % 20 in 12..18)."""
    o = _orders_k(spark, sf_dir, tuple(range(12, 19)))
    k = F.col("o_orderkey")
    created = _seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    qualified = _seconds(created, 600 + (k * 104729) % 172800)
    lead_id = F.concat(F.lit("LD-"), _lead_date(F.col("o_orderdate")), F.lit("-"),
                       key_text(k))
    conf = ((32 + k % 33) / 64.0)
    return o.select(
        F.concat(F.lit("MQL-"), F.substring(lead_id, 4, 100)).alias("mql_id"),
        lead_id.alias("lead_id"),
        (50 + k % 51).cast("int").alias("mql_score"),
        _pick(k % 4, PERSONAS).alias("persona"),
        _pick(k % 3, STAGES).alias("buying_stage"),
        conf.alias("confidence_score"),
        (conf < 0.7).alias("human_reviewed"),
        F.lit("mql_new").alias("status"),
        qualified.alias("qualified_at"),
        qualified.alias("created_at"),
    )


@_memo
def sql_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL (sales-qualified) records for leads with status sql / sales_owned (k % 20 in 16..18)."""
    o = _orders_k(spark, sf_dir, (16, 17, 18))
    k = F.col("o_orderkey")
    created = _seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    mql_q = _seconds(created, 600 + (k * 104729) % 172800)
    qualified = _seconds(mql_q, 3600 + (k * 15485863) % 432000)
    lead_id = F.concat(F.lit("LD-"), _lead_date(F.col("o_orderdate")), F.lit("-"),
                       key_text(k))
    mql_id = F.concat(F.lit("MQL-"), F.substring(lead_id, 4, 100))
    budget = (10 + k % 16).cast("int")
    authority = (10 + (k * 7) % 16).cast("int")
    need = (10 + (k * 11) % 16).cast("int")
    timeline = (10 + (k * 13) % 16).cast("int")
    confirmed = k % 2 == 0
    rep = k % 10
    return o.select(
        F.concat(F.lit("SQL-"), F.substring(mql_id, 5, 100)).alias("sql_id"),
        mql_id.alias("mql_id"),
        lead_id.alias("lead_id"),
        (budget + authority + need + timeline).alias("sql_score"),
        budget.alias("bant_score_budget"),
        authority.alias("bant_score_authority"),
        need.alias("bant_score_need"),
        timeline.alias("bant_score_timeline"),
        _pick(k % 4, DEAL_SIZES).alias("estimated_deal_size"),
        F.date_add(F.to_date(qualified), (30 * (1 + k % 4)).cast("int")).alias("estimated_close_date"),
        _pick(k % 3, TEAMS).alias("assigned_team"),
        F.concat(F.lit("REP"), F.lpad(rep.cast("string"), 3, "0")).alias("assigned_rep_id"),
        F.concat(F.lit("Rep "), F.lpad(rep.cast("string"), 3, "0")).alias("assigned_rep_name"),
        confirmed.alias("handoff_confirmed"),
        F.when(confirmed, _seconds(qualified, k % 7200)).alias("handoff_at"),
        _pick(k % 5, SQL_STATUSES).alias("status"),
        qualified.alias("qualified_at"),
        qualified.alias("created_at"),
    )


@_memo
def sales_reps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    key = F.col("s_suppkey")
    num = F.when(key < 1000, F.lpad(key.cast("string"), 3, "0")).otherwise(key.cast("string"))
    rep_id = F.concat(F.lit("REP"), num)
    return s.select(
        rep_id.alias("rep_id"),
        F.lit("Rep").alias("first_name"),
        num.alias("last_name"),
        F.concat(F.lower(rep_id), F.lit("@sales.example.com")).alias("email"),
        _pick(key % 3, TEAMS).alias("team"),
        (key % 7 != 0).alias("is_active"),
        (F.floor(F.abs(F.col("s_acctbal"))).cast("long") % 60).cast("int").alias("current_load"),
        F.lit(50).alias("max_load"),
    )


@_memo
def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agent tool-call log: one row per event (run = user)."""
    e = _spread(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value"))
    eid = F.col("event_id")
    ok = eid % 50 != 0
    return e.select(
        eid.alias("call_id"),
        F.concat(F.lit("RUN-"), F.col("user_id").cast("string")).alias("lead_id"),
        F.col("ts"),
        _pick_map(F.col("event_type"), AGENT_BY_EVENT).alias("agent"),
        _pick(eid % 4, TOOLS).alias("tool"),
        (F.col("value") / 2000.0).alias("cost_usd"),
        F.floor(F.col("value") * 10).cast("long").alias("duration_ms"),
        F.when(ok, F.lit("success")).otherwise(F.lit("error: timeout")).alias("status"),
    )


@_memo
def lead_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only lifecycle events: one row per lead and reached stage.

    Derived from orders alone (status, timestamps are functions of k), then
    unpivoted with ``inline`` — one pass, no join, no shuffle.
    """
    o = _spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    k = F.col("o_orderkey")
    created = _seconds(F.col("o_orderdate"), (k * 7919) % 86400)
    mql_q = _seconds(created, 600 + (k * 104729) % 172800)
    sql_q = _seconds(mql_q, 3600 + (k * 15485863) % 432000)
    handoff = _seconds(sql_q, k % 7200)
    lead_id = F.concat(F.lit("LD-"), _lead_date(F.col("o_orderdate")), F.lit("-"),
                       key_text(k))
    r = k % 20
    triage_status = F.when(r < 6, "rejected").when(r == 19, "processing").otherwise("accepted")
    triage_ts = _seconds(created, 30 + k % 300)

    def ev(seq: int, etype: str, ts: Column, frm, to, agent: str, score, keep: Column) -> Column:
        return F.when(keep, F.struct(
            F.lit(seq).alias("seq"), F.lit(etype).alias("event_type"), ts.alias("event_timestamp"),
            (frm if isinstance(frm, Column) else F.lit(frm).cast("string")).alias("from_status"),
            (to if isinstance(to, Column) else F.lit(to)).alias("to_status"),
            F.lit(agent).alias("agent_name"),
            (score if isinstance(score, Column) else F.lit(score)).cast("int").alias("score_at_event"),
        ))

    from ..functions.common import compact

    events = compact([
        ev(1, "lead_captured", created, None, "new", "WebFormAgent", None, F.lit(True)),
        ev(2, "triage_completed", triage_ts, "processing", triage_status, "TriageAgent", None, F.lit(True)),
        ev(3, "mql_qualified", mql_q, "accepted", "mql", "MQLAgent", 50 + k % 51, (r >= 12) & (r <= 18)),
        ev(4, "sql_qualified", sql_q, "mql", "sql", "SQLAgent", 40 + k % 61, (r >= 16) & (r <= 18)),
        ev(5, "sales_assigned", handoff, "sql", "sales_owned", "SQLAgent", None, r == 18),
    ])
    return (o.select(lead_id.alias("lead_id"), k.alias("_k"), F.inline(events))
            .select(
                F.concat(F.lit("EVT-"), F.date_format("event_timestamp", "yyyyMMdd"), F.lit("-"),
                         key_text(F.col("_k")), F.lit("-"),
                         F.col("seq").cast("string")).alias("event_id"),
                "lead_id", "event_timestamp", "event_type", "from_status", "to_status",
                "agent_name", "score_at_event",
            ))


@_memo
def lead_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lead_id and created_at of every lead, from orders alone (no customer join)."""
    o = _spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("LD-"), _lead_date(F.col("o_orderdate")), F.lit("-"),
                 key_text(k)).alias("lead_id"),
        _seconds(F.col("o_orderdate"), (k * 7919) % 86400).alias("created_at"))


def load_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "raw_leads": raw_leads(spark, sf_dir),
        "mql_leads": mql_leads(spark, sf_dir),
        "sql_leads": sql_leads(spark, sf_dir),
        "sales_reps": sales_reps(spark, sf_dir),
        "tool_calls": tool_calls(spark, sf_dir),
        "lead_events": lead_events(spark, sf_dir),
    }
