"""Whole-batch qualification and lead lifecycle.

``qualify_leads`` is the set-oriented form of the reference's per-lead run:
every stage is a column computed for all leads in one projection, and the only
ordered, stateful step (the duplicate lookback) is P9, fed
with the status each lead's run would leave behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import AsOf
from ..functions.helpers import drop_helpers, with_helpers
from ..session import staged as staged_table
from . import policies as P
from . import routing as R
from . import scoring as S
from . import screening as W

# ----------------------------------------------------------------- S4

def gen_id(prefix: str, at: Column, *key_cols: Column | str) -> Column:
    """``PREFIX-YYYYMMDD-XXXXXXXX`` — 8 upper hex of SHA-256 over the key, so a
    retried job produces the same id.  It is for display: records are joined on ``long_key``."""
    return F.concat_ws("-", F.lit(prefix), F.date_format(at, "yyyyMMdd"), F.substring(long_key(*key_cols), 1, 8))


def long_key(*key_cols: Column | str) -> Column:
    """All 64 upper hex digits of the SHA-256 that the display id shows 8 of."""
    key = F.concat_ws("|", *[F.col(c) if isinstance(c, str) else c for c in key_cols])
    return F.upper(F.sha2(key, 256))


# ----------------------------------------------------------------- F1, F2

def stage_columns(leads: DataFrame, reps: DataFrame, review_answers: DataFrame | None,
                  approvals: DataFrame | None, as_of: AsOf = None, end_col: str = "created_at",
                  cfg: dict | None = None) -> DataFrame:
    """Every stage's verdict per lead, before the duplicate fold decides which count."""
    cfg = cfg or DEFAULT
    sc = W.screen_leads(leads, cfg["form"], end_col=end_col)
    if review_answers is not None:
        sc = W.resolve_reviews(sc, review_answers, "created_at", as_of)
    else:
        sc = sc.withColumn("review_decision", F.when(F.col("route") == "reject", "rejected")
                           .otherwise("accepted")).withColumn("resolved_by", F.lit("timeout"))
    # the helpers are built behind the answers' join, so that its shuffle carries none of them
    sc = with_helpers(sc)
    # every pattern runs once a row, however often its hit is used
    hits = [(*hit[:4], F.col(f"_hit{i}"), hit[4]) for i, hit in enumerate(P._pii_hits(sc.columns, cfg["policies"], None))]
    found = S.bant_found(cfg["scoring"])
    sc = sc.select("*", *[hit[5].alias(f"_hit{i}") for i, hit in enumerate(hits)], *[c.alias(f"_found_{n}") for n, c in found.items()])
    action, triggered, types = P.pii_verdict_from_hits([hit[:5] for hit in hits], cfg["policies"])
    decision, reason = S.triage_rules(cfg["scoring"])
    mql = S.mql_parts(cfg["scoring"])
    bant = S.bant_parts(cfg["scoring"], found={n: F.col(f"_found_{n}") for n in found})
    mql_total = sum((mql[p] for p in S.MQL_PARTS), F.lit(0))
    bant_total = sum((bant[p] for p in bant), F.lit(0))
    st = sc.select(
        "*", action.alias("pii_action"), types.alias("pii_types"), decision.alias("decision"),
        reason.alias("triage_reason"), mql_total.cast("int").alias("mql_score"),
        bant_total.cast("int").alias("sql_score"), bant["need"].cast("int").alias("_need"),
        bant["timeline"].cast("int").alias("_timeline"), S.assign_team_col(cfg["scoring"]).alias("assigned_team"))
    st = st.select(
        "*", (F.col("mql_score") >= cfg["scoring"]["mql_threshold"]).alias("mql_qualified"),
        (F.col("sql_score") >= cfg["scoring"]["bant_threshold"]).alias("sql_qualified"),
        S.deal_size(F.col("_need")).alias("estimated_deal_size"),
        S.close_date(F.col("_timeline"), as_of).alias("estimated_close_date")).drop("_need", "_timeline")
    st = drop_helpers(st).drop(*[f"_hit{i}" for i in range(len(hits))], *[f"_found_{n}" for n in found])
    return P.approval_gate(st, approvals, as_of, cfg["policies"], requested_col="created_at")


def run_outcome() -> Column:
    """The status a lead's run leaves in the duplicate tracker (pipeline order)."""
    c = F.col
    return (F.when(c("pii_action") == "deny", "processing")
            .when(c("decision") == "rejected", "rejected")
            .when(c("decision") == "needs_review", "needs_review")
            .when(~c("mql_qualified"), "accepted")
            .when(c("sql_qualified") & (c("approval_action") == "allow"), "sales_owned")
            .otherwise("accepted"))


def final_status() -> Column:
    """first stop wins (8 statuses, plus the two waiting states of the re-aimed prompts)."""
    c = F.col
    return (F.when(c("review_decision") == "rejected", "rejected")
            .when(c("review_decision") == "pending", "pending_review")
            .when(c("dup_action") == "deny", "rejected_duplicate")
            .when(c("pii_action") == "deny", "rejected_pii")
            .when(c("decision") == "rejected", "rejected")
            .when(c("decision") == "needs_review", "needs_human_review")
            .when(~c("mql_qualified"), "nurture")
            .when(c("sql_qualified") & (c("approval_action") == "deny"), "rejected_by_operator")
            .when(c("sql_qualified") & (c("approval_action") == "pending"), "pending_approval")
            .when(c("sql_qualified"), "sales_owned")
            .otherwise("mql_nurture"))


#: Columns of the stage table that the duplicate fold, the final status and the assignment read.
LATER_STAGES = ["lead_id", "email", "created_at", "review_decision", "pii_action", "decision", "mql_qualified", "sql_qualified",
                "approval_action", "assigned_team"]
#: Columns of a whole-batch run that the results feed reads.
FEED_READS = ["lead_id", "first_name", "last_name", "company", "email", "review_decision", "final_status", "mql_score", "sql_score",
              "assigned_rep_name", "created_at"]


def qualify_leads(leads: DataFrame, reps: DataFrame, review_answers: DataFrame | None = None,
                  approvals: DataFrame | None = None, as_of: AsOf = None, end_col: str = "created_at",
                  cfg: dict | None = None,
                  materialize: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """screening -> review -> duplicate -> PII -> triage -> MQL -> BANT -> rep -> approval.

    Stage verdicts are columns of one projection; the duplicate fold (P9) runs on
    the leads the form stage let through, keyed by email; reps are attached to
    leads that reach the SQL stage (R3).  Each row keeps its first stop reason.

    The stage table feeds both the fold and the final join, so with
    ``materialize`` it is written once as Parquet (below the shared
    ``spark.checkpoint.dir``) instead of evaluating every rule twice; each reader
    takes only its columns, and a lost executor's work starts from the files.
    ``columns`` names those the caller reads (none: all): the stage table is written and joined
    without the others, unless a later stage needs them.
    """
    cfg = cfg or DEFAULT
    st = stage_columns(leads, reps, review_answers, approvals, as_of, end_col, cfg)
    if columns is not None:
        st = st.select(*[c for c in st.columns if c in columns or c in LATER_STAGES])
    if materialize:
        st = staged_table(st, "qualify-stages")
    passed = st.filter(F.col("review_decision") == "accepted")
    dup = P.duplicate_lookback(passed.withColumn("_outcome", run_outcome()), outcome=F.col("_outcome"),
                               keeps_status=F.col("pii_action") == "deny", cfg=cfg["policies"])
    return with_final_status(st, dup, reps)


def with_final_status(st: DataFrame, dup: DataFrame, reps: DataFrame) -> DataFrame:
    """F2 and R3 on the stage table, given the duplicate verdicts of the leads that got so far."""
    staged = st.join(dup.select("lead_id", "dup_action"), "lead_id", "left")
    staged = staged.withColumn("final_status", final_status())
    reached_sql = F.col("final_status").isin("sales_owned", "rejected_by_operator", "pending_approval",
                                              "mql_nurture")
    return R.assign_rep(staged, reps, eligible=reached_sql & F.col("sql_qualified"))


# ----------------------------------------------------------------- F3-F6

def result_feed(final: DataFrame) -> DataFrame:
    """the results-feed record; form-stage, duplicate and personal-data stops carry no id
    and no scores; scores appear once their stage ran."""
    c = F.col
    stopped = (c("review_decision") == "rejected") | c("final_status").isin("rejected_duplicate", "rejected_pii")
    mql_ran = c("final_status").isin("nurture", "sales_owned", "mql_nurture", "rejected_by_operator",
                                     "pending_approval")
    sql_ran = c("final_status").isin("sales_owned", "mql_nurture", "rejected_by_operator", "pending_approval")
    return final.select(
        F.when(~stopped, c("lead_id")).alias("lead_id"),
        F.trim(F.concat_ws(" ", F.coalesce(c("first_name"), F.lit("")),
                           F.coalesce(c("last_name"), F.lit("")))).alias("name"),
        "company", "email", "final_status",
        F.when(mql_ran, c("mql_score")).alias("mql_score"),
        F.when(sql_ran, c("sql_score")).alias("sql_score"),
        F.when(sql_ran, c("assigned_rep_name")).alias("assigned_rep"),
        c("created_at").alias("submitted_at"))


def recent_results(feed: DataFrame, n: int = 50) -> DataFrame:
    """the newest ``n`` results (top-k is the feature; Spark keeps a bounded heap
    per partition, then merges)."""
    return feed.orderBy(F.desc("submitted_at"), F.desc("email"), F.desc_nulls_last("lead_id")).limit(n)


def dashboard_counts(feed: DataFrame) -> DataFrame:
    """status cards (only exact ``rejected`` counts as rejected, as the page does)
    plus the full breakdown in one aggregate."""
    fs = F.col("final_status")
    return feed.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(fs == "sales_owned").alias("sales_owned"),
        F.count_if(fs == "sql").alias("sql"), F.count_if(fs == "mql").alias("mql"),
        F.count_if(fs.isin("nurture", "mql_nurture")).alias("nurture"),
        F.count_if(fs == "rejected").alias("rejected"),
        F.count_if(fs == "rejected_duplicate").alias("rejected_duplicate"),
        F.count_if(fs == "rejected_pii").alias("rejected_pii"),
        F.count_if(fs == "rejected_by_operator").alias("rejected_by_operator"))


def lead_status_rows(leads: DataFrame, events: DataFrame) -> DataFrame:
    """F6 (long form): each lead with its timeline rows in order — the whole-table job."""
    lead = leads.select("lead_id", "status", "email", "company")
    ev = events.select("lead_id", "event_id", F.col("event_type").alias("event"),
                       F.col("agent_name").alias("agent"), F.col("from_status").alias("from"),
                       F.col("to_status").alias("to"), F.col("score_at_event").alias("score"),
                       F.col("event_timestamp").alias("timestamp"))
    return lead.join(ev, "lead_id", "left")


def lead_status_doc(leads: DataFrame, events: DataFrame, lead_ids: DataFrame) -> DataFrame:
    """F6 (document form) for requested leads: the status page's nested record, with
    the timeline also as the JSON text the page serves (``timeline_json``).

    Nesting happens after a semi-join to the requested ids, so only the leads
    asked for are gathered, one row each; a lead's events are one per pipeline
    stage it reached, so each gathered group is small by construction."""
    rows = lead_status_rows(leads.join(lead_ids.select("lead_id"), "lead_id", "left_semi"), events)
    item = F.struct("timestamp", "event_id", "event", "agent", "from", "to", "score")
    return (rows.groupBy("lead_id", "status", "email", "company")
            .agg(F.array_sort(F.collect_list(F.when(F.col("event_id").isNotNull(), item))).alias("_t"))
            .select("lead_id", "status", "email", "company",
                    F.transform("_t", lambda e: F.struct(
                        e["event"].alias("event"), e["agent"].alias("agent"), e["from"].alias("from"),
                        e["to"].alias("to"), e["score"].alias("score"),
                        e["timestamp"].cast("string").alias("timestamp"))).alias("timeline"))
            .withColumn("timeline_json", F.to_json("timeline", {"ignoreNullFields": "false"})))


# ----------------------------------------------------------------- S9, S10, S14

def apply_status_updates(leads: DataFrame, updates: DataFrame, key: str = "lead_id") -> DataFrame:
    """Latest update per lead (by ``key``: the id or the long key of the records) wins; status and time replaced, the last reason given stays
    (each update sets reason = COALESCE(new, old)).

    Both are picked with ``max_by`` in one aggregate (no window sort),
    then a key join; leads without an update pass through unchanged."""
    latest = (updates.groupBy(key)
              .agg(F.max_by(F.struct("status", "updated_at"), F.struct("updated_at", "status")).alias("_u"),
                   F.max_by("rejection_reason", F.when(F.col("rejection_reason").isNotNull(),
                                                       F.struct("updated_at", "status"))).alias("_reason")))
    j = leads.join(latest, key, "left")
    out = []
    for c in leads.columns:
        if c == "status":
            out.append(F.coalesce(F.col("_u.status"), F.col("status")).alias("status"))
        elif c == "updated_at":
            out.append(F.coalesce(F.col("_u.updated_at"), F.col("updated_at")).alias("updated_at"))
        elif c == "rejection_reason":
            out.append(F.coalesce(F.col("_reason"), F.col("rejection_reason")).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def lead_by_id(leads: DataFrame, ids: str | Sequence[str] | DataFrame, key: str = "lead_id") -> DataFrame:
    """Lookup by ``lead_id`` or (``key="mql_id"``) by MQL id — a pushed-down equality filter,
    or a semi-join for an id table."""
    if isinstance(ids, DataFrame):
        return leads.join(ids.select(key).distinct(), key, "left_semi")
    ids = [ids] if isinstance(ids, str) else list(ids)
    return leads.filter(F.col(key).isin(*ids))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "lead_id") -> DataFrame:
    """Rows inserted, updated or deleted between two snapshots (full outer join on
    the key, null-safe comparison of the whole row)."""
    cols = [c for c in new.columns if c != key]
    o = old.select(key, F.struct(*cols).alias("_old"))
    n = new.select(key, F.struct(*cols).alias("_new"))
    j = o.join(n, key, "full_outer")
    change = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "update"))
    return j.select(key, change.alias("change")).filter(F.col("change").isNotNull())
