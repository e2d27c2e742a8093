"""Record builders and sinks.

Builders are projections that shape a stage's output into the warehouse record;
sinks write whole DataFrames (one write per stage, not one INSERT per row), with
dynamic partition overwrite so a re-run of a day replaces only that day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import AsOf, compact, days_before, ts
from ..operators.lifecycle import gen_id, long_key
from ..operators.routing import assign_rep
from .intake import LEAD_FIELDS


RECORD_FIELDS = [*LEAD_FIELDS, "interests", "opt_in_marketing"]


def _payload(df: DataFrame, fields: list[str]) -> Column:
    present = [f for f in fields if f in df.columns]
    return F.to_json(F.struct(*present), {"ignoreNullFields": "false"})


def to_raw_leads(df: DataFrame, as_of: AsOf = None, key_col: str | None = None) -> DataFrame:
    """Raw-lead record: id and long key, status ``new``, created = updated = ``as_of``, payload kept as JSON."""
    now = ts(as_of)
    key = F.col(key_col) if key_col else _payload(df, RECORD_FIELDS)
    cols = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in LEAD_FIELDS]
    return df.select(gen_id("LD", now, key).alias("lead_id"), long_key(key).alias("lead_key"), now.alias("created_at"), now.alias("updated_at"),
                     *cols, _given(df, "interests", "array<string>", F.array()),
                     _given(df, "opt_in_marketing", "boolean", F.lit(True)), F.lit("new").alias("status"), F.lit(None).cast("string").alias("rejection_reason"),
                     _payload(df, RECORD_FIELDS).alias("raw_payload"))


def _given(df: DataFrame, name: str, kind: str, default: Column | None = None) -> Column:
    """The column ``name`` where ``df`` holds it, else its default (null if there is none)."""
    c = (F.col(name) if name in df.columns else F.lit(None)).cast(kind)
    return (c if default is None else F.coalesce(c, default.cast(kind))).alias(name)


#: Version and confidence of a record whose answer names none.
AGENT_VERSION, CONFIDENCE = "1.0.0", 0.8


def _agent(df: DataFrame) -> list[Column]:
    return [_given(df, "agent_version", "string", F.lit(AGENT_VERSION)), _given(df, "agent_reasoning", "string"),
            _given(df, "confidence_score", "double", F.lit(CONFIDENCE))]


def to_mql_leads(scored: DataFrame, as_of: AsOf = None) -> DataFrame:
    """MQL record for qualified rows: status ``mql_new``, not reviewed, breakdown as JSON.

    Enrichment, persona, stage, interests, reasoning and track are those the rows hold (parsed answers);
    arrays are empty, version and confidence take their defaults, and the rest is null where they hold none.
    ``mql_key`` is the long key."""
    now = ts(as_of)
    q = scored.filter(F.col("qualified"))
    lists = [_given(scored, c, "array<string>", F.array()) for c in ("technologies_used", "product_interest", "pain_points")]
    return q.select(
        gen_id("MQL", now, "lead_id").alias("mql_id"), long_key("lead_id").alias("mql_key"), "lead_id",
        now.alias("created_at"), now.alias("updated_at"), now.alias("qualified_at"), "mql_score",
        F.to_json("score_breakdown").alias("score_breakdown"),
        _given(scored, "enriched_company", "string"), _given(scored, "enriched_industry", "string"),
        _given(scored, "enriched_employees", "int"), _given(scored, "enriched_revenue", "string"),
        _given(scored, "persona", "string"), _given(scored, "buying_stage", "string"), *lists, *_agent(scored),
        F.lit(False).alias("human_reviewed"), F.lit("mql_new").alias("status"), _given(scored, "nurture_track", "string"))


def to_sql_leads(scored: DataFrame, as_of: AsOf = None, reps: DataFrame | None = None) -> DataFrame:
    """SQL record for BANT-qualified rows: status ``sql_new``, handoff not confirmed.

    With ``reps`` each row gets the least-loaded rep of its team (R3), without them the rep it holds.
    ``mql_id`` is the stored one where the rows hold it (a later run's date would give another id); ``sql_key`` and
    ``mql_key`` are the long keys, on which records are joined."""
    now = ts(as_of)
    q = scored.filter(F.col("qualified"))
    if reps is not None:
        given = "assignment_reason" in q.columns
        reason = F.col("_given_reason") if given else F.lit(None)
        q = assign_rep(q.withColumnRenamed("assignment_reason", "_given_reason") if given else q, reps)
        q = q.withColumn("assignment_reason", F.coalesce(reason, "assignment_reason"))
    return q.select(
        gen_id("SQL", now, "lead_id").alias("sql_id"), long_key("lead_id").alias("sql_key"),
        (F.col("mql_id") if "mql_id" in scored.columns else gen_id("MQL", now, "lead_id")).alias("mql_id"),
        _given(q, "mql_key", "string", long_key("lead_id")), "lead_id",
        now.alias("created_at"), now.alias("updated_at"), now.alias("qualified_at"),
        "sql_score", "bant_score_budget", "bant_score_authority", "bant_score_need", "bant_score_timeline",
        "estimated_deal_size", "estimated_close_date",
        *[_given(q, c, "string") for c in ("use_case_summary", "competitive_context", "next_step")], "assigned_team",
        *[_given(q, c, "string") for c in ("assigned_rep_id", "assigned_rep_name", "assigned_rep_email", "assignment_reason")],
        *_agent(q), F.lit("sql_new").alias("status"), F.lit(False).alias("handoff_confirmed"))


STAGE_EVENTS = [
    # (event_type, from_status, to_status, agent, score column or None, condition column)
    ("lead_captured", None, "new", "WebFormAgent", None, None),
    ("triage_started", "new", "processing", "TriageAgent", None, None),
    ("triage_completed", "processing", "triage_status", "TriageAgent", None, None),
    ("mql_scored", "accepted", "mql_status", "MQLAgent", "mql_score", "mql_ran"),
    ("sql_scored", "mql", "sql_status", "SQLAgent", "sql_score", "sql_ran"),
    ("sales_assigned", "sql", "sales_owned", "SQLAgent", None, "owned"),
]


#: What a stage's event says of its decision, as JSON.
EVENT_DETAILS = {
    "triage_completed": ["decision", "triage_reason"], "mql_scored": ["mql_qualified", "mql_score"],
    "sql_scored": ["sql_qualified", "sql_score", "assigned_team", "estimated_deal_size"], "sales_assigned": ["assigned_rep_id"]}


#: Columns of a whole-batch run that its events read.
EVENT_READS = sorted({"lead_id", "review_decision", "final_status", "decision", "mql_qualified", "sql_qualified",
                      *(e[4] for e in STAGE_EVENTS if e[4]), *(c for cs in EVENT_DETAILS.values() for c in cs)})


def events_from_stages(staged: DataFrame, as_of: AsOf = None, durations: dict[str, Column] | None = None,
                       errors: dict[str, Column] | None = None) -> DataFrame:
    """The audit events of each lead's run, many per lead in one pass (the places of a lead's events are
    exploded and each row builds its own event's fields only), each with a deterministic ``EVT`` id and long key, its place in the run (``seq``) and a
    time one millisecond after the event before, so that timelines keep the order of the stages.

    ``event_details`` is the stage's decision as JSON (``EVENT_DETAILS``); ``durations`` and ``errors`` give, by
    event type, the seconds the stage took and what went wrong in it (null where they say nothing)."""
    durations, errors = durations or {}, errors or {}
    now = ts(as_of)
    fs = F.col("final_status")
    cols = {
        "triage_status": F.when(F.col("decision") == "accepted", "accepted")
        .when(F.col("decision") == "rejected", "rejected").otherwise("processing"),
        "mql_status": F.when(F.col("mql_qualified"), "mql").otherwise("accepted"),
        "sql_status": F.when(F.col("sql_qualified"), "sql").otherwise("mql"),
        "mql_ran": fs.isin("nurture", "sales_owned", "mql_nurture", "rejected_by_operator", "pending_approval"),
        "sql_ran": fs.isin("sales_owned", "mql_nurture", "rejected_by_operator", "pending_approval"),
        "owned": fs == "sales_owned",
    }
    started = ~fs.isin("rejected_duplicate", "rejected_pii", "pending_review") & (F.col("review_decision") == "accepted")
    seq = F.col("seq")
    places, fields = [], {}
    for i, (etype, frm, to, agent, score, cond) in enumerate(STAGE_EVENTS):
        keep = started if cond is None else (started & cols[cond])
        if etype == "lead_captured":
            keep = F.col("review_decision") == "accepted"
        to_c = cols[to] if to in cols else F.lit(to)
        places.append(F.when(keep, F.lit(i)))
        own = {"event_type": F.lit(etype), "from_status": F.lit(frm).cast("string"), "to_status": to_c,
               "agent_name": F.lit(agent), "score_at_event": (F.col(score) if score else F.lit(None)).cast("int"),
               "event_details": _details(staged, etype),
               "duration_seconds": durations.get(etype, F.lit(None)).cast("int"),
               "error_message": errors.get(etype, F.lit(None)).cast("string")}
        for name, value in own.items():
            fields[name] = fields[name].when(seq == i, value) if name in fields else F.when(seq == i, value)
    ev = staged.withColumn("seq", F.explode(compact(places, "int"))).select(
        "lead_id", "seq", *[value.alias(name) for name, value in fields.items()])
    of_event = ["lead_id", F.col("seq").cast("string")]
    return ev.select(gen_id("EVT", now, *of_event).alias("event_id"), long_key(*of_event).alias("event_key"), "lead_id",
                     "seq", F.timestamp_add("MILLISECOND", F.col("seq"), now).alias("event_timestamp"), "event_type",
                     "from_status", "to_status", "agent_name", "score_at_event", "event_details", "duration_seconds", "error_message")


def _details(staged: DataFrame, event_type: str) -> Column:
    fields = [c for c in EVENT_DETAILS.get(event_type, []) if c in staged.columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}) if fields else F.lit("{}")


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One append per stage output (not one insert per row)."""
    df.write.mode("append").format(fmt).save(path)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Idempotent partition write — dynamic overwrite replaces only the partitions
    present in ``df`` (a re-run of one report day rewrites that day only)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).format(fmt).save(path))


def audit_window(audit: DataFrame, ts_col: str, as_of: AsOf = None, days: int = 365) -> DataFrame:
    """The part of the audit trail inside the retention period."""
    return audit.filter(F.col(ts_col) >= days_before(as_of, days))


def export_audit(audit: DataFrame, path: str, ts_col: str, as_of: AsOf = None, days: int = 365) -> None:
    """Write the retained audit rows as JSON lines, partitioned by day."""
    out = audit_window(audit, ts_col, as_of, days).withColumn("event_date", F.to_date(ts_col))
    write_partitioned(out, path, ["event_date"], fmt="json")


def write_lead_table(leads: DataFrame, path: str, ts_col: str = "created_at") -> None:
    """Store a lead table partitioned by capture day: window filters on ``created_at``
    then prune day folders and reach the Parquet scan as pushed filters."""
    write_partitioned(leads.withColumn("created_date", F.to_date(ts_col)), path, ["created_date"])
