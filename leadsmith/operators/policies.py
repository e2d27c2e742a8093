"""Governance policies as data jobs.

The reference keeps policy state in one process's dictionaries; here every
policy is a DataFrame job over a log (tool calls, leads, decisions), so the
state is derived from tables and the work partitions by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, POLICIES
from ..functions.common import AsOf, compact, contains_any, ts
from ..functions.windows import null_safe_join
from .duplicates import DAY, anchored
from .screening import first_answers

MICRO = 1_000_000


def _p(cfg: dict | None) -> dict:
    return cfg or DEFAULT["policies"]


def enabled(policy: str, cfg: dict | None = None) -> bool:
    """A known policy is on unless switched off; an unknown one allows everything (decided at plan time)."""
    return bool(_p(cfg).get("enabled", {}).get(policy, policy in DEFAULT["policies"]["enabled"]))


# ----------------------------------------------------------------- P1, P2

def micros(cost: Column) -> Column:
    """Money as whole micro-dollars, so running totals are exact and order-free."""
    return F.round(cost * MICRO).cast("long")


def running_total(df: DataFrame, key: str, order: Sequence[str], value: str,
                  bucket: Column) -> DataFrame:
    """Inclusive running sum of integer ``value`` per ``key`` in ``order``.

    Skew-safe two-level prefix sum: rows are grouped into ordered buckets
    (e.g. the hour of the timestamp); bucket totals get a prefix sum per key
    over the small bucket table, and rows get a running sum inside their
    (key, bucket) partition plus the bucket's offset.  A key holding a third of
    all rows is therefore spread over its buckets, never one window partition.
    """
    b = df.withColumn("_bucket", bucket)
    totals = b.groupBy(key, "_bucket").agg(F.sum(value).alias("_bsum"))
    offsets = totals.select(
        key, "_bucket",
        (F.sum("_bsum").over(Window.partitionBy(key).orderBy("_bucket")
                             .rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"))
    within = F.sum(value).over(Window.partitionBy(key, "_bucket").orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (null_safe_join(b.withColumn("_within", within), offsets, [key, "_bucket"])
            .withColumn("_running", F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_within"))
            .drop("_bucket", "_offset", "_within"))


def spend_guard(calls: DataFrame, cfg: dict | None = None, bucket_unit: str = "hour") -> DataFrame:
    """Running cost per lead, added before the checks (denied calls count).

    call > per-call limit -> deny; running > per-run limit -> deny;
    running >= warn share -> warn (allowed); else allow.
    """
    p = _p(cfg)
    max_run = int(round(p["max_cost_per_run_usd"] * MICRO))
    max_call = int(round(p["max_cost_per_agent_usd"] * MICRO))
    warn = max_run * p["warn_at_pct"] // 100
    c = calls.withColumn("cost_micros", micros(F.col("cost_usd")))
    if not enabled("spend_guard", p):
        return c.select("call_id", "lead_id", "ts", "cost_usd", F.lit(None).cast("double").alias("run_cost_usd"),
                        F.lit("allow").alias("action"), F.lit(None).cast("string").alias("reason"))
    r = running_total(c, "lead_id", ["ts", "call_id"], "cost_micros", F.date_trunc(bucket_unit, "ts"))
    cost, run = F.col("cost_micros"), F.col("_running")
    action = (F.when(cost > max_call, "deny").when(run > max_run, "deny")
              .when(run >= warn, "warn").otherwise("allow"))
    reason = F.when(cost > max_call, "per_call_limit").when(run > max_run, "per_run_limit")
    return r.select("call_id", "lead_id", "ts", "cost_usd", (run / float(MICRO)).alias("run_cost_usd"),
                    action.alias("action"), reason.alias("reason"))


def lead_spend(calls: DataFrame) -> DataFrame:
    """Total spend and calls per lead (exact micro-dollar sum)."""
    return (calls.groupBy("lead_id")
            .agg(F.count(F.lit(1)).alias("calls"), F.sum(micros(F.col("cost_usd"))).alias("_m"))
            .select("lead_id", "calls", (F.col("_m") / float(MICRO)).alias("spend_usd")))


# ----------------------------------------------------------------- P3-P5

def _scan_fields(df: DataFrame, cfg: dict) -> list[str]:
    return [f for f in cfg["pii_scan_fields"] if f in df.columns]


#: Characters of which every match of these patterns holds one: a text with none of them is not searched for it.
IN_EVERY_MATCH = {pattern: {"email": "@", "ssn": "-"}.get(typ, "0123456789") for typ, pattern, _, _ in POLICIES["pii_patterns"]}


def _pii_hits(df_columns: list[str], cfg: dict, fields: Sequence[str] | None):
    """(field, type, severity, action, hit Column) in field x pattern order."""
    fields = list(fields or [f for f in cfg["pii_scan_fields"] if f in df_columns])
    out = []
    for f in fields:
        v = (F.col("_msg") if f == "message" and "_msg" in df_columns
             else F.coalesce(F.col(f).cast("string"), F.lit("")))
        for typ, pattern, sev, act in cfg["pii_patterns"]:
            hit = v.rlike("(?i)" + pattern)
            needs = IN_EVERY_MATCH.get(pattern)
            out.append((f, typ, sev, act, contains_any(v, list(needs)) & hit if needs else hit))
    return out


def _with_hits(df: DataFrame, key: str, hits) -> tuple[DataFrame, list]:
    """The key with one boolean per hit, in a projection of its own: every pattern runs once a row, however often
    its hit is used.  The hits come back as references to these columns."""
    out = [(f, t, sev, act, F.col(f"_hit{i}")) for i, (f, t, sev, act, _) in enumerate(hits)]
    return df.select(key, *[h[4].alias(f"_hit{i}") for i, h in enumerate(hits)]), out


def pii_findings(df: DataFrame, key: str = "lead_id", cfg: dict | None = None,
                 fields: Sequence[str] | None = None) -> DataFrame:
    """Long form, one row per finding in field x pattern order (a narrow projection + explode)."""
    rows, hits = _with_hits(df, key, _pii_hits(df.columns, _p(cfg), fields))
    found = compact([F.when(hit, F.struct(F.lit(f).alias("field"), F.lit(t).alias("pii_type"),
                                          F.lit(sev).alias("severity"), F.lit(act).alias("action")))
                     for f, t, sev, act, hit in hits], "struct<field:string,pii_type:string,severity:string,action:string>")
    return rows.select(key, F.explode(found).alias("f")).select(key, "f.field", "f.pii_type", "f.severity", "f.action")


def pii_verdict_from_hits(hits, cfg: dict | None = None) -> tuple[Column, Column, Column]:
    """P4 without arrays of structs: worst action over all hits; allow and not triggered
    when every hit is low severity; the notable types in finding order."""
    p = _p(cfg)
    rank = p["action_rank"]
    notable = [h for h in hits if h[2] != "low"]
    triggered = F.lit(False)
    for h in notable:
        triggered = triggered | h[4]
    worst = None
    for name, r_ in sorted(rank.items(), key=lambda kv: -kv[1]):
        any_hit = F.lit(False)
        for h in hits:
            if h[3] == name:
                any_hit = any_hit | h[4]
        worst = F.when(any_hit, name) if worst is None else worst.when(any_hit, name)
    action = F.when(triggered, worst.otherwise("allow")).otherwise("allow")
    types = compact([F.when(h[4], F.lit(h[1])) for h in notable])
    return action, triggered, types


def pii_verdict(df: DataFrame, key: str = "lead_id", cfg: dict | None = None,
                fields: Sequence[str] | None = None) -> DataFrame:
    if not enabled("pii_detection", cfg):
        return df.select(key, F.lit("allow").alias("pii_action"), F.lit(False).alias("pii_triggered"),
                         F.array().cast("array<string>").alias("pii_types"))
    rows, hits = _with_hits(df, key, _pii_hits(df.columns, _p(cfg), fields))
    action, triggered, types = pii_verdict_from_hits(hits, cfg)
    return rows.select(key, action.alias("pii_action"), triggered.alias("pii_triggered"),
                     types.alias("pii_types"))


def pii_mask(df: DataFrame, cfg: dict | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """P5: replace every match with ``[REDACTED:<type>]``, patterns in configured order."""
    p = _p(cfg)
    fields = set(fields or _scan_fields(df, p))
    out = []
    for c in df.columns:
        if c in fields:
            v = F.col(c)
            for typ, pattern, _, _ in p["pii_patterns"]:
                v = F.regexp_replace(v, "(?i)" + pattern, f"[REDACTED:{typ}]")
            out.append(v.alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ----------------------------------------------------------------- P6

def approval_gate(qualified: DataFrame, approvals: DataFrame | None, as_of: AsOf = None,
                  cfg: dict | None = None, timeout_s: int | None = None, on_timeout: str = "allow",
                  requested_col: str = "qualified_at") -> DataFrame:
    """Big deals or low BANT need an operator answer; y/yes/empty or a timeout allow.

    ``qualified`` holds BANT-qualified rows (``estimated_deal_size``, ``sql_score``);
    ``approvals`` holds (lead_id, answer, answered_at).  The first answer per lead
    is kept with one aggregate before the key join.
    """
    p = _p(cfg)
    timeout_s = timeout_s if timeout_s is not None else p["approval_timeout_seconds"]
    needs = ((F.col("estimated_deal_size") == p["approval_deal_size"])
             | (F.col("sql_score") < p["approval_min_bant"]))
    if not enabled("approval_gate", p):
        needs = F.lit(False)
    if approvals is None:  # nobody answers: every request runs into the timeout
        j = qualified.withColumn("_yes", F.lit(None).cast("boolean")) \
            .withColumn("answered_at", F.lit(None).cast("timestamp"))
    else:
        j = qualified.join(first_answers(approvals), "lead_id", "left")
    deadline = F.timestamp_add("SECOND", F.lit(timeout_s), F.col(requested_col))
    in_time = F.col("answered_at").isNotNull() & (F.col("answered_at") <= deadline)
    action = (F.when(~needs, "allow").when(in_time & F.col("_yes"), "allow").when(in_time, "deny")
              .when(ts(as_of) < deadline, "pending").otherwise(on_timeout))
    how = (F.when(~needs, "not_required").when(in_time, "operator")
           .when(ts(as_of) < deadline, "waiting").otherwise("timeout"))
    return j.select(*qualified.columns, needs.alias("needs_approval"), action.alias("approval_action"),
                    how.alias("approval_resolved_by"))


# ----------------------------------------------------------------- P7, P8

def retry_plan(failures: DataFrame, cfg: dict | None = None) -> DataFrame:
    """Attempt n of an agent's failures for a lead: n <= max_retries -> retry (allowed)
    after delay * multiplier^(n-1) seconds; later attempts escalate to a human.

    The per-agent fallback list in the policy configuration is not consulted by the
    enforcement it mirrors (every exhausted retry escalates), so it is not applied here."""
    from ..functions.windows import bucketed_row_number

    p = _p(cfg)
    a = bucketed_row_number(failures, ["lead_id", "agent"], ["ts", "call_id"], F.date_trunc("hour", "ts"),
                            out="attempt")
    if not enabled("retry_fallback", p):  # disabled policy: every check allows
        return a.select("call_id", "lead_id", "agent", "tool", "ts", "attempt", F.lit("allow").alias("action"),
                        F.lit(None).cast("double").alias("delay_seconds"))
    retry = F.col("attempt") <= p["max_retries"]
    delay = p["retry_delay_seconds"] * F.pow(F.lit(float(p["backoff_multiplier"])), F.col("attempt") - 1)
    return a.select("call_id", "lead_id", "agent", "tool", "ts", "attempt",
                    F.when(retry, "retry").otherwise("escalate").alias("action"),
                    F.when(retry, delay).alias("delay_seconds"))


def _ascii_json(v: Column) -> Column:
    """JSON text with every character outside printable ASCII as lower-case ``\\uXXXX`` escapes."""
    low = v
    for code in ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F"):  # control escapes the writer spells with capitals
        low = F.regexp_replace(low, rf"(?<!\\)((?:\\\\)*)\\u00{code}", rf"$1\\u00{code.lower()}")
    v = F.when(v.contains("\\u00"), low).otherwise(v)
    escaped = F.transform(F.split(v, ""), lambda ch: F.when(ch.rlike("^[ -~]?$"), ch).otherwise(
        F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    return F.when(v.rlike("[^ -~]"), F.array_join(escaped, "")).otherwise(v)


def canonical_json(fields: dict[str, Column]) -> Column:
    """JSON text with sorted keys and ``", "`` / ``": "`` separators, ASCII only (json.dumps style)."""
    parts = []
    for i, (k, c) in enumerate(sorted(fields.items())):
        v = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'^\{"v":(.*)\}$', 1)
        v = F.when(c.isNull(), F.lit("null")).otherwise(_ascii_json(v))
        parts += ([F.lit(", ")] if i else []) + [F.lit(f'"{k}": '), v]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def decision_audit(decisions: DataFrame, input_cols: Sequence[str], cfg: dict | None = None) -> DataFrame:
    """Audit rows — reasoning cut to 200 chars, confidence % truncated, and the first
    16 hex of SHA-256 over the canonical JSON of the decision input.

    ``decided_at``, ``duration_ms``, ``llm_model`` and ``tokens_used`` are taken over where the
    decisions hold them (null, 0, ``unknown`` and 0 otherwise); the audit id is a hash of the entry's
    lead, agent and input, so a retried job writes the same id."""
    p = _p(cfg)
    pct = F.floor(F.col("confidence") * 100).cast("int")
    h = F.substring(F.sha2(canonical_json({c: F.col(c) for c in input_cols}), 256), 1,
                    p["input_hash_chars"])

    def given(name: str, kind: str, default) -> Column:
        c = F.col(name) if name in decisions.columns else F.lit(None)
        return F.coalesce(c.cast(kind), F.lit(default).cast(kind))
    audit_id = F.substring(F.sha2(F.concat_ws("|", "lead_id", "agent", h), 256), 1, 8)
    at = F.col("decided_at") if "decided_at" in decisions.columns else F.lit(None).cast("timestamp_ntz")
    return decisions.select(
        audit_id.alias("audit_id"), at.alias("timestamp_utc"), given("duration_ms", "long", 0).alias("duration_ms"),
        given("llm_model", "string", "unknown").alias("llm_model"), given("tokens_used", "long", 0).alias("tokens_used"),
        "lead_id", "agent", "decision",
        F.coalesce(F.substring(F.col("reasoning"), 1, p["reasoning_max_chars"]), F.lit("")).alias("reasoning"),
        pct.alias("confidence_pct"), h.alias("input_hash"), F.lit(p["policy_pack"]).alias("policy_pack"))


# ----------------------------------------------------------------- P9

def duplicate_lookback(leads: DataFrame, key: str = "email", ts_col: str = "created_at",
                       id_col: str = "lead_id", days: int | None = None, outcome: Column | None = None,
                       keeps_status: Column | None = None, cfg: dict | None = None) -> DataFrame:
    """The anchored 30-day duplicate rule, per lower/trimmed email in time order.

    State per email is (anchor, status).  A row with no state registers; a row
    whose state status is re-submittable (rejected / nurture) is allowed and its
    outcome becomes the status, the anchor stays; a row within ``days`` whole
    days of the anchor is denied (state unchanged); otherwise it registers anew.
    ``outcome`` is the status the row's run leaves behind (default
    ``'processing'``, i.e. the plain rule).  A re-submitted row for which
    ``keeps_status`` holds (its run stops before it writes a status, as a
    personal-data stop does) leaves the old status.

    Rows without an email or without a time take no part: they are allowed, without
    an anchor.  The rows are staged in the shared checkpoint folder while the query is
    built; a hot key is split by the hour (see ``operators.duplicates``).
    """
    p = _p(cfg)
    days = days if days is not None else p["lookback_days"]
    keyed, alone = lookback_rows(leads, key, ts_col, id_col, outcome, keeps_status, p)
    passed = alone.select(
        F.col("id").alias(id_col), F.lit("allow").alias("dup_action"), F.lit(None).cast("string").alias("anchor_id"),
        F.lit(None).cast("long").alias("days_since_anchor"))
    if not enabled("duplicate_detection", p):
        return passed
    return lookback_verdicts(anchored(keyed, (days + 1) * DAY), id_col).unionByName(passed)


def lookback_rows(leads: DataFrame, key: str, ts_col: str, id_col: str, outcome: Column | None,
                  keeps_status: Column | None, p: dict) -> tuple[DataFrame, DataFrame]:
    """The rows of the rule (key, id, t, resubmits, shuts), and those that take no part in it."""
    em = F.lower(F.trim(F.col(key)))
    outcome = outcome if outcome is not None else F.lit("processing")
    resubmits = F.coalesce(outcome.isin(*p["allow_resubmit_statuses"]), F.lit(False))
    keeps = F.coalesce(keeps_status, F.lit(False)) if keeps_status is not None else F.lit(False)
    base = leads.select(F.col(id_col).alias("id"), F.unix_micros(F.col(ts_col).cast("timestamp")).alias("t"), em.alias("key"),
                        resubmits.alias("resubmits"), (~resubmits & ~keeps).alias("shuts"))
    alone = F.col("key").isNull() | (F.col("key") == "") | F.col("t").isNull()
    if not enabled("duplicate_detection", p):
        alone = F.lit(True)
    return base.filter(~alone), base.filter(alone)


def lookback_verdicts(found: DataFrame, id_col: str = "lead_id", *keep: str) -> DataFrame:
    """dup_action, anchor and whole days since it, of rows with their anchors."""
    passes = F.coalesce(F.col("pos") <= F.col("anchor.shut"), F.lit(True))
    return found.select(
        F.col("id").alias(id_col), F.when(passes, "allow").otherwise("deny").alias("dup_action"),
        F.col("anchor.id").cast("string").alias("anchor_id"),
        F.floor((F.col("t") - F.col("anchor.t")) / DAY).cast("long").alias("days_since_anchor"), *keep)


# ----------------------------------------------------------------- P10-P12

def expected_tools(spark: SparkSession, cfg: dict | None = None) -> DataFrame:
    rows = [(a, t) for a, ts_ in _p(cfg)["expected_tools_per_agent"].items() for t in ts_]
    return spark.createDataFrame(rows, "agent string, tool string")


def unexpected_tools(calls: DataFrame, expected: DataFrame, cfg: dict | None = None) -> DataFrame:
    """P10: calls whose (agent, tool) is not expected -> escalate.  ``expected`` is the
    configured allow-list (a few dozen rows), so broadcasting it is bounded."""
    if not enabled("tool_transparency", cfg):
        calls = calls.limit(0)  # a disabled policy raises nothing
    return (calls.join(F.broadcast(expected), ["agent", "tool"], "left_anti")
            .select("call_id", "lead_id", "agent", "tool", "ts", F.lit("escalate").alias("action")))


def tool_access_map(calls: DataFrame) -> DataFrame:
    """Per lead, agent and tool: calls, average / max duration, errors, first/last call."""
    return (calls.groupBy("lead_id", "agent", "tool")
            .agg(F.count(F.lit(1)).alias("calls"), F.avg("duration_ms").alias("avg_duration_ms"),
                 F.max("duration_ms").alias("max_duration_ms"),
                 F.count_if(F.col("status") != "success").alias("errors"),
                 F.min("ts").alias("first_call"), F.max("ts").alias("last_call")))


def tool_call_timeline(calls: DataFrame) -> DataFrame:
    """P11 (ordered form): each lead's calls in time order with their position
    (skew-safe row numbers over hour buckets)."""
    from ..functions.windows import bucketed_row_number

    c = calls.select("lead_id", "call_id", "ts", "agent", "tool", "status", "duration_ms")
    return bucketed_row_number(c, ["lead_id"], ["ts", "call_id"], F.date_trunc("hour", "ts"), out="seq")


def audit_log(spark: SparkSession, calls: DataFrame, cfg: dict | None = None) -> DataFrame:
    """P12 input: triggered policy results over a tool-call log (one row each); the results of the
    policies wired into a run, and its decisions, come from ``run_audit_log``."""
    sg = spend_guard(calls, cfg).filter(F.col("action") == "deny").select(
        "lead_id", F.lit("spend_guard").alias("policy_id"), "action", "ts")
    fails = calls.filter(F.col("status") != "success")
    rp = retry_plan(fails, cfg).select(
        "lead_id", F.lit("retry_fallback").alias("policy_id"),
        F.when(F.col("action") == "retry", "allow").otherwise(F.col("action")).alias("action"), "ts")
    ut = unexpected_tools(calls, expected_tools(spark, cfg), cfg).select(
        "lead_id", F.lit("tool_transparency").alias("policy_id"), "action", "ts")
    if not enabled("retry_fallback", cfg):
        rp = rp.limit(0)  # not triggered when disabled
    return sg.unionByName(rp).unionByName(ut)


def run_audit_log(final: DataFrame, ts_col: str = "created_at", cfg: dict | None = None) -> DataFrame:
    """P12 input from a whole-batch run (``qualify_leads``): one row per triggered check of the three wired
    policies, and every agent decision twice as the decision audit logs it.

    A check counts where the run reached it: duplicates after the form stage (logged when denied), personal data
    when the lead was no duplicate (logged when found), the approval gate for BANT-qualified leads that need
    an answer (logged when it was given or the time ran out)."""
    c = F.col
    reached = c("review_decision") == "accepted"
    checked = reached & (c("dup_action") != "deny")
    decided = checked & (c("pii_action") != "deny")
    mql_ran = decided & (c("decision") == "accepted")
    sql_ran = mql_ran & c("mql_qualified")
    gated = sql_ran & c("sql_qualified") & c("needs_approval") & (c("approval_action") != "pending")

    def entry(policy: str, action: Column, agent: str, when: Column) -> Column:
        return F.when(when, F.struct(F.lit(policy).alias("policy_id"), action.alias("action"), F.lit(agent).alias("agent")))
    items = [entry("duplicate_detection", F.lit("deny"), "Pipeline", reached & (c("dup_action") == "deny")),
             entry("pii_detection", c("pii_action"), "Pipeline", checked & (F.size("pii_types") > 0)),
             entry("approval_gate", c("approval_action"), "Pipeline", gated)]
    if enabled("decision_audit", cfg):
        for agent, when in (("TriageAgent", decided), ("MQLAgent", mql_ran), ("SQLAgent", sql_ran)):
            items += [entry("decision_audit", F.lit("allow"), agent, when)] * 2
    return final.select("lead_id", F.inline(compact(items)), c(ts_col).alias("ts")).select("lead_id", "policy_id", "action", "ts", "agent")


# ----------------------------------------------------------------- P13 in time

def policies_in_force(log: DataFrame, versions: DataFrame, ts_col: str = "ts") -> DataFrame:
    """P13 in time: each row of a log with ``in_force``, whether its policy was switched on at the row's time.

    ``versions``: policy_id, valid_from, valid_to (null: still valid; the time itself is outside), enabled.  Of several
    versions valid at a time the one that began last decides; a policy without a valid version is not in force.

    The range join is an equi-join on (policy, day): a version is listed under each day it touches, days outside the
    log's are left out, and a row picks its version from the day's list (as long as changes a day, not as the log)."""
    day = F.to_date(ts_col)
    ends = log.groupBy("policy_id").agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    v = versions.join(ends, "policy_id").select(
        "policy_id", "enabled", "valid_from", "valid_to",
        F.greatest(F.to_date("valid_from"), "lo").alias("lo"), F.least(F.coalesce(F.to_date("valid_to"), "hi"), "hi").alias("hi"))
    days = (v.where("lo <= hi").select("policy_id", F.explode(F.sequence("lo", "hi")).alias("_day"),
                                       F.struct("valid_from", "valid_to", "enabled").alias("version"))
            .groupBy("policy_id", "_day").agg(F.collect_list("version").alias("_versions")))
    j = log.withColumn("_day", day).join(days, ["policy_id", "_day"], "left")
    at = F.col(ts_col)
    valid = F.filter("_versions", lambda x: (x["valid_from"] <= at) & (x["valid_to"].isNull() | (at < x["valid_to"])))
    return j.select(*log.columns, F.coalesce(F.array_max(valid)["enabled"], F.lit(False)).alias("in_force"))


def audit_summary(audit: DataFrame) -> DataFrame:
    """Entries per policy and action."""
    return audit.groupBy("policy_id", "action").agg(F.count(F.lit(1)).alias("entries"),
                                                    F.countDistinct("lead_id").alias("leads"))
