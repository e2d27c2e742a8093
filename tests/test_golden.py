"""Golden rows: the reference's own test and demo leads, expected values worked out
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadsmith.config import DEFAULT
from leadsmith.operators import lifecycle as L
from leadsmith.operators import policies as P
from leadsmith.operators import scoring as S
from leadsmith.operators import screening as W
from leadsmith.sources import fixtures as fx
from tests.conftest import SF_SMALL

COLS = ["lead_id", "first_name", "last_name", "email", "company", "job_title", "company_size", "industry",
        "form_type", "source_channel", "message", "phone", "linkedin_url", "country"]

GOOD = dict(first_name="Sarah", last_name="Mitchell", email="s.mitchell@acmecorp.com", company="Acme Corporation",
            job_title="VP of Engineering", company_size="1001-5000", industry="Technology",
            form_type="demo_request", source_channel="web_form",
            message="We need a data platform. Budget approved. Urgent.", country="US")
SPAM = dict(first_name="Test", last_name="User", email="test@test.com", company="", form_type="contact_us",
            source_channel="web_form", message="testing 123 free money")
WEAK = dict(first_name="John", last_name="Doe", email="jdoe@gmail.com", company="Small Biz", job_title="Analyst",
            company_size="11-50", form_type="newsletter_signup", source_channel="web_form", message="just curious")
DEMO1 = dict(first_name="Sarah", last_name="Mitchell", email="s.mitchell@acmecorp.com", company="Acme Corporation",
             job_title="VP of Engineering", company_size="1001-5000", industry="Technology",
             form_type="demo_request", source_channel="web_form",
             message="We're evaluating data platforms to replace our current solution. Budget approved for Q1. "
                     "Looking to demo ASAP and make a decision within 30 days.",
             country="US", phone="+1-555-0100")
DEMO2 = dict(first_name="James", last_name="Park", email="jpark@startupco.io", company="StartupCo",
             job_title="Head of Data", company_size="51-200", industry="Financial Services",
             form_type="whitepaper_download", source_channel="web_form",
             message="Downloaded your whitepaper on real-time analytics. Interested in learning more about how "
                     "this could apply to our use case.", country="US")
DEMO3 = dict(first_name="Test", last_name="User", email="test@test.com", company="", job_title="",
             form_type="contact_us", source_channel="web_form", message="testing 123")
SCEN_A = dict(first_name="Robert", last_name="Chen", email="robert.chen@acmecorp.com", company="Acme Corporation",
              job_title="IT Manager", company_size="201-1000", industry="Technology", form_type="contact_us",
              message="Hi, our compliance team requires SSN 123-45-6789 for vendor verification. Please advise.")
SCEN_B = dict(first_name="Maria", last_name="Gonzalez", email="m.gonzalez@techstart.io", company="TechStart",
              job_title="Head of Engineering", company_size="51-200", industry="Technology",
              form_type="demo_request", message="Interested in a product demo for our team.")
SCEN_C = dict(first_name="Jennifer", last_name="Walsh", email="j.walsh@globalfinancial.com",
              company="Global Financial Services", job_title="VP of Technology", company_size="5000+",
              industry="Financial Services", form_type="demo_request",
              message="We are evaluating data platforms for our enterprise. Budget is approved and we need to make "
                      "a decision within 30 days. Looking for a product demo ASAP.")


def frame(spark, named):
    rows = []
    for i, (name, d) in enumerate(named):
        rows.append(tuple([name] + [d.get(c) for c in COLS[1:]]) + (dt.datetime(2025, 3, 1, 10, 0) + dt.timedelta(days=i),))
    schema = ", ".join(f"{c} string" for c in COLS) + ", created_at timestamp"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def leads(spark):
    return frame(spark, [("GOOD", GOOD), ("SPAM", SPAM), ("WEAK", WEAK), ("DEMO1", DEMO1), ("DEMO2", DEMO2),
                         ("DEMO3", DEMO3), ("SCEN_C", SCEN_C)])


def by_id(df, *cols):
    return {r["lead_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_screening(leads):
    got = by_id(W.screen_leads(leads), "bot_score", "quality_score", "route")
    assert got["GOOD"] == (0, 85, "accept")
    assert got["SPAM"] == (100, 20, "reject")
    assert got["WEAK"] == (30, 25, "review")
    assert got["DEMO1"] == (0, 100, "accept")
    assert got["DEMO2"] == (0, 60, "review")
    assert got["DEMO3"] == (100, 20, "reject")


def test_screening_flags(leads):
    got = by_id(W.screen_leads(leads), "flags")
    assert got["SPAM"][0] == ["Missing company name", "Missing job title", "Spam keyword: 'free money'",
                              "Blocked name: 'test'", "Blocked name: 'user'"]
    assert got["WEAK"][0] == ["Personal email domain: gmail.com", "Short message (2 words, min 3 for newsletter_signup)"]
    assert got["GOOD"][0] == []


def test_mql(leads):
    sc = S.score_mql(leads)
    got = by_id(sc.select("lead_id", "mql_score", *[F.col(f"score_breakdown.{p}").alias(p) for p in S.MQL_PARTS]),
                "mql_score", *S.MQL_PARTS)
    assert got["GOOD"] == (89, 20, 15, 10, 20, 10, 6, 8)
    assert got["WEAK"] == (23, 5, 2, 3, 5, 0, 0, 8)
    assert got["DEMO1"] == (94, 20, 15, 10, 20, 10, 9, 10)
    assert got["DEMO2"] == (63, 20, 5, 10, 10, 10, 0, 8)
    assert got["SCEN_C"] == (77, 5, 15, 10, 20, 10, 9, 8)


def test_bant(leads):
    sc = S.score_bant(leads, as_of="2025-03-01 00:00:00")
    got = by_id(sc, "sql_score", "bant_score_budget", "bant_score_authority", "bant_score_need",
                "bant_score_timeline", "estimated_deal_size")
    assert got["GOOD"][:5] == (80, 25, 25, 5, 25)
    assert got["DEMO1"][:5] == (80, 25, 25, 5, 25)
    assert got["DEMO2"][:5] == (40, 15, 25, 0, 0)
    assert got["SCEN_C"] == (90, 25, 25, 15, 25, "$200K+")
    parts = sc.select((F.col("bant_score_budget") + F.col("bant_score_authority") + F.col("bant_score_need")
                       + F.col("bant_score_timeline") == F.col("sql_score")).alias("ok")).collect()
    assert all(r.ok for r in parts)


def test_word_matching(spark):
    df = spark.createDataFrame([("CTO",), ("Director",), ("VP of Engineering",), ("Senior director of cto office",),
                                ("Directory clerk",), ("Factotum",)], "job_title string")
    from leadsmith.functions.helpers import with_helpers

    got = [r.p for r in with_helpers(df).select(S.mql_parts()["job_title"].alias("p")).collect()]
    assert got == [20, 20, 20, 20, 5, 5]


def test_scenarios_pipeline(spark):
    reps = spark.createDataFrame(
        [("REP001", "Alex", "Chen", "alex@x.com", "enterprise_sales", True, 12, 50),
         ("REP002", "Maria", "Santos", "maria@x.com", "mid_market_sales", True, 8, 50),
         ("REP003", "James", "Wright", "james@x.com", "smb_sales", True, 5, 50)],
        "rep_id string, first_name string, last_name string, email string, team string, is_active boolean, "
        "current_load int, max_load int")
    leads = frame(spark, [("A", SCEN_A), ("B1", SCEN_B), ("B2", SCEN_B), ("C", SCEN_C)])
    # B2 arrives one second after B1 (same email): the 30-day rule denies it
    leads = leads.withColumn("created_at", F.when(F.col("lead_id") == "B2",
                                                  F.timestamp_add("SECOND", F.lit(1), F.lit(dt.datetime(2025, 3, 2, 10, 0))))
                             .otherwise(F.col("created_at")))
    out = L.qualify_leads(leads, reps, as_of="2025-03-10 00:00:00")
    got = by_id(out, "final_status", "needs_approval", "assigned_rep_id")
    assert got["A"][0] == "rejected_pii"
    assert got["B2"][0] == "rejected_duplicate"
    assert got["B1"][0] != "rejected_duplicate"
    assert got["C"][1] is True  # $200K+ deal needs approval; no answer -> timeout allows
    assert got["C"][0] == "sales_owned" and got["C"][2] == "REP001"


def test_duplicate_fold_statuses(spark):
    """Anchored rule with outcomes: a rejected run lets the next submission through without
    moving the anchor; denied rows never move it."""
    rows = [("L1", "a@x.com", dt.datetime(2025, 1, 1), "rejected"),
            ("L2", "A@x.com ", dt.datetime(2025, 1, 5), "accepted"),   # allowed (status rejected)
            ("L3", "a@x.com", dt.datetime(2025, 1, 20), "accepted"),   # denied: anchor L1, 19 days
            ("L4", "a@x.com", dt.datetime(2025, 2, 1), "accepted"),    # 31 days after L1: registers anew
            ("L5", "a@x.com", dt.datetime(2025, 2, 2), "accepted"),    # denied by L4
            ("L6", "", dt.datetime(2025, 2, 2), "accepted")]           # no email: allowed
    df = spark.createDataFrame(rows, "lead_id string, email string, created_at timestamp, outcome string")
    got = by_id(P.duplicate_lookback(df, outcome=F.col("outcome")), "dup_action", "anchor_id")
    assert got == {"L1": ("allow", "L1"), "L2": ("allow", "L1"), "L3": ("deny", "L1"),
                   "L4": ("allow", "L4"), "L5": ("deny", "L4"), "L6": ("allow", None)}


def test_duplicate_personal_data_stop_keeps_the_status(spark):
    """Rejected, then stopped for personal data, then a good lead: the third is let through, the fourth not."""
    rows = [("L1", "a@x.com", dt.datetime(2025, 1, 1), "rejected", False),
            ("L2", "a@x.com", dt.datetime(2025, 1, 2), "processing", True),
            ("L3", "a@x.com", dt.datetime(2025, 1, 3), "accepted", False),
            ("L4", "a@x.com", dt.datetime(2025, 1, 4), "accepted", False),
            ("L5", "a@x.com", None, "accepted", False)]  # no time: allowed, takes no part
    df = spark.createDataFrame(rows, "lead_id string, email string, created_at timestamp, outcome string, pii boolean")
    got = by_id(P.duplicate_lookback(df, outcome=F.col("outcome"), keeps_status=F.col("pii")), "dup_action", "anchor_id")
    assert got == {"L1": ("allow", "L1"), "L2": ("allow", "L1"), "L3": ("allow", "L1"), "L4": ("deny", "L1"),
                   "L5": ("allow", None)}


def test_status_update_keeps_the_last_reason(spark):
    leads = spark.createDataFrame([("L1", "new", None, None)], "lead_id string, status string, rejection_reason string, updated_at timestamp")
    updates = spark.createDataFrame([("L1", "rejected", "spam", dt.datetime(2025, 1, 1)), ("L1", "mql", None, dt.datetime(2025, 1, 2))],
                                    "lead_id string, status string, rejection_reason string, updated_at timestamp")
    from leadsmith.operators import lifecycle as L

    got = by_id(L.apply_status_updates(leads, updates), "status", "rejection_reason")
    assert got == {"L1": ("mql", "spam")}


def test_partial_policy_overlay(spark, tmp_path):
    """An overlay that switches one policy off leaves the others on."""
    from leadsmith.config import load_config

    f = tmp_path / "overlay.yaml"
    f.write_text("policies:\n  enabled:\n    spend_guard: false\n")
    p = load_config(str(f))["policies"]
    assert not P.enabled("spend_guard", p) and P.enabled("pii_detection", p) and not P.enabled("no_such_policy", p)


def test_long_keys_are_not_cut(spark):
    from leadsmith.sources.fixtures import key_text

    got = [r[0] for r in spark.createDataFrame([(7,), (123456789,)], "k long").select(key_text(F.col("k"))).collect()]
    assert got == ["00000007", "123456789"]


def test_pii_verdict(spark):
    df = spark.createDataFrame([("x", "SSN 123-45-6789"), ("y", "call +1 (555) 123-4567"), ("z", "passport AB1234567"),
                                ("w", "nothing here")], "lead_id string, message string")
    got = by_id(P.pii_verdict(df), "pii_action", "pii_triggered")
    assert got == {"x": ("deny", True), "y": ("allow", False), "z": ("escalate", True), "w": ("allow", False)}


def test_decision_audit_hash(spark):
    import hashlib
    import json

    df = spark.createDataFrame([("L1", "a@b.com", "Acme \"Q\"", "TriageAgent", "accepted", "r" * 300, 0.29)],
                               "lead_id string, email string, company string, agent string, decision string, "
                               "reasoning string, confidence double")
    r = P.decision_audit(df, ["lead_id", "email", "company"]).collect()[0]
    want = hashlib.sha256(json.dumps({"lead_id": "L1", "email": "a@b.com", "company": "Acme \"Q\""},
                                     sort_keys=True).encode()).hexdigest()[:16]
    assert r.input_hash == want
    assert r.confidence_pct == 28 and len(r.reasoning) == 200
    assert (r.duration_ms, r.llm_model, r.tokens_used, r.timestamp_utc) == (0, "unknown", 0, None) and len(r.audit_id) == 8


def test_decision_audit_hash_is_ascii_escaped(spark):
    import hashlib
    import json

    odd = ["José", "日本 👍", "tab\there", "a\x0b\x1f\x7f", 'back\\slash "q"', "\\u000B", ""]
    rows = [(f"L{i}", x, "Acme", "T", "accepted", "r", 0.5) for i, x in enumerate(odd)]
    df = spark.createDataFrame(rows, "lead_id string, email string, company string, agent string, decision string, "
                                     "reasoning string, confidence double")
    got = {r.lead_id: r.input_hash for r in P.decision_audit(df, ["lead_id", "email"]).collect()}
    assert got == {r[0]: hashlib.sha256(json.dumps({"lead_id": r[0], "email": r[1]}, sort_keys=True).encode()).hexdigest()[:16]
                   for r in rows}


def test_spend_guard(spark):
    rows = [(1, "R", dt.datetime(2025, 1, 1, 0, 0, 1), 0.10), (2, "R", dt.datetime(2025, 1, 1, 0, 0, 2), 0.20),
            (3, "R", dt.datetime(2025, 1, 1, 2, 0, 0), 0.12), (4, "R", dt.datetime(2025, 1, 1, 3, 0, 0), 0.09),
            (5, "R", dt.datetime(2025, 1, 1, 4, 0, 0), 0.01)]
    df = spark.createDataFrame(rows, "call_id long, lead_id string, ts timestamp, cost_usd double")
    got = {r.call_id: (r.action, round(r.run_cost_usd, 2)) for r in P.spend_guard(df).collect()}
    assert got == {1: ("allow", 0.10), 2: ("deny", 0.30), 3: ("warn", 0.42), 4: ("deny", 0.51), 5: ("deny", 0.52)}


def test_disabled_policies_allow(spark):
    """A disabled policy allows everything and logs nothing."""
    import copy

    from leadsmith.config import DEFAULT
    from leadsmith.sources import fixtures as fx
    from tests.conftest import SF_SMALL

    cfg = copy.deepcopy(DEFAULT["policies"])
    for k in cfg["enabled"]:
        cfg["enabled"][k] = False
    calls = fx.tool_calls(spark, SF_SMALL)
    assert P.spend_guard(calls, cfg).filter(F.col("action") != "allow").count() == 0
    assert P.unexpected_tools(calls, P.expected_tools(spark, cfg), cfg).count() == 0
    assert P.retry_plan(calls.filter(F.col("status") != "success"), cfg).filter(F.col("action") != "allow").count() == 0
    assert P.audit_log(spark, calls, cfg).count() == 0
    leads = fx.raw_leads(spark, SF_SMALL)
    assert P.pii_verdict(leads, cfg=cfg).filter(F.col("pii_action") != "allow").count() == 0
    assert P.duplicate_lookback(leads, cfg=cfg).filter(F.col("dup_action") != "allow").count() == 0


def test_edge_rows(spark):
    rows = [("two_at", dict(email="x@y@Corp.COM", message="a b c d")),
            ("no_at", dict(email="nodomain", message="a b c d")),
            ("w19", dict(email="a@corp.com", company="C", job_title="T", first_name="Ann", last_name="Lee",
                         form_type="contact_us", message=" ".join(["w"] * 19))),
            ("w20", dict(email="a@corp.com", company="C", job_title="T", first_name="Ann", last_name="Lee",
                         form_type="contact_us", message=" ".join(["w"] * 20))),
            ("bob", dict(email="a@corp.com", first_name="Bob", last_name="Lee", message="a b c d")),
            ("latest", dict(email="a@corp.com", message="see the latest release notes")),
            ("unknown_form", dict(email="a@corp.com", form_type="carrier", message="a b")),
            ("null_vs_empty", dict(email="a@corp.com", company=None, job_title="", message=None))]
    df = frame(spark, rows)
    got = {r.lead_id: r for r in W.screen_leads(df).collect()}
    assert "Personal email domain" not in " ".join(got["two_at"].flags)
    assert got["w20"].quality_score - got["w19"].quality_score == 15
    assert "Gibberish name: 'bob'" in got["bob"].flags
    assert "Spam keyword: 'test'" in got["latest"].flags
    assert "Short message (2 words, min 3 for carrier)" in got["unknown_form"].flags
    assert {"Missing company name", "Missing job title"} <= set(got["null_vs_empty"].flags)
    dom = {r.lead_id: r.d for r in df.select("lead_id", W.email_domain().alias("d")).collect()}
    assert dom["two_at"] == "corp.com" and dom["no_at"] == ""


def test_risk_and_route_boundaries(spark):
    df = spark.createDataFrame([(30, 0), (31, 0), (55, 0), (56, 0), (75, 0), (76, 0), (90, 0), (20, 80), (21, 80)],
                               "bot int, q int")
    got = [(r.level, r.route) for r in df.select(W.risk_level(F.col("bot")).alias("level"),
                                                 W.route(F.col("bot"), F.col("q")).alias("route")).collect()]
    assert [g[0] for g in got] == ["low", "medium", "medium", "high", "high", "critical", "critical", "low", "low"]
    assert [g[1] for g in got] == ["review"] * 6 + ["reject", "accept", "review"]


def test_patterns_and_flags_of_the_whole_run_are_evaluated_once_a_row(spark):
    leads, reps = fx.raw_leads(spark, SF_SMALL), fx.sales_reps(spark, SF_SMALL)
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        plan = L.stage_columns(leads, reps, None, None, "2001-08-02 00:00:00")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    pattern = "(?i)" + next(p for t, p, *_ in DEFAULT["policies"]["pii_patterns"] if t == "ssn")
    assert 0 < plan.count(pattern) <= len(DEFAULT["policies"]["pii_scan_fields"])
    assert plan.count("Form submitted in") == 1
