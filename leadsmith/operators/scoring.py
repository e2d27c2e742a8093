"""Triage (T1-T2), MQL scoring (M1-M9) and BANT scoring.

All rules are Column expressions over a lead row: keyword tests are single
alternation regexes (``rlike``) or per-keyword regex sums when the *number* of
distinct keywords matters.  Patterns use only ``\\b``, ``.*``, ``\\s``, ``\\d``
and literals, so the JVM (java.util.regex) and RE2 oracles agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import AsOf, blank, contains_any, keyword_alternation, rlike_any, ts
from ..functions.helpers import h, with_helpers
from .screening import spam_keyword


def _s(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def employees(col: str = "company_size") -> Column:
    """Lower bound of a size label such as ``201-1000`` or ``5000+`` (null if none)."""
    return F.regexp_extract(_s(col), r"^(\d+)", 1).try_cast("int")


# ----------------------------------------------------------------- triage

def triage_rules(cfg: dict | None = None) -> tuple[Column, Column]:
    """(decision, rejection_reason).  Order: missing email, missing company
    (covers "personal email with no company"), spam words; else accepted."""
    c = cfg or DEFAULT["scoring"]
    spam = spam_keyword(keywords=c["triage_spam_keywords"])
    reason = (F.when(blank("email"), "invalid_email")
              .when(blank("company"), "incomplete_data")
              .when(spam.isNotNull(), "spam"))
    decision = F.when(reason.isNotNull(), "rejected").otherwise("accepted")
    return decision, reason


def triage_status(decision: Column) -> tuple[Column, Column]:
    """New status and next step for a triage decision."""
    status = (F.when(decision == "accepted", "accepted").when(decision == "rejected", "rejected")
              .otherwise("processing"))
    nxt = (F.when(decision == "accepted", "mql_agent").when(decision == "rejected", "none")
           .otherwise("human_review"))
    return status, nxt


def triage_leads(leads: DataFrame, cfg: dict | None = None, keep: list[str] | None = None) -> DataFrame:
    decision, reason = triage_rules(cfg)
    status, nxt = triage_status(decision)
    keep = keep if keep is not None else leads.columns
    return with_helpers(leads).select(*keep, decision.alias("decision"), reason.alias("triage_reason"),
                        status.alias("triage_status"), nxt.alias("next_agent"))


# ----------------------------------------------------------------- MQL

MQL_PARTS = ["job_title", "company_size", "industry", "form_type", "email_domain",
             "message_intent", "completeness"]


def _count_words(text_lower: Column, keywords: list[str]) -> Column:
    """Number of distinct keywords present as whole words (optional plural s) — one
    regex pass over the lower-cased text instead of one per keyword, over texts that hold the first word of one."""
    found = F.regexp_extract_all(text_lower, F.lit(keyword_alternation(keywords)), 1)
    first = [k.split()[0].lower() for k in keywords if k.split()]
    count = F.size(F.array_distinct(found))
    return F.when(contains_any(text_lower, first), count).otherwise(0) if len(first) == len(keywords) else count


def mql_parts(cfg: dict | None = None) -> dict[str, Column]:
    """M1-M7 as named integer Columns."""
    c = cfg or DEFAULT["scoring"]
    emp = h("_emp")
    size = None
    for mn, pts in c["mql_company_size_tiers"]:
        size = F.when(emp >= mn, pts) if size is None else size.when(emp >= mn, pts)
    form = None
    for ft, pts in c["mql_form_type_scores"].items():
        cond = F.col("form_type") == ft
        form = F.when(cond, pts) if form is None else form.when(cond, pts)
    d = h("_dom")
    intent = _count_words(h("_msg_l"), c["mql_intent_keywords"])
    complete = sum((F.when(~blank(f), c["mql_completeness_per_field"]).otherwise(0)
                    for f in c["mql_completeness_fields"]), F.lit(0))
    return {
        "job_title": F.when(rlike_any(h("_title"), h("_title_l"), c["mql_qualifying_titles"]),
                            c["mql_title_score"]).otherwise(c["mql_title_default"]),
        "company_size": size.otherwise(0),
        "industry": F.when(F.col("industry").isin(*c["mql_high_value_industries"]),
                           c["mql_industry_score"]).otherwise(c["mql_industry_default"]),
        "form_type": form.otherwise(0),
        "email_domain": F.when((d != "") & ~d.isin(*c["mql_personal_domains"]),
                               c["mql_business_email_score"]).otherwise(c["mql_personal_email_score"]),
        "message_intent": F.least(intent * c["mql_intent_per_keyword"], F.lit(c["mql_intent_max"])),
        "completeness": complete,
    }


def score_mql(leads: DataFrame, cfg: dict | None = None, keep: list[str] | None = None) -> DataFrame:
    """M1-M8: breakdown struct, total and the qualified flag (one projection)."""
    c = cfg or DEFAULT["scoring"]
    parts = mql_parts(c)
    keep = keep if keep is not None else leads.columns
    bd = F.struct(*[parts[p].cast("int").alias(p) for p in MQL_PARTS])
    out = with_helpers(leads).select(*keep, bd.alias("score_breakdown"))
    total = sum((F.col(f"score_breakdown.{p}") for p in MQL_PARTS), F.lit(0))
    return out.select("*", total.alias("mql_score"), (total >= c["mql_threshold"]).alias("qualified"))


# ----------------------------------------------------------------- BANT

TIMELINE_RE = r"(?i)\bwithin\s+(\d+)\s+(day|week|month)s?\b"


def timeline_days(cfg: dict | None = None) -> Column:
    """B4 parsing: 0 for asap/urgent/immediately, else the smallest "within N unit"."""
    ours = cfg or DEFAULT["ours"]
    msg = h("_msg")
    per = F.transform(
        F.regexp_extract_all(msg, F.lit(TIMELINE_RE), 0),
        lambda m: F.regexp_extract(m, r"(\d+)", 1).try_cast("long")
        * F.when(F.lower(m).contains("week"), 7).when(F.lower(m).contains("month"), 30).otherwise(1))
    # every match of TIMELINE_RE holds "within": other texts are not searched for it
    return F.when(rlike_any(msg, h("_msg_l"), ours["bant_timeline_now_words"]), F.lit(0).cast("long")) \
        .when(h("_msg_l").contains("within"), F.array_min(per))


def bant_found(cfg: dict | None = None, ours: dict | None = None) -> dict[str, Column]:
    """What the parts find in a lead's texts and read more than once: a projection of these runs each pattern once a row."""
    c = cfg or DEFAULT["scoring"]
    return {"decision": rlike_any(h("_title"), h("_title_l"), c["bant_decision_titles"]),
            "days": timeline_days(ours or DEFAULT["ours"])}


def bant_parts(cfg: dict | None = None, ours: dict | None = None, found: dict[str, Column] | None = None) -> dict[str, Column]:
    """B1-B4 as named integer Columns; ``found``: references to columns that hold ``bant_found``."""
    c = cfg or DEFAULT["scoring"]
    ours = ours or DEFAULT["ours"]
    msg, title = h("_msg"), h("_title")
    found = found or bant_found(c, ours)
    decision, days = found["decision"], found["days"]
    influencer = rlike_any(title, h("_title_l"), ours["bant_influencer_titles"])
    budget = (F.when(rlike_any(msg, h("_msg_l"), ours["bant_budget_keywords"], plural=True),
                     c["bant_budget_confirmed"])
              .when(decision | (F.coalesce(h("_emp"), F.lit(0)) >= 200), c["bant_budget_implied"])
              .otherwise(c["bant_budget_unknown"]))
    authority = (F.when(decision, c["bant_authority_score"])
                 .when(influencer, c["bant_influencer_score"])
                 .otherwise(c["bant_unknown_authority_score"]))
    need = F.least(_count_words(h("_msg_l"), c["bant_need_keywords"]) * c["bant_need_per_keyword"],
                   F.lit(c["bant_need_max"]))
    tl = F.when(days.isNull(), c["bant_timeline_unknown_score"])
    for lim, pts in c["bant_timeline_scores"]:
        tl = tl.when(days < lim, pts)
    tl = tl.otherwise(c["bant_timeline_long_score"])
    return {"budget": budget, "authority": authority, "need": need, "timeline": tl}


def deal_size(need: Column, ours: dict | None = None, emp: Column | None = None) -> Column:
    """Deal-size label from company size and need (our formula)."""
    labels = (ours or DEFAULT["ours"])["deal_size_labels"]
    emp = h("_emp") if emp is None else emp
    return (F.when((emp >= 1000) & (need >= 15), labels[0]).when(emp >= 1000, labels[1])
            .when(emp >= 200, labels[2]).otherwise(labels[3]))


def close_date(timeline: Column, as_of: AsOf = None, ours: dict | None = None) -> Column:
    """Expected close date by timeline bucket; null when the timeline is unknown."""
    days = None
    for score, d in (ours or DEFAULT["ours"])["close_date_days"].items():
        days = F.when(timeline == score, d) if days is None else days.when(timeline == score, d)
    return F.date_add(F.to_date(ts(as_of)), days)


def assign_team_col(cfg: dict | None = None) -> Column:
    """Team by employees; unknown size routes to the smallest team."""
    c = cfg or DEFAULT["scoring"]
    emp = h("_emp")
    out = None
    for mn, team in c["sales_routing"]:
        out = F.when(emp >= mn, team) if out is None else out.when(emp >= mn, team)
    return out.otherwise(c["sales_routing"][-1][1])


def score_bant(leads: DataFrame, cfg: dict | None = None, as_of: AsOf = None,
               keep: list[str] | None = None) -> DataFrame:
    """Four parts, total, qualified, deal size, close date and team."""
    c = cfg or DEFAULT["scoring"]
    parts = bant_parts(c)
    keep = keep if keep is not None else leads.columns
    out = with_helpers(leads).select(*keep, *[parts[p].cast("int").alias(f"bant_score_{p}") for p in parts],
                                     assign_team_col(c).alias("assigned_team"), h("_emp").alias("_e"))
    total = sum((F.col(f"bant_score_{p}") for p in parts), F.lit(0))
    return out.select(*[x for x in out.columns if x != "_e"], total.alias("sql_score"),
                      (total >= c["bant_threshold"]).alias("qualified"),
                      deal_size(F.col("bant_score_need"), emp=F.col("_e")).alias("estimated_deal_size"),
                      close_date(F.col("bant_score_timeline"), as_of).alias("estimated_close_date"))
