"""Form screening rules (W1-W17) as one projection.

Each rule returns its bot-risk points, quality points and flag texts as
Columns; ``screen_leads`` adds them up in a single ``select`` — no shuffle, no
UDF, one codegen stage.  Flag order follows the rule order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import AsOf, blank, compact, ts
from ..functions.helpers import h, with_helpers


@dataclass
class Rule:
    bot: Column = field(default_factory=lambda: F.lit(0))
    quality: Column = field(default_factory=lambda: F.lit(0))
    flags: list[Column] = field(default_factory=list)


def _rules(rules: dict | None) -> dict:
    return rules or DEFAULT["form"]


def _s(col: str) -> Column:
    """Null-safe string value ('' for null)."""
    return F.coalesce(F.col(col), F.lit(""))


def email_domain(email: Column | str = "email") -> Column:
    """Lower-case text after the last '@', else ''."""
    e = F.coalesce(F.col(email) if isinstance(email, str) else email, F.lit(""))
    return F.when(e.contains("@"), F.lower(F.substring_index(e, "@", -1))).otherwise(F.lit(""))


def screen_email(rules: dict | None = None) -> Rule:
    """Personal domain -> bot points and a flag; any other domain -> quality points."""
    r = _rules(rules)
    d = h("_dom")
    personal = d.isin(*r["personal_email_domains"])
    return Rule(
        bot=F.when(personal, r["bot_weights"]["personal_email"]).otherwise(0),
        quality=F.when(~personal & (d != ""), r["quality_weights"]["business_email"]).otherwise(0),
        flags=[F.when(personal, F.concat(F.lit("Personal email domain: "), d))],
    )


def screen_required(rules: dict | None = None) -> Rule:
    """Missing required fields add bot points; company / title present add quality."""
    r = _rules(rules)
    bot = F.lit(0)
    quality = F.lit(0)
    flags = []
    bonus = {"company": r["quality_weights"]["has_company"],
             "job_title": r["quality_weights"]["has_job_title"]}
    for fld, penalty, message in r["required_fields"]:
        missing = blank(fld)
        bot = bot + F.when(missing, penalty).otherwise(0)
        flags.append(F.when(missing, F.lit(message)))
        if fld in bonus:
            quality = quality + F.when(~missing, bonus[fld]).otherwise(0)
    return Rule(bot, quality, flags)


def spam_keyword(rules: dict | None = None, keywords: list[str] | None = None) -> Column:
    """First keyword (list order) contained in the lower-cased message, else null."""
    kws = keywords or _rules(rules)["spam_keywords"]
    msg = h("_msg_l")
    out = None
    for kw in kws:
        hit = msg.contains(kw)  # looks at first bytes; instr compares the word at every place
        out = F.when(hit, F.lit(kw)) if out is None else out.when(hit, F.lit(kw))
    return out


def screen_spam(rules: dict | None = None) -> Rule:
    """One flag and one penalty for the first spam keyword found."""
    r = _rules(rules)
    kw = spam_keyword(r)
    return Rule(bot=F.when(kw.isNotNull(), r["bot_weights"]["spam_keyword"]).otherwise(0),
                flags=[F.when(kw.isNotNull(), F.concat(F.lit("Spam keyword: '"), kw, F.lit("'")))])


def _name_check(col: str, r: dict) -> tuple[Column, Column]:
    name = h({"first_name": "_fn", "last_name": "_ln"}[col])
    w = r["bot_weights"]
    blocked = name.isin(*r["blocked_names"])
    short = F.length(name) < r["name_min_length"]
    gibberish = F.size(F.array_distinct(F.split(name, ""))) < r["name_min_unique_chars"]
    quoted = F.concat(F.lit("'"), name, F.lit("'"))
    pts = (F.when(name == "", 0).when(blocked, w["blocked_name"])
           .when(short, w["gibberish_name"]).when(gibberish, w["gibberish_name"]).otherwise(0))
    flag = (F.when(name == "", F.lit(None).cast("string"))
            .when(blocked, F.concat(F.lit("Blocked name: "), quoted))
            .when(short, F.concat(F.lit("Name too short: "), quoted))
            .when(gibberish, F.concat(F.lit("Gibberish name: "), quoted)))
    return pts, flag


def screen_names(rules: dict | None = None) -> Rule:
    """Blocked, too-short and low-variety first/last names (trimmed, lower-cased)."""
    r = _rules(rules)
    p1, f1 = _name_check("first_name", r)
    p2, f2 = _name_check("last_name", r)
    return Rule(bot=p1 + p2, flags=[f1, f2])


def screen_common_name(rules: dict | None = None, sensitivity: str | None = None) -> Rule:
    """Well-known name pairs, only under the configured (high) sensitivity."""
    r = _rules(rules)
    sensitivity = sensitivity or r["sensitivity"]
    if not (sensitivity == r["common_name_sensitivity"] or sensitivity == "high"):
        return Rule()
    first, last = F.lower(_s("first_name")), F.lower(_s("last_name"))
    hit = None
    for a, b in r["common_names"]:
        c = (first == a) & (last == b)
        hit = c if hit is None else hit | c
    return Rule(bot=F.when(hit, r["bot_weights"]["common_name"]).otherwise(0),
                flags=[F.when(hit, F.concat(F.lit("Common name combination: "), first, F.lit(" "), last))])


def _as_ts(col: str) -> Column:
    return F.coalesce(F.col(col).cast("timestamp"), F.try_to_timestamp(F.col(col).cast("string")))


def screen_timing(rules: dict | None = None, sensitivity: str | None = None,
                  start_col: str = "page_load_time", end_col: str = "processed_at") -> Rule:
    """Form filled faster than the minimum for the sensitivity; unparsable times ignored."""
    r = _rules(rules)
    sensitivity = sensitivity or r["sensitivity"]
    min_s = r["min_human_fill_seconds"][sensitivity]
    elapsed = F.timestamp_diff("MICROSECOND", _as_ts(start_col), _as_ts(end_col)) / 1e6
    fast = F.coalesce(elapsed < min_s, F.lit(False))
    return Rule(bot=F.when(fast, r["bot_weights"]["fast_submission"]).otherwise(0),
                flags=[F.when(fast, F.format_string(f"Form submitted in %.1fs (min: {min_s}s)", elapsed))])


def word_count(col: str = "message") -> Column:
    """Whitespace-separated words (empty message -> 0): the number of non-space runs."""
    return F.regexp_count(_s(col), F.lit(r"\S+")).cast("int")


def screen_message(rules: dict | None = None, sensitivity: str | None = None) -> Rule:
    """Short message for the form type -> bot points; >= 20 words -> quality points."""
    r = _rules(rules)
    sensitivity = sensitivity or r["sensitivity"]
    wc = h("_wc")
    form = F.coalesce(F.col("form_type"), F.lit("contact_us"))
    form_min = None
    for ft, n in r["form_type_min_words"].items():
        form_min = F.when(form == ft, n) if form_min is None else form_min.when(form == ft, n)
    form_min = form_min.otherwise(r["unknown_form_min_words"])
    eff = F.greatest(F.lit(r["min_words"].get(sensitivity, 3)), form_min)
    short = (wc < eff) & (eff > 0)
    detailed = ~short & (wc >= r["detailed_message_words"])
    return Rule(
        bot=F.when(short, r["bot_weights"]["short_message"]).otherwise(0),
        quality=F.when(detailed, r["quality_weights"]["detailed_message"]).otherwise(0),
        flags=[F.when(short, F.concat(F.lit("Short message ("), wc.cast("string"), F.lit(" words, min "),
                                      eff.cast("string"), F.lit(" for "), form, F.lit(")")))],
    )


def screen_title(rules: dict | None = None) -> Rule:
    """Senior-title keyword contained in the lower-cased title -> quality points."""
    r = _rules(rules)
    title = h("_title_l")
    hit = None
    for kw in r["senior_title_keywords"]:
        c = title.contains(kw)
        hit = c if hit is None else hit | c
    return Rule(quality=F.when(hit, r["quality_weights"]["senior_title_keywords"]).otherwise(0))


def screen_firmographic(rules: dict | None = None) -> Rule:
    """Enterprise size, demo form, phone and LinkedIn bonuses."""
    r = _rules(rules)
    q = r["quality_weights"]
    quality = (F.when(F.col("company_size").isin(*r["enterprise_company_sizes"]), q["enterprise_company_size"])
               .otherwise(0)
               + F.when(F.col("form_type") == "demo_request", q["demo_request_form"]).otherwise(0)
               + F.when(~blank("phone"), q["has_phone"]).otherwise(0)
               + F.when(~blank("linkedin_url"), q["has_linkedin"]).otherwise(0))
    return Rule(quality=quality)


def cap(x: Column) -> Column:
    """Clamp to 0..100."""
    return F.least(F.greatest(x, F.lit(0)), F.lit(100))


def risk_level(bot: Column, rules: dict | None = None) -> Column:
    """Bot score -> low / medium / high / critical."""
    out = None
    for label, mx in _rules(rules)["risk_levels"]:
        out = F.when(bot <= mx, label) if out is None else out.when(bot <= mx, label)
    return out.otherwise("critical")


def route(bot: Column, quality: Column, rules: dict | None = None) -> Column:
    """Reject / accept / review."""
    r = _rules(rules)
    return (F.when(bot >= r["auto_reject_above_bot_risk"], "reject")
            .when((quality >= r["auto_accept_above_quality"]) & (bot <= r["auto_accept_max_bot_risk"]),
                  "accept")
            .otherwise("review"))


def all_rules(rules: dict | None = None, sensitivity: str | None = None,
              start_col: str = "page_load_time", end_col: str = "processed_at",
              columns: list[str] | None = None) -> list[Rule]:
    """All rules in flag order; the fill-time rule needs both time columns to exist."""
    timing = (columns is None or (start_col in columns and end_col in columns))
    return [screen_email(rules), screen_required(rules), screen_spam(rules), screen_names(rules),
            screen_common_name(rules, sensitivity),
            *([screen_timing(rules, sensitivity, start_col, end_col)] if timing else []),
            screen_message(rules, sensitivity), screen_title(rules), screen_firmographic(rules)]


def flags_of(rules_: list[Rule]) -> Column:
    return compact([f for r in rules_ for f in r.flags])


def screen_leads(leads: DataFrame, rules: dict | None = None, sensitivity: str | None = None,
                 start_col: str = "page_load_time", end_col: str = "processed_at",
                 keep: list[str] | None = None) -> DataFrame:
    """Flags, capped bot and quality scores, risk level and route per lead."""
    rs = all_rules(rules, sensitivity, start_col, end_col, leads.columns)
    bot = cap(sum((r.bot for r in rs), F.lit(0)))
    quality = cap(sum((r.quality for r in rs), F.lit(0)))
    keep = keep if keep is not None else leads.columns
    leads = with_helpers(leads)
    flags = [f for r in rs for f in r.flags]
    # flags in a projection of their own: listing them reads each more than once
    found = leads.select(*keep, *[f.alias(f"_flag{i}") for i, f in enumerate(flags)], bot.alias("bot_score"),
                         quality.alias("quality_score"))
    scored = found.select(*keep, compact([F.col(f"_flag{i}") for i in range(len(flags))]).alias("flags"), "bot_score", "quality_score")
    return scored.select("*", risk_level(F.col("bot_score"), rules).alias("risk_level"),
                         route(F.col("bot_score"), F.col("quality_score"), rules).alias("route"))


def rule_columns(leads: DataFrame, rule: Rule, keep: list[str] = ("lead_id",)) -> DataFrame:
    """One rule's raw contribution (uncapped) — used to test rules one by one."""
    return with_helpers(leads).select(*keep, rule.bot.alias("bot_points"), rule.quality.alias("quality_points"),
                        compact(rule.flags).alias("flags"))


def first_answers(answers: DataFrame) -> DataFrame:
    """Each lead's first answer: whether it was ``y``/``yes``/empty, and when it came.  The answer is read before
    the aggregate, whose buffers are then of fixed width: rows are hashed by lead, not sorted."""
    yes = F.lower(F.trim(F.coalesce(F.col("answer"), F.lit("")))).isin("y", "yes", "")
    return answers.groupBy("lead_id").agg(F.min_by(yes, "answered_at").alias("_yes"), F.min("answered_at").alias("answered_at"))


def resolve_reviews(screened: DataFrame, answers: DataFrame, submitted_col: str = "created_at",
                    as_of: AsOf = None, timeout_s: int | None = None,
                    on_timeout: str = "accepted") -> DataFrame:
    """Settle ``review`` rows with the operator's answer.

    An answer ``y``/``yes``/empty within the timeout accepts, any other answer
    rejects; no answer within the timeout takes ``on_timeout``; a row still
    inside its window without an answer stays ``pending``.  Answers are joined
    on the key after keeping each lead's first answer (``min_by`` — one
    aggregate, so a lead answered many times cannot fan the join out).
    """
    timeout_s = timeout_s if timeout_s is not None else DEFAULT["form"]["human_review_timeout_seconds"]
    j = screened.join(first_answers(answers), "lead_id", "left")
    deadline = F.timestamp_add("SECOND", F.lit(timeout_s), F.col(submitted_col))
    in_time = F.col("answered_at").isNotNull() & (F.col("answered_at") <= deadline)
    decision = (F.when(F.col("route") == "accept", "accepted")
                .when(F.col("route") == "reject", "rejected")
                .when(in_time & F.col("_yes"), "accepted")
                .when(in_time, "rejected")
                .when(ts(as_of) < deadline, "pending")
                .otherwise(on_timeout))
    how = (F.when(F.col("route") != "review", "rules")
           .when(in_time, "operator")
           .when(ts(as_of) < deadline, "waiting")
           .otherwise("timeout"))
    return j.select(*screened.columns, decision.alias("review_decision"), how.alias("resolved_by"))


NORMALIZED_FIELDS = ["first_name", "last_name", "company", "job_title", "industry"]


def merge_normalized(leads: DataFrame, results: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Take the normalised value unless it is null or empty (``analysis or raw``)."""
    fields = fields or NORMALIZED_FIELDS
    r = results.select("lead_id", *[F.col(f"normalized_{f}") for f in fields])
    j = leads.join(r, "lead_id", "left")
    out = []
    for c in leads.columns:
        if c in fields:
            out.append(F.coalesce(F.nullif(F.col(f"normalized_{c}"), F.lit("")), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def flag_union(*arrays: Column) -> Column:
    """Distinct flags of several arrays, first occurrence order kept."""
    return F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]))
