"""DuckDB text for the per-lead rules (screening, triage, MQL, BANT, PII).

Each function mirrors the Spark rule of the same name in ``leadsmith.operators``
and returns SQL expressions over the columns of a lead row.
"""

from __future__ import annotations

from ..config import DEFAULT
from ..functions.common import any_word_regex, keyword_alternation


def q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def lst(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def s(col: str) -> str:
    return f"coalesce({col}, '')"


def blank(col: str) -> str:
    return f"({col} IS NULL OR {col} = '')"


def arr(items: list[str]) -> str:
    return f"list_filter([{', '.join(items)}]::VARCHAR[], lambda x: x IS NOT NULL)"


# ----------------------------------------------------------------- screening

def email_domain(col: str = "email") -> str:
    return (f"(CASE WHEN strpos({s(col)}, '@') > 0 THEN lower(string_split({s(col)}, '@')[-1]) "
            f"ELSE '' END)")


def screen_email(r=None):
    r = r or DEFAULT["form"]
    d = email_domain()
    personal = f"({d} IN {lst(r['personal_email_domains'])})"
    return (f"(CASE WHEN {personal} THEN {r['bot_weights']['personal_email']} ELSE 0 END)",
            f"(CASE WHEN NOT {personal} AND {d} <> '' THEN {r['quality_weights']['business_email']} ELSE 0 END)",
            [f"(CASE WHEN {personal} THEN 'Personal email domain: ' || {d} END)"])


def screen_required(r=None):
    r = r or DEFAULT["form"]
    bonus = {"company": r["quality_weights"]["has_company"],
             "job_title": r["quality_weights"]["has_job_title"]}
    bot, qual, flags = [], [], []
    for fld, pen, msg in r["required_fields"]:
        bot.append(f"(CASE WHEN {blank(fld)} THEN {pen} ELSE 0 END)")
        flags.append(f"(CASE WHEN {blank(fld)} THEN {q(msg)} END)")
        if fld in bonus:
            qual.append(f"(CASE WHEN NOT {blank(fld)} THEN {bonus[fld]} ELSE 0 END)")
    return "(" + " + ".join(bot) + ")", "(" + " + ".join(qual) + ")", flags


def spam_keyword(r=None, keywords=None) -> str:
    kws = keywords or (r or DEFAULT["form"])["spam_keywords"]
    msg = f"lower({s('message')})"
    return "(CASE " + " ".join(f"WHEN strpos({msg}, {q(k)}) > 0 THEN {q(k)}" for k in kws) + " END)"


def screen_spam(r=None):
    r = r or DEFAULT["form"]
    kw = spam_keyword(r)
    return (f"(CASE WHEN {kw} IS NOT NULL THEN {r['bot_weights']['spam_keyword']} ELSE 0 END)", "0",
            [f"(CASE WHEN {kw} IS NOT NULL THEN 'Spam keyword: ''' || {kw} || '''' END)"])


def _name(col: str, r):
    n = f"lower(trim({s(col)}))"
    w = r["bot_weights"]
    blocked = f"({n} IN {lst(r['blocked_names'])})"
    short = f"(length({n}) < {r['name_min_length']})"
    gib = f"(len(list_distinct(string_split({n}, ''))) < {r['name_min_unique_chars']})"
    quoted = f"'''' || {n} || ''''"
    pts = (f"(CASE WHEN {n} = '' THEN 0 WHEN {blocked} THEN {w['blocked_name']} WHEN {short} "
           f"THEN {w['gibberish_name']} WHEN {gib} THEN {w['gibberish_name']} ELSE 0 END)")
    flag = (f"(CASE WHEN {n} = '' THEN NULL WHEN {blocked} THEN 'Blocked name: ' || {quoted} "
            f"WHEN {short} THEN 'Name too short: ' || {quoted} WHEN {gib} THEN 'Gibberish name: ' || {quoted} END)")
    return pts, flag


def screen_names(r=None):
    r = r or DEFAULT["form"]
    p1, f1 = _name("first_name", r)
    p2, f2 = _name("last_name", r)
    return f"({p1} + {p2})", "0", [f1, f2]


def screen_common_name(r=None, sensitivity=None):
    r = r or DEFAULT["form"]
    sensitivity = sensitivity or r["sensitivity"]
    if not (sensitivity == r["common_name_sensitivity"] or sensitivity == "high"):
        return "0", "0", []
    first, last = f"lower({s('first_name')})", f"lower({s('last_name')})"
    hit = " OR ".join(f"({first} = {q(a)} AND {last} = {q(b)})" for a, b in r["common_names"])
    return (f"(CASE WHEN {hit} THEN {r['bot_weights']['common_name']} ELSE 0 END)", "0",
            [f"(CASE WHEN {hit} THEN 'Common name combination: ' || {first} || ' ' || {last} END)"])


def screen_timing(r=None, sensitivity=None, start="page_load_time", end="processed_at"):
    r = r or DEFAULT["form"]
    sensitivity = sensitivity or r["sensitivity"]
    mn = r["min_human_fill_seconds"][sensitivity]
    el = f"(date_sub('microsecond', {start}, {end}) / 1e6)"
    fast = f"coalesce({el} < {mn}, false)"
    return (f"(CASE WHEN {fast} THEN {r['bot_weights']['fast_submission']} ELSE 0 END)", "0",
            [f"(CASE WHEN {fast} THEN printf('Form submitted in %.1fs (min: {mn}s)', {el}) END)"])


def word_count(col: str = "message") -> str:
    return f"len(list_filter(regexp_split_to_array({s(col)}, '\\s+'), lambda w: w <> ''))"


def screen_message(r=None, sensitivity=None):
    r = r or DEFAULT["form"]
    sensitivity = sensitivity or r["sensitivity"]
    wc = word_count()
    form = "coalesce(form_type, 'contact_us')"
    fm = ("(CASE " + " ".join(f"WHEN {form} = {q(k)} THEN {v}" for k, v in r["form_type_min_words"].items())
          + f" ELSE {r['unknown_form_min_words']} END)")
    eff = f"greatest({r['min_words'].get(sensitivity, 3)}, {fm})"
    short = f"({wc} < {eff} AND {eff} > 0)"
    return (f"(CASE WHEN {short} THEN {r['bot_weights']['short_message']} ELSE 0 END)",
            f"(CASE WHEN NOT {short} AND {wc} >= {r['detailed_message_words']} "
            f"THEN {r['quality_weights']['detailed_message']} ELSE 0 END)",
            [f"(CASE WHEN {short} THEN 'Short message (' || CAST({wc} AS VARCHAR) || ' words, min ' || "
             f"CAST({eff} AS VARCHAR) || ' for ' || {form} || ')' END)"])


def screen_title(r=None):
    r = r or DEFAULT["form"]
    t = f"lower({s('job_title')})"
    hit = " OR ".join(f"strpos({t}, {q(k)}) > 0" for k in r["senior_title_keywords"])
    return "0", f"(CASE WHEN {hit} THEN {r['quality_weights']['senior_title_keywords']} ELSE 0 END)", []


def screen_firmographic(r=None):
    r = r or DEFAULT["form"]
    w = r["quality_weights"]
    return "0", (f"((CASE WHEN company_size IN {lst(r['enterprise_company_sizes'])} THEN "
                 f"{w['enterprise_company_size']} ELSE 0 END) + (CASE WHEN form_type = 'demo_request' THEN "
                 f"{w['demo_request_form']} ELSE 0 END) + (CASE WHEN NOT {blank('phone')} THEN {w['has_phone']} "
                 f"ELSE 0 END) + (CASE WHEN NOT {blank('linkedin_url')} THEN {w['has_linkedin']} ELSE 0 END))"), []


def cap(x: str) -> str:
    return f"least(greatest({x}, 0), 100)"


def risk_level(bot: str, r=None) -> str:
    r = r or DEFAULT["form"]
    return "(CASE " + " ".join(f"WHEN {bot} <= {mx} THEN {q(lab)}" for lab, mx in r["risk_levels"]) \
        + " ELSE 'critical' END)"


def route(bot: str, qual: str, r=None) -> str:
    r = r or DEFAULT["form"]
    return (f"(CASE WHEN {bot} >= {r['auto_reject_above_bot_risk']} THEN 'reject' "
            f"WHEN {qual} >= {r['auto_accept_above_quality']} AND {bot} <= {r['auto_accept_max_bot_risk']} "
            f"THEN 'accept' ELSE 'review' END)")


def all_rules(r=None, sensitivity=None, start="page_load_time", end="processed_at"):
    return [screen_email(r), screen_required(r), screen_spam(r), screen_names(r),
            screen_common_name(r, sensitivity), screen_timing(r, sensitivity, start, end),
            screen_message(r, sensitivity), screen_title(r), screen_firmographic(r)]


def screen_select(r=None, sensitivity=None, start="page_load_time", end="processed_at") -> str:
    """``flags, bot_score, quality_score`` select list (risk/route go one level up)."""
    rs = all_rules(r, sensitivity, start, end)
    bot = cap(" + ".join(x[0] for x in rs))
    qual = cap(" + ".join(x[1] for x in rs))
    flags = arr([f for x in rs for f in x[2]])
    return f"{flags} AS flags, {bot} AS bot_score, {qual} AS quality_score"


# ----------------------------------------------------------------- MQL / BANT

def company_employees(col: str = "company_size") -> str:
    return f"TRY_CAST(regexp_extract({s(col)}, '^(\\d+)', 1) AS INTEGER)"


def keyword_count(keywords) -> str:
    return (f"CAST(len(list_distinct(regexp_extract_all(lower({s('message')}), "
            f"{q(keyword_alternation(keywords))}, 1))) AS INTEGER)")


def mql_parts(c=None) -> dict[str, str]:
    c = c or DEFAULT["scoring"]
    title = any_word_regex(c["mql_qualifying_titles"])
    emp = company_employees()
    size = "(CASE " + " ".join(f"WHEN {emp} >= {m} THEN {v}" for m, v in c["mql_company_size_tiers"]) \
        + " ELSE 0 END)"
    form = "(CASE " + " ".join(f"WHEN form_type = {q(k)} THEN {v}" for k, v in c["mql_form_type_scores"].items()) \
        + " ELSE 0 END)"
    d = email_domain()
    intent_hits = keyword_count(c["mql_intent_keywords"])
    complete = " + ".join(f"(CASE WHEN NOT {blank(f)} THEN {c['mql_completeness_per_field']} ELSE 0 END)"
                          for f in c["mql_completeness_fields"])
    return {
        "job_title": f"(CASE WHEN regexp_matches({s('job_title')}, {q(title)}) THEN {c['mql_title_score']} "
                     f"ELSE {c['mql_title_default']} END)",
        "company_size": size,
        "industry": f"(CASE WHEN industry IN {lst(c['mql_high_value_industries'])} THEN "
                    f"{c['mql_industry_score']} ELSE {c['mql_industry_default']} END)",
        "form_type": form,
        "email_domain": f"(CASE WHEN {d} <> '' AND {d} NOT IN {lst(c['mql_personal_domains'])} THEN "
                        f"{c['mql_business_email_score']} ELSE {c['mql_personal_email_score']} END)",
        "message_intent": f"least(({intent_hits}) * {c['mql_intent_per_keyword']}, {c['mql_intent_max']})",
        "completeness": f"({complete})",
    }


def bant_parts(c=None, ours=None) -> dict[str, str]:
    c = c or DEFAULT["scoring"]
    ours = ours or DEFAULT["ours"]
    msg = s("message")
    decision = any_word_regex(c["bant_decision_titles"])
    influencer = any_word_regex(ours["bant_influencer_titles"])
    budget_kw = any_word_regex(ours["bant_budget_keywords"], plural=True)
    emp = company_employees()
    authority = (f"(CASE WHEN regexp_matches({s('job_title')}, {q(decision)}) THEN {c['bant_authority_score']} "
                 f"WHEN regexp_matches({s('job_title')}, {q(influencer)}) THEN {c['bant_influencer_score']} "
                 f"ELSE {c['bant_unknown_authority_score']} END)")
    budget = (f"(CASE WHEN regexp_matches({msg}, {q(budget_kw)}) THEN {c['bant_budget_confirmed']} "
              f"WHEN regexp_matches({s('job_title')}, {q(decision)}) OR coalesce({emp}, 0) >= 200 "
              f"THEN {c['bant_budget_implied']} ELSE {c['bant_budget_unknown']} END)")
    need_hits = keyword_count(c["bant_need_keywords"])
    need = f"least(({need_hits}) * {c['bant_need_per_keyword']}, {c['bant_need_max']})"
    days = timeline_days()
    tl = "(CASE WHEN " + f"{days} IS NULL THEN {c['bant_timeline_unknown_score']} " + " ".join(
        f"WHEN {days} < {lim} THEN {v}" for lim, v in c["bant_timeline_scores"]) \
        + f" ELSE {c['bant_timeline_long_score']} END)"
    return {"budget": budget, "authority": authority, "need": need, "timeline": tl}


TIMELINE_RE = r"(?i)\bwithin\s+(\d+)\s+(day|week|month)s?\b"


def timeline_days(ours=None) -> str:
    ours = ours or DEFAULT["ours"]
    now = any_word_regex(ours["bant_timeline_now_words"])
    msg = s("message")
    per = (f"list_transform(regexp_extract_all({msg}, {q(TIMELINE_RE)}, 0), lambda m: "
           f"CAST(regexp_extract(m, '(\\d+)', 1) AS BIGINT) * (CASE WHEN regexp_matches(lower(m), 'week') THEN 7 "
           f"WHEN regexp_matches(lower(m), 'month') THEN 30 ELSE 1 END))")
    return (f"(CASE WHEN regexp_matches({msg}, {q(now)}) THEN 0 ELSE list_min({per}) END)")
