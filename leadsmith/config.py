"""Rule configuration.

Everything a rule needs is a plain value here; the operators turn these values
into literals inside Column expressions, so Catalyst constant-folds them and no
Python runs per row.  ``load_config(path)`` overlays a YAML file (same keys) on
the defaults for deployments that tune thresholds without touching code.
"""

from __future__ import annotations

import copy
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the published rule configuration of the
# lead pipeline we re-implement (form rules, scoring rubric, policy pack);
# they are listed here verbatim and in their original order.
# ---------------------------------------------------------------------------

FORM_RULES: dict[str, Any] = {
    "sensitivity": "medium",
    "risk_levels": [("low", 30), ("medium", 55), ("high", 75), ("critical", 100)],
    "auto_reject_above_bot_risk": 90,
    "auto_accept_above_quality": 80,
    "auto_accept_max_bot_risk": 20,
    "human_review_timeout_seconds": 60,
    "min_human_fill_seconds": {"low": 3, "medium": 5, "high": 8},
    "personal_email_domains": [
        "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com",
        "icloud.com", "mail.com", "protonmail.com", "live.com", "msn.com",
        "yahoo.co.uk", "googlemail.com",
    ],
    "spam_keywords": [
        "free money", "lottery", "winner", "click here", "make money",
        "work from home", "guaranteed", "no risk", "limited time", "act now",
        "congratulations", "you have been selected", "test", "testing", "asdf",
        "qwerty", "123456", "hello world", "viagra", "casino",
    ],
    "name_min_length": 2,
    "name_min_unique_chars": 3,
    "blocked_names": [
        "test", "testing", "tester", "asdf", "qwerty", "admin", "user", "guest",
        "demo", "sample", "example", "fake", "bot", "robot", "anonymous",
    ],
    "common_name_sensitivity": "high",
    "common_names": [
        ("john", "smith"), ("jane", "doe"), ("john", "doe"), ("test", "user"),
        ("first", "last"), ("foo", "bar"),
    ],
    # (field, bot penalty, flag text)
    "required_fields": [
        ("company", 15, "Missing company name"),
        ("job_title", 10, "Missing job title"),
        ("first_name", 20, "Missing first name"),
        ("last_name", 15, "Missing last name"),
    ],
    "min_words": {"low": 0, "medium": 3, "high": 5},
    "form_type_min_words": {
        "demo_request": 5, "contact_us": 3, "whitepaper_download": 0,
        "newsletter_signup": 0, "webinar_registration": 0, "free_trial": 3,
    },
    "unknown_form_min_words": 3,
    "detailed_message_words": 20,
    "bot_weights": {
        "personal_email": 20, "missing_company": 15, "missing_job_title": 10,
        "spam_keyword": 30, "gibberish_name": 25, "fast_submission": 20,
        "blocked_name": 40, "short_message": 10, "common_name": 5,
    },
    "quality_weights": {
        "business_email": 20, "has_company": 15, "has_job_title": 10,
        "senior_title_keywords": 15, "enterprise_company_size": 10,
        "detailed_message": 15, "demo_request_form": 15, "has_phone": 5,
        "has_linkedin": 5,
    },
    "enterprise_company_sizes": ["1001-5000", "5000+"],
    "senior_title_keywords": [
        "ceo", "cto", "cio", "cfo", "vp", "vice president", "director", "head of",
        "chief", "svp", "evp", "president", "founder", "owner", "partner",
    ],
}

SCORING: dict[str, Any] = {
    "mql_threshold": 50,
    "mql_qualifying_titles": [
        "CTO", "CIO", "VP Engineering", "VP Sales", "VP Marketing", "Director",
        "Head of", "Chief",
    ],
    "mql_title_score": 20,
    "mql_title_default": 5,
    # (minimum employees, score), highest first
    "mql_company_size_tiers": [(1000, 15), (200, 10), (50, 5), (1, 2)],
    "mql_high_value_industries": [
        "Technology", "Financial Services", "Healthcare", "Manufacturing", "Retail",
    ],
    "mql_industry_score": 10,
    "mql_industry_default": 3,
    "mql_form_type_scores": {
        "demo_request": 20, "contact_us": 15, "whitepaper_download": 10,
        "newsletter_signup": 5, "webinar_registration": 8,
    },
    "mql_business_email_score": 10,
    "mql_personal_email_score": 0,
    "mql_personal_domains": ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com"],
    "mql_intent_keywords": [
        "pricing", "demo", "trial", "purchase", "buy", "budget", "urgent", "asap",
        "integrate", "migrate",
    ],
    "mql_intent_per_keyword": 3,
    "mql_intent_max": 15,
    "mql_completeness_fields": ["first_name", "last_name", "email", "company", "phone"],
    "mql_completeness_per_field": 2,
    "bant_threshold": 70,
    "bant_budget_confirmed": 25,
    "bant_budget_implied": 15,
    "bant_budget_unknown": 0,
    "bant_decision_titles": ["CEO", "CTO", "CIO", "CFO", "VP", "Director", "Head of"],
    "bant_authority_score": 25,
    "bant_influencer_score": 15,
    "bant_unknown_authority_score": 5,
    "bant_need_keywords": [
        "pain point", "challenge", "problem", "struggling", "need", "looking for",
        "evaluating", "replacing",
    ],
    "bant_need_per_keyword": 5,
    "bant_need_max": 25,
    # (upper bound in days, exclusive; score): <30 immediate, <90 short, <180 medium
    "bant_timeline_scores": [(30, 25), (90, 20), (180, 10)],
    "bant_timeline_long_score": 5,
    "bant_timeline_unknown_score": 0,
    "triage_spam_keywords": ["free money", "lottery", "winner", "unsubscribe"],
    # (minimum employees, team), highest first
    "sales_routing": [(1000, "enterprise_sales"), (200, "mid_market_sales"), (1, "smb_sales")],
}

POLICIES: dict[str, Any] = {
    "enabled": {
        "spend_guard": True, "pii_detection": True, "approval_gate": True,
        "retry_fallback": True, "decision_audit": True, "duplicate_detection": True,
        "tool_transparency": True,
    },
    "max_cost_per_run_usd": 0.50,
    "max_cost_per_agent_usd": 0.15,
    "warn_at_pct": 80,
    # (type, pattern, severity, action) in scan order; matched case-insensitively
    "pii_patterns": [
        ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "critical", "deny"),
        ("credit_card", r"\b(?:\d{4}[-\s]?){3}\d{4}\b", "critical", "deny"),
        ("passport", r"\b[A-Z]{1,2}\d{6,9}\b", "high", "escalate"),
        ("phone_number", r"\b(\+\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b", "low", "allow"),
        ("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "low", "allow"),
    ],
    "pii_scan_fields": ["message", "first_name", "last_name", "company", "raw_payload"],
    "severity_rank": {"clean": 0, "low": 1, "high": 2, "critical": 3},
    "action_rank": {"allow": 0, "escalate": 1, "deny": 2},
    "approval_deal_size": "$200K+",
    "approval_min_bant": 60,
    "approval_timeout_seconds": 120,
    "max_retries": 1,
    "retry_delay_seconds": 2,
    "backoff_multiplier": 2,
    "fallback_actions": {
        "WebFormAgent": "escalate", "TriageAgent": "escalate", "MQLAgent": "escalate",
        "SQLAgent": "escalate", "AnalyticsAgent": "allow",
    },
    "reasoning_max_chars": 200,
    "input_hash_chars": 16,
    "policy_pack": "starter/1.0.0",
    "lookback_days": 30,
    "allow_resubmit_statuses": ["rejected", "nurture"],
    "expected_tools_per_agent": {
        "WebFormAgent": ["claude_api", "rules_engine"],
        "TriageAgent": ["claude_api", "databricks_write"],
        "MQLAgent": ["claude_api", "databricks_read", "databricks_write"],
        "SQLAgent": ["claude_api", "databricks_read", "databricks_write"],
        "AnalyticsAgent": ["claude_api", "databricks_read"],
    },
    "audit_retention_days": 365,
}

ANALYTICS: dict[str, Any] = {
    # benchmark ranges from the analytics prompt: (metric, low, high)
    "benchmarks": [
        ("mql_conversion_rate", 0.15, 0.25),
        ("sql_conversion_rate", 0.30, 0.40),
        ("avg_time_to_mql", 2.0, 6.0),
        ("overall_funnel_rate", 0.05, 0.15),
    ],
}

# ---------------------------------------------------------------------------
# Our own choices where the reference leaves the decision to a language model.
# ---------------------------------------------------------------------------

OURS: dict[str, Any] = {
    "bant_budget_keywords": ["budget", "pricing", "procurement"],
    "bant_influencer_titles": ["manager", "lead", "champion"],
    "bant_timeline_now_words": ["asap", "urgent", "immediately"],
    # close date offset (days) per timeline score
    "close_date_days": {25: 30, 20: 90, 10: 180, 5: 365},
    "deal_size_labels": ["$200K+", "$50K-$200K", "$10K-$50K", "<$10K"],
    # midpoints used to value the pipeline per deal-size label
    "deal_size_midpoints": {"<$10K": 5000.0, "$10K-$50K": 30000.0, "$50K-$200K": 125000.0, "$200K+": 200000.0},
    "human_review_confidence": 0.7,
    "stuck_statuses": ["new", "processing", "accepted", "mql", "sql"],
    # rows per key above which the duplicate fold leaves the in-memory array
    # fold (quadratic in the key's rows) for the sorted, constant-memory fold
}


def load_config(path: str | None = None) -> dict[str, dict[str, Any]]:
    """Return a deep copy of the defaults, overlaid with a YAML file if given."""
    cfg = {
        "form": copy.deepcopy(FORM_RULES),
        "scoring": copy.deepcopy(SCORING),
        "policies": copy.deepcopy(POLICIES),
        "analytics": copy.deepcopy(ANALYTICS),
        "ours": copy.deepcopy(OURS),
    }
    if path:
        import yaml  # driver-side only

        with open(path, encoding="utf-8") as fh:
            overlay = yaml.safe_load(fh) or {}
        _merge(cfg, overlay)
    return cfg


def _merge(into: dict, overlay: dict) -> None:
    """Put the overlay's values in place, going into nested maps: what it does not name stays."""
    for key, value in overlay.items():
        if isinstance(value, dict) and isinstance(into.get(key), dict):
            _merge(into[key], value)
        elif value is not None:
            into[key] = value


DEFAULT = load_config()
