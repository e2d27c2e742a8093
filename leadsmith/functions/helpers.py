"""Per-row helper columns shared by many rules.

A rule set reads the same few derived values dozens of times (the lower-cased
message for 20 spam keywords, the size label's lower bound for every tier...).
``with_helpers`` computes each once, in a projection of its own; because the
rules reference every helper more than once, Catalyst keeps that projection
instead of inlining the expression into each use, so it is evaluated once per
row.  Entry points add the helpers and drop them from their output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _s(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _domain() -> Column:
    e = _s("email")
    return F.when(e.contains("@"), F.lower(F.substring_index(e, "@", -1))).otherwise(F.lit(""))


# helper name -> (source column it needs, builder)
HELPERS: dict[str, tuple[str, callable]] = {
    "_msg": ("message", lambda: _s("message")),
    "_msg_l": ("message", lambda: F.lower(_s("message"))),
    "_wc": ("message", lambda: F.regexp_count(_s("message"), F.lit(r"\S+")).cast("int")),
    "_title": ("job_title", lambda: _s("job_title")),
    "_title_l": ("job_title", lambda: F.lower(_s("job_title"))),
    "_dom": ("email", _domain),
    "_emp": ("company_size", lambda: F.regexp_extract(_s("company_size"), r"^(\d+)", 1).try_cast("int")),
    "_fn": ("first_name", lambda: F.lower(F.trim(_s("first_name")))),
    "_ln": ("last_name", lambda: F.lower(F.trim(_s("last_name")))),
}


def with_helpers(df: DataFrame) -> DataFrame:
    cols = set(df.columns)
    add = [b().alias(n) for n, (src, b) in HELPERS.items() if src in cols and n not in cols]
    return df.select("*", *add) if add else df


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[n for n in HELPERS if n in df.columns])


def h(name: str) -> Column:
    return F.col(name)
