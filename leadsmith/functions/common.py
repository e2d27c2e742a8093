"""Small Column helpers shared by the operators (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = str | Column | None


def ts(as_of: AsOf) -> Column:
    """``as_of`` as a timestamp Column; ``None`` means the wall clock.

    A literal is a zone-less timestamp (like the tables' event times), so results
    carry the same wall-clock value whatever the reader's time zone."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz")


def spread(df):
    """Give a small input one partition per core.

    A table stored as one row group would otherwise be processed (scan, joins against
    broadcast dimensions, rule projections) by one task, however many splits its file is cut into.  An input
    counts as small up to ``spark.sql.files.maxPartitionBytes``, what one split of a large table holds;
    a larger one is never shuffled here.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(spark.sparkContext.defaultParallelism) if size <= most else df


def days_before(as_of: AsOf, days: int) -> Column:
    return F.timestamp_add("DAY", F.lit(-int(days)), ts(as_of))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed hours (``DATEDIFF(HOUR, start, end)``)."""
    return F.timestamp_diff("HOUR", _c(start), _c(end))


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def compact(items: list[Column], elem_type: str = "string") -> Column:
    """Array of the non-null ``items`` in order, built without a lambda.

    ``filter(array(...), x -> x is not null)`` is a higher-order function and is
    evaluated interpretively together with every expression under it; this
    form (``flatten`` of one- or zero-element arrays) stays in generated code.
    """
    if not items:
        return F.array().cast(f"array<{elem_type}>")
    # slice(array(c), 1, 0) is the empty array of c's own type
    return F.flatten(F.array(*[F.when(c.isNotNull(), F.array(c)).otherwise(F.slice(F.array(c), 1, 0))
                               for c in items]))


def blank(x: Column | str) -> Column:
    """True when the value is null or the empty string (Python falsiness of a str)."""
    c = _c(x)
    return c.isNull() | (c == "")


def round_ratio(num: Column, den: Column, digits: int, mode: str = "half_up",
                scale: int = 1) -> Column:
    """Exact ``round(num * scale / den, digits)`` for integer ``num``/``den``.

    Integer arithmetic decides the rounding, so the value does not depend on how
    an engine sums or divides doubles: ``half_up`` matches SQL ``ROUND`` on
    exact decimals, ``half_even`` matches Python ``round``.  Null when
    ``den = 0``.  Sign is handled by rounding the magnitude.
    """
    num = num.cast("long")
    den = den.cast("long")
    a = F.abs(num) * (scale * 10 ** digits)
    d = F.abs(den)
    q = F.floor(a / d).cast("long")
    r = a - q * d
    if mode == "half_up":
        up = (r * 2 >= d).cast("long")
    elif mode == "half_even":
        up = F.when(r * 2 > d, 1).when(r * 2 == d, q % 2).otherwise(0).cast("long")
    else:
        raise ValueError(mode)
    sign = F.when((num < 0) != (den < 0), -1.0).otherwise(1.0)
    return F.when(den != 0, sign * (q + up) / float(10 ** digits))


def sql_round_ratio(num: str, den: str, digits: int, mode: str = "half_up", scale: int = 1) -> str:
    """DuckDB text of :func:`round_ratio` (used by the oracle)."""
    a = f"(abs(CAST({num} AS BIGINT)) * {scale * 10 ** digits})"
    d = f"abs(CAST({den} AS BIGINT))"
    q = f"CAST(floor({a} / {d}) AS BIGINT)"
    r = f"({a} - {q} * {d})"
    if mode == "half_up":
        up = f"(CASE WHEN {r} * 2 >= {d} THEN 1 ELSE 0 END)"
    else:
        up = f"(CASE WHEN {r} * 2 > {d} THEN 1 WHEN {r} * 2 = {d} THEN {q} % 2 ELSE 0 END)"
    sign = f"(CASE WHEN (CAST({num} AS BIGINT) < 0) <> (CAST({den} AS BIGINT) < 0) THEN -1.0 ELSE 1.0 END)"
    return (f"(CASE WHEN CAST({den} AS BIGINT) <> 0 THEN CAST({sign} * ({q} + {up}) AS DOUBLE) "
            f"/ {float(10 ** digits)} END)")


def word_regex(phrase: str, plural: bool = False) -> str:
    """Case-insensitive whole-word pattern; words of a phrase in order, gaps allowed.

    Uses only ``\\b``, ``.*`` and escaped literals, so Java regex and RE2 agree.
    """
    import re

    words = [re.escape(w.lower()) for w in phrase.split()]
    body = r"\b.*\b".join(words)
    tail = "(s)?" if plural else ""
    return rf"(?i)\b{body}{tail}\b"


def keyword_alternation(keywords: list[str]) -> str:
    """Lower-case pattern whose group 1 is the keyword found: whole words, the words
    of a phrase adjacent, optional plural ``s``.  Run on lower-cased text."""
    import re

    alts = [r"\s+".join(re.escape(w.lower()) for w in k.split()) for k in keywords]
    return r"\b(" + "|".join(alts) + r")s?\b"


def any_word_regex(phrases: list[str], plural: bool = False) -> str:
    import re

    alts = []
    for p in phrases:
        words = [re.escape(w.lower()) for w in p.split()]
        alts.append(r"\b.*\b".join(words) + ("(s)?" if plural else ""))
    return r"(?i)\b(" + "|".join(alts) + r")\b"


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether one of ``words`` (not none) occurs in the text: plain searches, much cheaper than a pattern."""
    out = None
    for w in dict.fromkeys(words):
        hit = text.contains(w)
        out = hit if out is None else out | hit
    return out


def rlike_any(text: Column, text_lower: Column, phrases: list[str], plural: bool = False) -> Column:
    """``text.rlike(any_word_regex(phrases))``, tried only on texts that hold the first word of a phrase.

    The pattern folds ASCII letters alone, and lower-casing folds them too; with other letters it is always tried."""
    hit = text.rlike(any_word_regex(phrases, plural))
    first = [p.split()[0].lower() for p in phrases if p.split()]
    if len(first) < len(phrases) or not all(w.isascii() for w in first):
        return hit
    return contains_any(text_lower, first) & hit
