"""The duplicate rule against a plain loop over each email's rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leadsmith.operators import duplicates as D
from leadsmith.operators import policies as P

START = dt.datetime(2024, 1, 1)
ALLOW = ("rejected", "nurture")


def brute(rows, days=30):
    out, state = [], {}
    for i, em, t, o, keeps in sorted((r for r in rows if r[1] and r[1].strip() and r[2]), key=lambda r: (r[2], r[0])):
        k = em.strip().lower()
        anchor, at, status = state.get(k, (None, None, None))
        if anchor is None or (status not in ALLOW and t - at >= dt.timedelta(days=days + 1)):
            state[k] = (i, t, o)
            out.append((i, "allow", i, 0))
        elif status in ALLOW:
            state[k] = (anchor, at, status if keeps else o)
            out.append((i, "allow", anchor, (t - at).days))
        else:
            out.append((i, "deny", anchor, (t - at).days))
    alone = [(r[0], "allow", None, None) for r in rows if not (r[1] and r[1].strip() and r[2])]
    return sorted(out + alone)


def made(seed: int, n: int, emails: int, span_days: int, outcomes) -> list:
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        em = "hot@x.example" if rnd.random() < 0.34 else f"P{rnd.randrange(emails)}@x.example "
        t = START + dt.timedelta(seconds=rnd.randrange(span_days * 86400) // 1800 * 1800)  # many equal times
        rows.append((f"L{i:05d}", rnd.choice([em, em, em, em, em, None, " "]) if i % 50 == 0 else em,
                     None if i % 97 == 0 else t, rnd.choice(outcomes), rnd.random() < 0.2))
    return rows


def check(spark, rows):
    leads = spark.createDataFrame(rows, "lead_id string, email string, created_at timestamp_ntz, o string, k boolean")
    got = P.duplicate_lookback(leads, outcome=F.col("o"), keeps_status=F.col("k"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(brute(rows), key=str)


def test_dense_runs_of_years(spark):
    check(spark, made(1, 1500, 30, 900, ["processing", "accepted", "sales_owned"]))


def test_resubmittable_outcomes_and_kept_statuses(spark):
    check(spark, made(2, 1500, 20, 700, ["processing", "rejected", "nurture", None]))
    check(spark, made(3, 800, 10, 500, ["rejected", "rejected", "rejected", "accepted"]))


def test_sparse_rows_and_none(spark):
    check(spark, made(4, 120, 60, 2000, ["processing", "rejected"]))
    check(spark, [])


def test_keys_of_few_rows_are_folded_and_others_split(spark, monkeypatch):
    """A key is folded up to the bound and split by time beyond it, with the same verdicts."""
    folded = D._folded
    seen = []
    monkeypatch.setattr(D, "MOST", 30)
    monkeypatch.setattr(D, "_folded", lambda rows, span: seen.append(rows.groupBy("key").count().agg(F.max("count")).first()[0]) or folded(rows, span))
    check(spark, made(5, 600, 30, 500, ["processing", "rejected", "nurture", "accepted", None]))
    assert 0 < seen[0] <= 30
