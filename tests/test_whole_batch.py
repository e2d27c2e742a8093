"""The whole-batch run at scale: what its stage table holds, and searches that a cheaper one may spare."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leadsmith.config import DEFAULT
from leadsmith.functions.common import any_word_regex, contains_any, rlike_any
from leadsmith.functions.helpers import with_helpers
from leadsmith.operators import lifecycle as L
from leadsmith.operators import policies as P
from leadsmith.operators import scoring as S
from leadsmith.operators import screening as W
from leadsmith.sources import fixtures as fx
from leadsmith.sources import sinks as K

SF_SMALL = "/root/testdata/sf0.001"
NOW = "2001-08-02 00:00:00"
AT = dt.datetime(2024, 1, 1)
WORDS = ["Head of", "HEAD", "of", "vp", "VP Engineering", "cto", "Kİ", "CTO's", "urgently", "ASAP", "within 3 Weeks", "budgets", "Pricing",
         "pain  point", "looking for", "demos", "123-45-6789", "4111 1111 1111 1111", "AB1234567", "a@b.co", "+1 (555) 123-4567", "\n", "ß", "x"]


def texts(spark, n=400):
    rnd = random.Random(7)
    rows = [(i, " ".join(rnd.choices(WORDS, k=rnd.randrange(6))) if i % 40 else None) for i in range(n)]
    return spark.createDataFrame([(i, m, m) for i, m in rows], "lead_id int, message string, job_title string")


def staged_columns(spark, monkeypatch, **kw):
    seen = []
    real = L.staged_table

    def stage(df, name):
        seen.append(df.columns)
        return real(df, name)
    monkeypatch.setattr(L, "staged_table", stage)
    out = L.qualify_leads(fx.raw_leads(spark, SF_SMALL), fx.sales_reps(spark, SF_SMALL), as_of=NOW, **kw)
    return out, seen[0]


def test_stage_table_holds_only_what_is_read(spark, monkeypatch):
    whole, every = staged_columns(spark, monkeypatch)
    feed, few = staged_columns(spark, monkeypatch, columns=L.FEED_READS)
    assert {"flags", "message", "linkedin_url"} <= set(every) and not {"flags", "message", "linkedin_url"} & set(few)
    want, got = L.result_feed(whole), L.result_feed(feed)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    run, _ = staged_columns(spark, monkeypatch, columns=K.EVENT_READS)
    want, got = K.events_from_stages(whole, NOW), K.events_from_stages(run, NOW)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_answers_are_hashed_not_sorted(spark):
    rows = [(1, "no", AT + dt.timedelta(seconds=9)), (1, " Yes ", AT), (2, "n", AT), (3, None, AT), (4, "y", None), (5, "", AT)]
    first = W.first_answers(spark.createDataFrame(rows, "lead_id int, answer string, answered_at timestamp_ntz"))
    assert sorted((r[0], r[1]) for r in first.where("answered_at is not null").collect()) == [(1, True), (2, False), (3, True), (5, True)]
    assert "SortAggregate" not in first._jdf.queryExecution().executedPlan().toString()


def test_spared_searches_find_the_same(spark):
    t = with_helpers(texts(spark))
    for phrases in (DEFAULT["scoring"]["bant_decision_titles"], DEFAULT["scoring"]["mql_qualifying_titles"], ["ß", "vp"], ["Head of", "kİ"]):
        spared = rlike_any(F.col("_msg"), F.col("_msg_l"), phrases, True)
        assert t.where(~spared.eqNullSafe(F.col("_msg").rlike(any_word_regex(phrases, True)))).isEmpty()
    for field, typ, _, _, hit in P._pii_hits(["message"], DEFAULT["policies"], None):
        pattern = "(?i)" + next(p for y, p, *_ in DEFAULT["policies"]["pii_patterns"] if y == typ)
        msg = F.coalesce("message", F.lit(""))
        assert t.where(~hit.eqNullSafe(msg.rlike(pattern))).isEmpty()
        assert not t.where(hit).isEmpty()
    for part in ("need", "timeline"):
        assert t.select(S.bant_parts()[part].alias("p")).distinct().count() > 1
    assert spark.range(1).select(contains_any(F.lit("abc"), ["x", "c"])).first()[0]


def test_events_build_their_own_fields_only(spark):
    run = L.qualify_leads(fx.raw_leads(spark, SF_SMALL), fx.sales_reps(spark, SF_SMALL), as_of=NOW, materialize=False)
    ev = K.events_from_stages(run, NOW)
    plan = ev._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_json") <= 4  # one of each kind; arrays of structs read each twice
    assert ev.where("event_type is null or event_details is null or to_status is null").isEmpty()
