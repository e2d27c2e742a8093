"""Stores brought up to date in place: untouched files stay, a retry leaves the same rows, batches equal one run."""

import datetime as dt
import random

from pyspark.sql import functions as F

from leadsmith.operators import increments as N
from leadsmith.operators import lifecycle as L
from leadsmith.operators import policies as P
from leadsmith.operators import reports as R
from leadsmith.sources import fixtures as fx
from leadsmith.sources import stores as T
from tests.conftest import SF_SMALL
from tests.test_duplicates import brute, made


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_update_rewrites_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "leads")
    days = [dt.datetime(2024, 1, d, 9) for d in range(1, 11)]
    data = [(f"LD-202401{t.day:02d}-{i:04d}", t, "new", None, t) for i in range(20) for t in days] + [("X", None, "new", None, None)]
    leads = spark.createDataFrame(data, "lead_id string, created_at timestamp_ntz, status string, rejection_reason string, updated_at timestamp_ntz")
    T.write_store(leads, path)
    before = files(T.read_store(spark, path))
    at = dt.datetime(2024, 2, 1)
    updates = spark.createDataFrame([("LD-20240103-0001", "rejected", "spam", at), ("LD-20240103-0001", "mql", None, at + dt.timedelta(1)),
                                     ("LD-20240107-0005", "accepted", None, at), ("LD-20240109-9999", "accepted", None, at)],
                                    "lead_id string, status string, rejection_reason string, updated_at timestamp_ntz")
    want = rows(L.apply_status_updates(leads, updates))
    for _ in range(2):  # a retry leaves the same rows
        assert sorted(T.merge_status_updates(spark, path, updates)) == [dt.date(2024, 1, 3), dt.date(2024, 1, 7)]
        assert rows(T.read_store(spark, path).drop(T.PART)) == want
    after = files(T.read_store(spark, path))
    changed = {f.split("part=")[1][:10] for f in before ^ after}
    assert changed == {"2024-01-03", "2024-01-07"}
    # ids without a day: all partitions are looked through, the null one is rewritten
    strange = updates.limit(1).withColumn("lead_id", F.lit("X"))
    assert T.merge_status_updates(spark, path, strange) == [None]
    assert T.read_store(spark, path).where("lead_id = 'X'").first().status == "rejected"
    assert T.read_store(spark, path).count() == leads.count()
    assert T.merge_status_updates(spark, path, updates.where("false")) == []


def test_summary_refresh_touches_the_changed_months(spark, tmp_path):
    path, leads, t = str(tmp_path / "summary"), fx.raw_leads(spark, SF_SMALL), fx.load_tables(spark, SF_SMALL)
    T.refresh_summary(spark, path, leads, t["mql_leads"], t["sql_leads"], as_of="2001-08-02")
    whole = rows(R.analytics_summary(leads, t["mql_leads"], t["sql_leads"], "2001-08-02").select(*sorted(T.read_summary(spark, path).columns)))
    assert rows(T.read_summary(spark, path).select(*sorted(T.read_summary(spark, path).columns))) == whole
    before = files(T.read_summary(spark, path))
    # a Sunday whose week starts in the month before
    day = leads.where("dayofmonth(created_at) = 1 and weekday(created_at) = 6").select(F.to_date("created_at").alias("d")).orderBy("d").first().d
    month, other = day.isoformat(), (day - dt.timedelta(1)).replace(day=1).isoformat()
    changed = leads.withColumn("status", F.when(F.to_date("created_at") == F.lit(day), "mql").otherwise(F.col("status")))
    changed = changed.withColumn("updated_at", F.when(F.to_date("created_at") == F.lit(day), F.lit("2001-08-02").cast("timestamp_ntz")).otherwise(F.col("updated_at")))
    days = T.changed_days(changed, dt.datetime(2001, 8, 1, 23))
    assert days == [day]
    for _ in range(2):
        T.refresh_summary(spark, path, changed, t["mql_leads"], t["sql_leads"], [day], "2001-08-02")
        got = T.read_summary(spark, path)
        want = R.analytics_summary(changed, t["mql_leads"], t["sql_leads"], "2001-08-02")
        assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(got.columns)))
    parts = {f.rsplit("/summary/", 1)[1].rsplit("/", 1)[0] for f in before ^ files(T.read_summary(spark, path))}
    assert parts == {f"report_period=daily/report_month={month}", f"report_period=weekly/report_month={other}", f"report_period=monthly/report_month={month}"}


def test_snapshot_digests(spark, tmp_path):
    schema = "lead_id string, a string, b string, n long"
    old = [(f"L{i}", "x", None, i) for i in range(500)] + [(None, "x", "y", 1)]
    new = [(k, a, b, n) if i % 50 else (k, None, a, n) for i, (k, a, b, n) in enumerate(old) if i != 77] + [("new", "x", None, 1)]
    o, n = str(tmp_path / "o"), str(tmp_path / "n")
    a, b = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    T.write_snapshot(a, o, buckets=8, subs=16)
    T.write_snapshot(b, n, buckets=8, subs=16)
    got = rows(T.diff_snapshots(spark, o, n))
    plain = rows(L.snapshot_diff(a.where("lead_id is not null"), b.where("lead_id is not null")))
    assert [r for r in got if r[0]] == plain and len(plain) == 12
    assert T.diff_snapshots(spark, o, o).count() == 0
    changed = T.differing(spark.read.parquet(f"{o}/digests"), spark.read.parquet(f"{n}/digests"), ["_bucket", "_sub"]).count()
    assert changed <= 14  # rows of other parts are not compared
    empty = str(tmp_path / "e")
    T.write_snapshot(a.where("false"), empty, buckets=8, subs=16)
    assert T.diff_snapshots(spark, empty, empty).count() == 0


def run_batches(spark, store, batches, retry=False):
    out = {}
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, "lead_id string, email string, created_at timestamp_ntz, o string, k boolean")
        for _ in range(2 if retry else 1):
            got = N.duplicate_increment(spark, store, df, n, outcome=F.col("o"), keeps_status=F.col("k"), buckets=4).collect()
        assert not {r.lead_id for r in got if not r.replayed} ^ {r[0] for r in batch}
        out.update({r.lead_id: tuple(r)[:4] for r in got})
    return sorted(out.values(), key=str)


def test_batches_equal_one_run(spark, tmp_path):
    data = made(7, 500, 12, 700, ["processing", "rejected", "nurture", "accepted", None])
    want = sorted(brute(data), key=str)
    by_time = sorted(data, key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
    cuts = [0, 180, 181, 390, 500]
    assert run_batches(spark, str(tmp_path / "a"), [by_time[i:j] for i, j in zip(cuts, cuts[1:])], retry=True) == want
    random.Random(1).shuffle(data)  # late rows: emails with one are replayed
    assert run_batches(spark, str(tmp_path / "b"), [data[:200], data[200:260], [], data[260:]]) == want


def test_state_holds_one_row_an_email(spark, tmp_path):
    store = str(tmp_path / "s")
    data = sorted(made(9, 200, 5, 900, ["processing"]), key=lambda r: (r[2] is not None, r[2] or 0))
    run_batches(spark, store, [data[:100], data[100:]])
    state = spark.read.schema(N.STATE_SCHEMA).parquet(f"{store}/state")
    emails = {r[1].strip().lower() for r in data if r[1] and r[1].strip() and r[2]}
    assert state.count() == len(emails) == state.select("key").distinct().count()
    assert P.duplicate_lookback(spark.createDataFrame(data, "lead_id string, email string, created_at timestamp_ntz, o string, k boolean")).count() == 200
