"""Registered queries of stored tables that are brought up to date in place."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import increments as N
from ..operators import lifecycle as L
from ..operators import reports as R
from ..session import staged
from ..sources import fixtures as fx
from ..sources import sinks as K
from ..sources import stores as T
from ..streaming.streams import scratch
from .oracle import with_tables
from .registry import AS_OF, _PREV_SQL, _summary_sql, register
from .registry_lifecycle import QUALIFY_COLS, QUALIFY_SQL
from .registry_policies import DUP_SQL, approvals
from .registry_rules import END, review_answers
from .registry_sources import LATEST_SQL, UPDATES_SQL, _K, _k, status_updates

#: Months whose leads get an update in the queries below.
_MONTHS = "month(created_at) % 4 = 1"


def _month_of_id():
    return F.month(T.day_in_id(F.col("lead_id"))) % 4 == 1


def _upsert(s, d):
    """Store, update some months, read back; ``file_kept``: the row lies in the file it was written to first."""
    path = scratch(s, "lead-store")
    leads = fx.raw_leads(s, d).select("lead_id", "created_at", "status", "rejection_reason", "updated_at")
    T.write_store(leads, path, grain="month")
    file = F.input_file_name().alias("file")
    before = staged(T.read_store(s, path).select("lead_id", file), "lead-store-before")
    T.merge_status_updates(s, path, status_updates(s, d).where(_month_of_id()), grain="month")
    after = T.read_store(s, path).select("lead_id", "status", "rejection_reason", "updated_at", file)
    return (after.join(before.withColumnRenamed("file", "_old"), "lead_id")
            .select("lead_id", "status", "rejection_reason", "updated_at", (F.col("file") == F.col("_old")).alias("file_kept")))


UPDATED_SQL = f"""
SELECT r.* REPLACE (CASE WHEN {_MONTHS} THEN u.status ELSE r.status END AS status,
  CASE WHEN {_MONTHS} THEN coalesce(u.reason, r.rejection_reason) ELSE r.rejection_reason END AS rejection_reason,
  CASE WHEN {_MONTHS} THEN u.updated_at ELSE r.updated_at END AS updated_at)
FROM raw_leads r LEFT JOIN ({LATEST_SQL}) u ON r.lead_id = u.lead_id
"""
register("status_upsert", with_tables(f"""
SELECT lead_id, status, rejection_reason, updated_at, NOT ({_MONTHS}) AS file_kept FROM ({UPDATED_SQL}) x
""", "raw_leads"))(_upsert)


def _refresh(s, d):
    """The stored summary after a change of some months' leads, of which alone the days are refreshed."""
    path = scratch(s, "summary-store")
    leads, t = fx.raw_leads(s, d), fx.load_tables(s, d)
    T.refresh_summary(s, path, leads, t["mql_leads"], t["sql_leads"], as_of=AS_OF)
    now = L.apply_status_updates(leads, status_updates(s, d).where(_month_of_id()))
    changed = [r[0] for r in now.where("updated_at <> created_at").select(F.to_date("created_at")).distinct().collect()]
    T.refresh_summary(s, path, now, t["mql_leads"], t["sql_leads"], changed, AS_OF)
    return T.read_summary(s, path)


register("summary_refresh", _summary_sql("upd", f"WITH upd AS ({UPDATED_SQL})"))(_refresh)


def _snapshots(s, d):
    leads = fx.raw_leads(s, d).select("lead_id", "status", "rejection_reason", "updated_at", "email")
    k = _k()
    old, new = scratch(s, "snapshot"), scratch(s, "snapshot")
    T.write_snapshot(leads.where(k % 307 != 0), old, buckets=32, subs=64)
    changed = L.apply_status_updates(leads, status_updates(s, d).where(k % 101 == 0)).where(k % 503 != 0)
    T.write_snapshot(changed, new, buckets=32, subs=64)
    return T.diff_snapshots(s, old, new)


register("snapshot_diff_digests", with_tables(f"""
SELECT lead_id, CASE WHEN {_K} % 503 = 0 THEN 'delete' WHEN {_K} % 307 = 0 THEN 'insert' ELSE 'update' END AS change
FROM raw_leads WHERE ({_K} % 307 = 0) <> ({_K} % 503 = 0)
   OR ({_K} % 307 <> 0 AND {_K} % 503 <> 0 AND lead_id IN (SELECT lead_id FROM ({UPDATES_SQL}) u WHERE {_K} % 101 = 0))
""", "raw_leads"))(_snapshots)


# ----------------------------------------------------------------- P9, F1 batch by batch

def _duplicate_increment(s, d):
    """Three batches dealt out by the lead, so that later ones bring late rows; the newest verdict of each lead."""
    store, leads, out = scratch(s, "duplicate-store"), fx.raw_leads(s, d), None
    for n in range(3):
        part = staged(N.duplicate_increment(s, store, leads.where(_k() % 3 == n), n).withColumn("n", F.lit(n)), "duplicate-batch")
        out = part if out is None else out.unionByName(part)
    newest = F.max_by(F.struct("dup_action", "anchor_id", "days_since_anchor"), "n").alias("v")
    return out.groupBy("lead_id").agg(newest).select("lead_id", "v.*")


register("duplicate_increment", DUP_SQL)(_duplicate_increment)

#: Capture times at which the batches of the query below are parted.
_CUTS = ("1994-01-01", "1997-07-01")


def _qualify_increment(s, d):
    store, leads, reps, out = scratch(s, "qualify-store"), fx.raw_leads(s, d), fx.sales_reps(s, d), None
    answers, approved, at = review_answers(s, d), approvals(s, d), F.col("created_at")
    for n, (lo, hi) in enumerate(zip((None, *_CUTS), (*_CUTS, None))):
        batch = leads.where((at >= lo if lo else F.lit(True)) & (at < hi if hi else F.lit(True)))
        result, _ = N.qualify_increment(s, store, batch, n, reps, answers, approved, AS_OF, END)
        part = staged(result.select(*QUALIFY_COLS), "qualify-batch")
        out = part if out is None else out.unionByName(part)
    return out


register("qualify_increment", QUALIFY_SQL)(_qualify_increment)


# ----------------------------------------------------------------- A20 from sketches

def _duration_sketch(s, d):
    """Sketches written in two goes, by month of the event, and rolled up without the log."""
    path = scratch(s, "duration-sketch")
    sketches = R.duration_sketches(fx.lead_events(s, d)).withColumn("month", F.trunc("day", "month"))
    late = F.col("month") >= "1996-01-01"
    for part in (sketches.where(~late), sketches.where(late)):
        K.write_partitioned(part.repartition("month"), path, ["month"])
    return R.sketch_quantiles(s.read.parquet(path))


_SHIFT = f"greatest(0, length(bin(seconds)) - {R.SKETCH_BITS + 1})"
register("stage_duration_sketch", with_tables(f"""
SELECT prev_type, event_type, count(*) AS transitions, CAST(min(low) FILTER (WHERE upto * 2 >= total) AS BIGINT) AS p50_seconds,
       CAST(min(low) FILTER (WHERE upto * 10 >= total * 9) AS BIGINT) AS p90_seconds
FROM (SELECT prev_type, event_type, (seconds >> {_SHIFT}) << {_SHIFT} AS low,
             row_number() OVER (PARTITION BY prev_type, event_type ORDER BY seconds) AS upto,
             count(*) OVER (PARTITION BY prev_type, event_type) AS total
      FROM ({_PREV_SQL}) x WHERE prev_type IS NOT NULL) y
GROUP BY prev_type, event_type
""", "lead_events"))(_duration_sketch)
