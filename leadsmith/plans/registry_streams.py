"""Registered streaming checks (X1-X4): each drains a file stream over data derived from the
test tables with an available-now trigger; the oracle is the batch SQL of the same operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import scoring as S
from ..sources import fixtures as fx
from ..streaming import stateful as Y
from ..streaming import streams as X
from .oracle import with_tables
from .registry import AS_OF, register
from .registry_lifecycle import AVAIL_SQL, QUALIFIED_SQL, qualified_leads
from .registry_policies import DUP_SQL
from .registry_rules import BANT_SQL, END, MQL_SQL, SCREEN_SQL


def _lead_stream(s, d, name: str):
    leads = fx.raw_leads(s, d)
    path = X.stage_as_files(leads, X.scratch(s, f"{name}-src") + "/leads")
    return s.readStream.schema(leads.schema).parquet(path)


def _stream_screen(s, d):
    src = _lead_stream(s, d, "screen")
    out = X.stream_screen(src, end_col=END).select("lead_id", "flags", "bot_score", "quality_score",
                                                   "risk_level", "route")
    return X.run_available_now(out, "screen")


register("stream_screen", with_tables(SCREEN_SQL, "raw_leads"))(_stream_screen)


def _stream_score(s, d):
    out = X.stream_score(_lead_stream(s, d, "score"), AS_OF)
    return X.run_available_now(out.select("lead_id", "mql_score", "mql_qualified", "sql_score", "qualified", "estimated_deal_size",
                                          "estimated_close_date", "assigned_team"), "score")


register("stream_score", with_tables(f"""
SELECT m.lead_id, m.total AS mql_score, m.total >= 50 AS mql_qualified, b.sql_score, b.qualified, b.estimated_deal_size,
       b.estimated_close_date, b.assigned_team
FROM (SELECT lead_id, {' + '.join(S.MQL_PARTS)} AS total FROM ({MQL_SQL}) p) m JOIN ({BANT_SQL}) b ON b.lead_id = m.lead_id
""", "raw_leads"))(_stream_score)


def _stream_dups(s, d):
    return X.run_available_now(X.stream_duplicates(_lead_stream(s, d, "dups")), "dups")


register("stream_duplicates", DUP_SQL)(_stream_dups)


def _event_windows(s, d):
    schema = s.read.parquet(f"{d}/events.parquet").schema
    ev = (s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
          .withColumn("ts", F.col("ts").cast("timestamp")))
    return X.run_available_now(X.stream_event_windows(ev), "event-windows", mode="update", keys=["window_start", "window_end", "event_type"])


register("event_windows", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS events, round(sum(value), 2) AS value_sum
FROM events GROUP BY ALL
""")(_event_windows)


def _enrich(s, d):
    sql = fx.sql_leads(s, d).select("sql_id", "lead_id", "assigned_rep_id", "sql_score")
    path = X.stage_as_files(sql, X.scratch(s, "enrich-src") + "/sql")
    src = s.readStream.schema(sql.schema).parquet(path)
    return X.run_available_now(X.stream_enrich(src, fx.sales_reps(s, d)), "enrich")


register("stream_enrich", with_tables("""
SELECT s.assigned_rep_id, s.sql_id, s.lead_id, s.sql_score, r.email AS rep_email, r.team AS rep_team,
       r.current_load AS rep_load
FROM sql_leads s LEFT JOIN sales_reps r ON s.assigned_rep_id = r.rep_id
""", "sql_leads", "sales_reps"))(_enrich)


# ----------------------------------------------------------------- state over several micro-batches

def _dups_ordered(s, d):
    """Leads dealt to three micro-batches by time and, within the watermark of 40 days, out of order; a last row
    without an email state to keep moves the watermark past all others."""
    leads = fx.raw_leads(s, d).select("lead_id", "email", "created_at")
    k, base = F.substring_index("lead_id", "-", -1).cast("long"), X.scratch(s, "dups-ordered")
    # every third lead comes up to a month after the others of its time
    arrives = F.timestamp_add("DAY", F.when(k % 3 == 0, 30).otherwise(0), F.col("created_at"))
    cuts = ["1900-01-01", "1994-06-01", "1997-06-01", "2100-01-01"]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        leads.where((arrives >= lo) & (arrives < hi)).repartition(2).write.parquet(f"{base}/src/slice={n}")
    end = s.createDataFrame([("END", "end@example.com", dt.datetime(2200, 1, 1))], "lead_id string, email string, created_at timestamp_ntz")
    end.coalesce(1).write.parquet(f"{base}/src/slice=9")
    src = (s.readStream.schema(leads.schema).option("maxFilesPerTrigger", 2).option("recursiveFileLookup", "true").parquet(f"{base}/src"))
    out = Y.stream_duplicates_ordered(src, watermark="40 days")
    return X.run_available_now(out, "dups-ordered", conf=Y.ROCKSDB).where("lead_id <> 'END'")


register("stream_duplicates_ordered", DUP_SQL)(_dups_ordered)


def _slices(s, base: str, parts, sink) -> None:
    """Each part is a micro-batch of one stream: it is added to the source, then the stream goes on."""
    for n, part in enumerate(parts):
        part.write.parquet(f"{base}/src/slice={n}")
        src = s.readStream.schema(part.schema).option("recursiveFileLookup", "true").parquet(f"{base}/src")
        Y.drain(src, sink, f"{base}/checkpoint")


def _windows_final(s, d):
    """Final windows, windows still open and late rows of three micro-batches, of which the last brings rows of all times."""
    base = X.scratch(s, "windows-final")
    ev = s.read.parquet(f"{d}/events.parquet").select("event_id", "ts", "event_type", "value")
    early, i = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), F.col("event_id")
    parts = [ev.where((i % 10 != 0) & early), ev.where((i % 10 != 0) & ~early & (i % 7 != 0)), ev.where((i % 10 == 0) | (~early & (i % 7 == 0)))]
    _slices(s, base, parts, Y.close_windows(base))
    done = s.read.schema(Y.WINDOW_SCHEMA.format(by="event_type")).parquet(f"{base}/windows").drop("batch_no")
    late = s.read.schema(ev.schema).parquet(f"{base}/late").groupBy("event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value_sum"))
    none = F.lit(None).cast("timestamp_ntz")
    return (done.withColumn("kind", F.lit("final")).unionByName(Y.open_windows(s, base).withColumn("kind", F.lit("open")))
            .unionByName(late.select(none.alias("window_start"), none.alias("window_end"), "event_type", "events", "value_sum", F.lit("late").alias("kind")))
            .withColumn("value_sum", F.round("value_sum", 2)))


register("event_windows_final", """
WITH e AS (SELECT event_type, value, ts, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS we,
             CASE WHEN event_id % 10 = 0 OR (ts >= TIMESTAMP '2024-01-16' AND event_id % 7 = 0) THEN 2
                  WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS b FROM events),
m AS (SELECT max(ts) FILTER (b = 0) - INTERVAL 10 MINUTE AS m0, max(ts) FILTER (b <= 1) - INTERVAL 10 MINUTE AS m1,
             max(ts) - INTERVAL 10 MINUTE AS m2 FROM e),
k AS (SELECT e.*, CASE WHEN (b = 1 AND we <= m0) OR (b = 2 AND we <= m1) THEN 'late' WHEN we <= m2 THEN 'final' ELSE 'open' END AS kind FROM e, m)
SELECT CASE WHEN kind <> 'late' THEN we - INTERVAL 1 HOUR END AS window_start, CASE WHEN kind <> 'late' THEN we END AS window_end,
       event_type, count(*) AS events, round(sum(value), 2) AS value_sum, kind
FROM k GROUP BY 1, 2, 3, 6
""")(_windows_final)

#: Capture times that part the micro-batches of the query below.
_ARRIVALS = ("1994-01-01", "1996-01-01")


def _assigned(s, d):
    base, leads = X.scratch(s, "stream-assign"), qualified_leads(s, d).join(fx.raw_leads(s, d).select("lead_id", "created_at"), "lead_id")
    at, (a, b) = F.col("created_at"), _ARRIVALS
    _slices(s, base, [leads.where(at < a), leads.where((at >= a) & (at < b)), leads.where(at >= b)], Y.assign_stream(base, fx.sales_reps(s, d)))
    return s.read.parquet(f"{base}/assigned").select("lead_id", "assigned_team", "assigned_rep_id", "assignment_reason", F.col("batch_no").cast("long").alias("batch_no"))


def _assign_steps() -> str:
    """The balanced rule once per micro-batch, each with the loads that the batches before it left."""
    steps, reps = [], "sales_reps"
    for n in range(3):
        steps.append(f"""
av{n} AS ({AVAIL_SQL.replace("sales_reps", reps)}),
q{n} AS (SELECT * FROM leads WHERE b = {n}),
rk{n} AS (SELECT lead_id, assigned_team, row_number() OVER (PARTITION BY assigned_team ORDER BY created_at, lead_id) AS n FROM q{n}),
sl{n} AS (SELECT *, row_number() OVER (PARTITION BY team ORDER BY slot_load, rep_id) AS n
          FROM (SELECT rep_id, team, unnest(range(current_load, max_load)) AS slot_load FROM av{n}) x),
lo{n} AS (SELECT r.*, r.n > coalesce(f.free, 0) AS beyond FROM rk{n} r LEFT JOIN (SELECT team, count(*) AS free FROM sl{n} GROUP BY team) f ON f.team = r.assigned_team),
ln{n} AS (SELECT *, CASE WHEN beyond THEN row_number() OVER (PARTITION BY beyond ORDER BY assigned_team NULLS FIRST, n) ELSE n END AS place FROM lo{n}),
so{n} AS (SELECT s.*, s.n > coalesce(w.wanted, 0) AS beyond FROM sl{n} s LEFT JOIN (SELECT assigned_team, count(*) AS wanted FROM q{n} GROUP BY assigned_team) w ON w.assigned_team = s.team),
sn{n} AS (SELECT *, CASE WHEN beyond THEN row_number() OVER (PARTITION BY beyond ORDER BY slot_load, rep_id) ELSE n END AS place FROM so{n}),
out{n} AS (SELECT l.lead_id, l.assigned_team, s.rep_id AS assigned_rep_id,
             CASE WHEN s.rep_id IS NULL THEN 'no_capacity' WHEN l.beyond THEN 'overflow_other_team' ELSE 'balanced' END AS assignment_reason, {n}::BIGINT AS batch_no
           FROM ln{n} l LEFT JOIN sn{n} s ON s.beyond = l.beyond AND s.place = l.place AND (l.beyond OR s.team = l.assigned_team)),
reps{n} AS (SELECT r.* REPLACE (r.current_load + coalesce(u.n, 0) AS current_load) FROM {reps} r
            LEFT JOIN (SELECT assigned_rep_id, count(*) AS n FROM out{n} GROUP BY assigned_rep_id) u ON u.assigned_rep_id = r.rep_id)""")
        reps = f"reps{n}"
    return ",".join(steps)


register("stream_assign", with_tables(f"""
WITH leads AS (SELECT q.*, r.created_at, CASE WHEN r.created_at < TIMESTAMP '{_ARRIVALS[0]}' THEN 0
                 WHEN r.created_at < TIMESTAMP '{_ARRIVALS[1]}' THEN 1 ELSE 2 END AS b
               FROM ({QUALIFIED_SQL}) q JOIN raw_leads r ON r.lead_id = q.lead_id),
{_assign_steps()}
SELECT * FROM out0 UNION ALL SELECT * FROM out1 UNION ALL SELECT * FROM out2
""", "raw_leads", "sales_reps"))(_assigned)
