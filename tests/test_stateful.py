"""Streams with state across micro-batches, payload masking, policy versions and sketches against plain loops."""

import datetime as dt
import json

from pyspark.sql import functions as F

from leadsmith.operators import payloads as M
from leadsmith.operators import policies as P
from leadsmith.operators import reports as R
from leadsmith.sources import fixtures as fx
from leadsmith.streaming import stateful as Y
from leadsmith.streaming import streams as X
from tests.conftest import SF_SMALL
from tests.test_duplicates import brute, made

START = dt.datetime(2024, 1, 1)


def test_ordered_duplicates_with_outcomes_and_late_rows(spark, tmp_path):
    data = [r for r in made(11, 160, 6, 200, ["processing", "rejected", "accepted"]) if r[2] is not None]
    schema = "lead_id string, email string, created_at timestamp_ntz, o string, k boolean"
    late = [("LATE", "hot@x.example", START - dt.timedelta(days=400), "processing", False)]
    end = [("END", "end@x.example", START + dt.timedelta(days=9000), "processing", False)]
    base = str(tmp_path / "src")
    # within 400 days rows come in any order; the late row comes two batches after the watermark passed it
    for n, rows in enumerate([data[::3], data[1::3] + data[2::3], end, end[:1], late]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/slice={n}")
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(base)
    progress = []
    got = X.run_available_now(Y.stream_duplicates_ordered(src, outcome=F.col("o"), keeps_status=F.col("k"), watermark="400 days"),
                              "ordered-test", conf=Y.ROCKSDB, progress=progress)
    rows = sorted((tuple(r) for r in got.where("lead_id not in ('END', 'LATE')").collect()), key=str)
    assert rows == sorted(brute(data), key=str)
    assert Y.late_rows(progress) == 1 and got.where("lead_id = 'LATE'").isEmpty()


def batches(spark, base, parts, schema, sink):
    for n, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/src/slice={n}")
        Y.drain(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/src"), sink, f"{base}/checkpoint")


def test_windows_are_final_and_late_rows_are_kept(spark, tmp_path):
    base, h = str(tmp_path / "w"), dt.timedelta(hours=1)
    schema = "ts timestamp_ntz, event_type string, value double"
    parts = [[(START, "a", 1.0), (START + h, "a", 2.0), (START + 2 * h, "b", 4.0)], [(START + h / 2, "a", 8.0), (START + 2.5 * h, "b", 16.0), (None, "a", 1.0)],
             [(START + 9 * h, "b", 32.0)], [(START + 2 * h, "b", 64.0)]]
    sink = Y.close_windows(base)
    batches(spark, base, parts, schema, sink)
    read = lambda name: spark.read.parquet(f"{base}/{name}")
    final = {(r.window_start, r.event_type): (r.events, r.value_sum) for r in read("windows").collect()}
    assert len(final) == read("windows").count()  # written once each
    assert final == {(START, "a"): (1, 1.0), (START + h, "a"): (1, 2.0), (START + 2 * h, "b"): (2, 20.0)}
    assert sorted((r.ts is not None, r.value) for r in read("late").collect()) == [(False, 1.0), (True, 8.0), (True, 64.0)]
    left = Y.open_windows(spark, base).collect()
    assert [(r.window_start, r.events) for r in left] == [(START + 9 * h, 1)]
    assert sum(v[0] for v in final.values()) + 3 + 1 == sum(map(len, parts))
    # a batch run again leaves the same
    sink(spark.createDataFrame(parts[3], schema), 3)
    assert read("late").count() == 3 and read("windows").count() == 3


def test_no_rep_goes_past_its_capacity(spark, tmp_path):
    base = str(tmp_path / "a")
    reps = spark.createDataFrame([("R1", "A", "x", "a@x", "smb", True, 8, 10), ("R2", "B", "x", "b@x", "smb", True, 9, 11),
                                  ("R3", "C", "x", "c@x", "ent", True, 0, 2), ("R4", "D", "x", "d@x", "ent", False, 0, 9)],
                                 "rep_id string, first_name string, last_name string, email string, team string, is_active boolean, current_load int, max_load int")
    leads = [(f"L{i}", "smb" if i % 4 else "ent", START + dt.timedelta(hours=i)) for i in range(9)]
    sink = Y.assign_stream(base, reps)
    batches(spark, base, [leads[:2], leads[2:4], leads[4:]], "lead_id string, assigned_team string, created_at timestamp_ntz", sink)
    done = spark.read.parquet(f"{base}/assigned")
    by_lead = {r.lead_id: r.assigned_rep_id for r in done.collect()}
    assert by_lead["L1"] == "R1" and by_lead["L2"] == "R1" and by_lead["L3"] == "R2"  # least loaded, ties by id
    used = {r.assigned_rep_id: r["count"] for r in done.groupBy("assigned_rep_id").count().collect()}
    assert used == {"R1": 2, "R2": 2, "R3": 2, None: 3}
    sink(spark.createDataFrame(leads[4:], "lead_id string, assigned_team string, created_at timestamp_ntz"), 2)  # a retry
    assert spark.read.parquet(f"{base}/assigned").count() == 9 and spark.read.parquet(f"{base}/ledger").agg(F.sum("n")).first()[0] == 6


def test_payload_leaves_are_masked_and_documents_stay_valid(spark):
    docs = {
        "nested": {"a": {"b": ["mail jane@x.example", 1, True, None]}, "n": 4111111111111111, "ok": 12.5},
        "escapes": {"t": "line\n1234567 \"quoted\" \\ 123-45-6789", "é": "ünï"},
        "keys": {"123-45-6789": "x"}, "list": ["AB1234567"], "empty": {}}
    rows = [(k, json.dumps(v)) for k, v in docs.items()] + [("bad", '{"a": 123-45-6789'), ("null", None), ("text", '"jane@x.example"')]
    got = {r.k: r for r in M.mask_payloads(spark.createDataFrame(rows, "k string, raw_payload string")).collect()}
    assert json.loads(got["nested"].raw_payload) == {"a": {"b": ["mail [REDACTED:email]", 1, True, None]}, "n": "[REDACTED:credit_card]", "ok": 12.5}
    assert [(f.path, f.pii_type) for f in got["nested"].pii_found] == [("$.a.b[0]", "email"), ("$.n", "credit_card")]
    assert json.loads(got["escapes"].raw_payload) == {"t": "line\n1234567 \"quoted\" \\ [REDACTED:ssn]", "é": "ünï"}
    assert json.loads(got["keys"].raw_payload) == {"123-45-6789": "x"} and json.loads(got["list"].raw_payload) == ["[REDACTED:passport]"]
    assert got["bad"].raw_payload == '{"a": [REDACTED:ssn]' and not got["bad"].payload_parsed
    assert got["null"].raw_payload is None and json.loads(got["text"].raw_payload) == "[REDACTED:email]" and got["empty"].raw_payload == "{}"


def test_policy_versions(spark):
    day = dt.timedelta(days=1)
    versions = [("p", START, None, True), ("p", START + 3 * day, START + 4 * day, False), ("q", START - day, START + day, True), ("r", START, START, True)]
    log = [(i, p, START + d * day / 2) for i, (p, d) in enumerate((p, d) for p in "pqrs" for d in range(-2, 12))]
    got = P.policies_in_force(spark.createDataFrame(log, "n int, policy_id string, ts timestamp_ntz"),
                              spark.createDataFrame(versions, "policy_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, enabled boolean"))

    def brute_state(p, at):
        own = [v for v in versions if v[0] == p and v[1] <= at and (v[2] is None or at < v[2])]
        return max(own, key=lambda v: v[1])[3] if own else False
    assert {r.n: r.in_force for r in got.collect()} == {n: brute_state(p, at) for n, p, at in log}


def test_sketches_merge_and_keep_their_error_bound(spark):
    events = fx.lead_events(spark, SF_SMALL)
    exact = {(r.prev_type, r.event_type): r for r in R.stage_duration_quantiles(events).collect()}
    s = R.duration_sketches(events)
    for sketches in (s, s.where("day < '1995-06-01'").unionByName(s.where("day >= '1995-06-01'"))):
        got = R.sketch_quantiles(sketches).collect()
        assert len(got) == len(exact)
        for r in got:
            e = exact[r.prev_type, r.event_type]
            for q in ("p50_seconds", "p90_seconds"):
                assert r[q] <= e[q] < r[q] * (1 + 2 ** -R.SKETCH_BITS) + 1
    x = spark.createDataFrame([(n,) for n in [0, 1, 127, 128, 255, 256, 257, 511, 512, 10**6, 2**40 + 5]], "x long")
    for r in x.select("x", R.bucket_floor(R.sketch_bucket(F.col("x"))).alias("low")).collect():
        assert r.low <= r.x < r.low * (1 + 2 ** -R.SKETCH_BITS) + 1
