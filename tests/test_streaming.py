"""Streaming forms equal their batch forms, including state carried across micro-batches."""

import datetime as dt

from pyspark.sql import functions as F

from leadsmith.config import load_config
from leadsmith.operators import policies as P
from leadsmith.sources import fixtures as fx
from leadsmith.streaming import stateful as Y
from leadsmith.streaming import streams as X
from tests.conftest import SF_SMALL


def test_stream_duplicates_across_batches(spark, tmp_path):
    leads = fx.raw_leads(spark, SF_SMALL).select("lead_id", "email", "created_at")
    bounds = ["1990-01-01", "1996-06-01", "1998-01-01", "1999-09-01", "2030-01-01"]
    src = str(tmp_path / "leads")
    for lo, hi in zip(bounds, bounds[1:]):  # one file per time slice, written in time order
        (leads.filter((F.col("created_at") >= lo) & (F.col("created_at") < hi))
         .coalesce(1).write.mode("append").parquet(src))
    stream = spark.readStream.schema(leads.schema).option("maxFilesPerTrigger", 1).parquet(src)
    got = X.run_available_now(X.stream_duplicates(stream), "dups-test")
    want = P.duplicate_lookback(leads)
    assert got.count() == leads.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_emails_that_share_a_group_keep_their_own_anchors(spark, tmp_path):
    """One group of state for all emails gives each its own verdicts, in both forms."""
    leads = fx.raw_leads(spark, SF_SMALL).select("lead_id", "email", "created_at")
    end = spark.createDataFrame([("END", "end@x.example", dt.datetime(2200, 1, 1))], leads.schema)
    base = str(tmp_path / "src")
    for n, part in enumerate((leads.where("created_at < '1996-01-01'"), leads.where("created_at >= '1996-01-01'"), end)):
        part.coalesce(1).write.parquet(f"{base}/slice={n}")
    src = spark.readStream.schema(leads.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(base)
    want = sorted(P.duplicate_lookback(leads).collect(), key=str)
    for stream, conf in ((X.stream_duplicates(src, groups=1), {}), (Y.stream_duplicates_ordered(src, groups=1), Y.ROCKSDB)):
        got = X.run_available_now(stream, "group-test", conf=conf).where("lead_id <> 'END'")
        assert sorted(got.collect(), key=str) == want


def test_yaml_overlay(tmp_path):
    p = tmp_path / "rules.yaml"
    p.write_text("scoring:\n  mql_threshold: 60\npolicies:\n  lookback_days: 14\n")
    cfg = load_config(str(p))
    assert cfg["scoring"]["mql_threshold"] == 60 and cfg["policies"]["lookback_days"] == 14
    assert cfg["scoring"]["bant_threshold"] == 70  # untouched defaults stay
