"""Skew-safe forms equal their plain counterparts, with one key holding a third of the rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from leadsmith.functions.windows import bucketed_lag, bucketed_row_number
from leadsmith.operators import policies as P
from leadsmith.plans import catalog
from leadsmith.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _events(spark):
    # 3,000 rows; key 'hot' has a third of them, spread over many hours
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string")))
        .alias("key"),
        F.col("id").alias("eid"),
        F.timestamp_add("MINUTE", ((F.col("id") * 7919) % 20000).cast("int"),
                        F.lit("2025-01-01 00:00:00").cast("timestamp")).alias("ts"),
        (F.col("id") % 5).cast("string").alias("v"))


def test_bucketed_row_number(spark):
    df = _events(spark)
    got = bucketed_row_number(df, ["key"], ["ts", "eid"], F.date_trunc("hour", "ts"), out="rn")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("key").orderBy("ts", "eid")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_bucketed_lag(spark):
    df = _events(spark)
    got = bucketed_lag(df, ["key"], ["ts", "eid"], F.date_trunc("hour", "ts"), ["v", "ts"])
    w = Window.partitionBy("key").orderBy("ts", "eid")
    want = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lag("ts").over(w).alias("prev_ts"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_running_total(spark):
    df = _events(spark).withColumn("amt", F.col("eid") % 11)
    got = P.running_total(df, "key", ["ts", "eid"], "amt", F.date_trunc("hour", "ts"))
    w = Window.partitionBy("key").orderBy("ts", "eid").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("_running", F.sum("amt").over(w))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_null_keys_keep_their_rows(spark):
    df = _events(spark).withColumn("key", F.when(F.col("eid") % 5 != 0, F.col("key"))).withColumn("amt", F.col("eid") % 11)
    w = Window.partitionBy("key").orderBy("ts", "eid")
    got = P.running_total(df, "key", ["ts", "eid"], "amt", F.date_trunc("hour", "ts"))
    want = df.withColumn("_running", F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert got.count() == df.count() and got.exceptAll(want).count() == 0
    got = bucketed_row_number(df, ["key"], ["ts", "eid"], F.date_trunc("hour", "ts"))
    want = df.withColumn("_rn", F.row_number().over(w))
    assert got.count() == df.count() and got.exceptAll(want).count() == 0
    got = bucketed_lag(df, ["key"], ["ts", "eid"], F.date_trunc("hour", "ts"), ["v"])
    assert got.count() == df.count() and got.exceptAll(df.withColumn("prev_v", F.lag("v").over(w))).count() == 0


def test_hot_email_third_of_rows(spark):
    """One email submits a third of all leads: verdicts equal the plain anchored rule."""
    leads = fx.raw_leads(spark, SF_SMALL)
    k = F.substring(F.col("lead_id"), -8, 8).cast("long")
    hot = leads.withColumn("email", F.when(k % 3 == 0, F.lit("bot@spam.example")).otherwise(F.col("email")))
    b = P.duplicate_lookback(hot)
    # brute force for the hot key: anchors at least 31 days apart, everything else denied
    rows = sorted((r.created_at, r.lead_id) for r in hot.filter(F.col("email") == "bot@spam.example").collect())
    import datetime as dt

    anchor, want = None, {}
    for t, i in rows:
        if anchor is None or t - anchor >= dt.timedelta(days=31):
            anchor, want[i] = t, "allow"
        else:
            want[i] = "deny"
    got = {r.lead_id: r.dup_action for r in b.join(hot.filter(F.col("email") == "bot@spam.example")
                                                   .select("lead_id"), "lead_id").collect()}
    assert got == want
