"""Qualification batch by batch from a persisted duplicate state.

A run over a new batch needs of the past, per email, one anchor: its id and time, whether its
status lets the next submission pass, and the time of the last row seen.  The anchor is put before the
batch's rows as if it were the key's first row; the rule then goes on as over the whole history.

State lives in a folder:

* ``state/bucket=b``: one row per email, current and previous state and the number of the batch that
  set it.  A batch replaces the buckets that hold its emails.  Run again, the batch starts
  from the previous state, so a retry leaves the same rows.
* ``rows/bucket=b/batch_no=n``: the rows (email, id, time, two flags) of every batch.  They are read only
  for emails with a late row, one not after the last row seen: those are replayed whole, and
  their earlier rows come out again with the verdict they have now.

Batches are numbered upwards and run one after another.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import AsOf
from ..session import staged
from ..sources.files import exists
from . import lifecycle as L
from . import policies as P
from .duplicates import DAY, anchored

#: Buckets of the state by hash of the email; a bucket is the least that a batch replaces.
BUCKETS = 64
STATE = "struct<anchor_id: string, anchor_t: bigint, open: boolean, last_t: bigint>"
STATE_SCHEMA = f"key string, batch_no long, now {STATE}, before {STATE}, bucket int"
ROWS_SCHEMA = "key string, id string, t long, resubmits boolean, shuts boolean, bucket int, batch_no long"
NEW, EARLIER, SEED = 0, 1, 2


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _put(df: DataFrame, path: str, *by: str) -> None:
    (df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    df.sparkSession.catalog.refreshByPath(path)


def duplicate_increment(spark: SparkSession, store: str, batch: DataFrame, batch_no: int, key: str = "email", ts_col: str = "created_at",
                        id_col: str = "lead_id", days: int | None = None, outcome: Column | None = None,
                        keeps_status: Column | None = None, cfg: dict | None = None, buckets: int = BUCKETS) -> DataFrame:
    """P9 for the rows of one batch, given the batches before it in ``store``; brings the store up to date.

    Columns of ``duplicate_lookback`` and ``replayed``: false for the batch's own rows, true for earlier rows of
    emails with a late row, whose verdict this one replaces.  In-order batches replay nothing."""
    p = (cfg or DEFAULT["policies"])
    span = ((days if days is not None else p["lookback_days"]) + 1) * DAY
    keyed, alone = P.lookback_rows(batch, key, ts_col, id_col, outcome, keeps_status, p)
    passed = alone.select(F.col("id").alias(id_col), F.lit("allow").alias("dup_action"), F.lit(None).cast("string").alias("anchor_id"),
                          F.lit(None).cast("long").alias("days_since_anchor"), F.lit(False).alias("replayed"))
    if not P.enabled("duplicate_detection", p):
        return passed
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket")
    own = staged(keyed.select("key", F.col("id").cast("string").alias("id"), "t", "resubmits", "shuts", bucket), "increment-rows")
    touched = [r[0] for r in own.select("bucket").distinct().collect()]
    if not touched:
        return passed
    here = F.col("bucket").isin(touched)
    stored = _read(spark, f"{store}/state", STATE_SCHEMA).where(here)
    was = F.when(F.col("batch_no") >= batch_no, F.col("before")).otherwise(F.col("now")).alias("was")
    keys = own.groupBy("key").agg(F.min("t").alias("first_t"))
    state = staged(stored.select("key", "batch_no", was).join(keys, "key").where("was is not null")
                   .withColumn("late", F.col("first_t") <= F.col("was.last_t")), "increment-state")
    seeds = state.where("not late").select("key", F.col("was.anchor_id").alias("id"), F.col("was.anchor_t").alias("t"),
                                           F.col("was.open").alias("resubmits"), (~F.col("was.open")).alias("shuts"))
    rows = own.select(*seeds.columns, F.lit(NEW).alias("origin")).unionByName(seeds.withColumn("origin", F.lit(SEED)))
    late = state.where("late").select("key")
    late_buckets = [r[0] for r in late.select(bucket).distinct().collect()]
    if late_buckets:
        past = _read(spark, f"{store}/rows", ROWS_SCHEMA).where(F.col("bucket").isin(late_buckets) & (F.col("batch_no") < batch_no))
        rows = rows.unionByName(past.join(late, "key", "left_semi").select(*seeds.columns).withColumn("origin", F.lit(EARLIER)))
    # the origin rides on the id, behind it in the order
    found = staged(anchored(rows.withColumn("id", F.struct("id", "origin")).drop("origin"), span), "increment-found")
    last = found.groupBy("key").agg(F.max_by("anchor", "pos").alias("a"), F.max("t").alias("last_t"))
    now = F.struct(F.col("a.id.id").alias("anchor_id"), F.col("a.t").alias("anchor_t"), F.col("a.shut").isNull().alias("open"), "last_t")
    before = state.select("key", "was")
    fresh = last.join(before, "key", "left").select("key", F.lit(batch_no).cast("long").alias("batch_no"), now.alias("now"),
                                                    F.col("was").alias("before"), bucket)
    others = stored.join(keys, "key", "left_anti").select(*fresh.columns)
    _put(own.withColumn("batch_no", F.lit(batch_no).cast("long")), f"{store}/rows", "bucket", "batch_no")
    _put(staged(others.unionByName(fresh), "increment-state"), f"{store}/state", "bucket")
    out = P.lookback_verdicts(found.where(F.col("id.origin") != SEED).select(
        F.col("id.id").alias("id"), "t", "pos", F.struct("anchor.pos", "anchor.t", F.col("anchor.id.id").alias("id"), "anchor.shut").alias("anchor"),
        (F.col("id.origin") == EARLIER).alias("replayed")), id_col, "replayed")
    return out.unionByName(passed)


def qualify_increment(spark: SparkSession, store: str, batch: DataFrame, batch_no: int, reps: DataFrame,
                      review_answers: DataFrame | None = None, approvals: DataFrame | None = None, as_of: AsOf = None,
                      end_col: str = "created_at", cfg: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """F1 for one batch: the rows ``qualify_leads`` gives its leads after all batches before it, without their leads.

    Also returns the duplicate verdicts that late rows changed for leads of earlier batches (none for batches in order)."""
    cfg = cfg or DEFAULT
    st = staged(L.stage_columns(batch, reps, review_answers, approvals, as_of, end_col, cfg), "qualify-stages")
    passed = st.filter(F.col("review_decision") == "accepted").withColumn("_outcome", L.run_outcome())
    dup = duplicate_increment(spark, store, passed, batch_no, outcome=F.col("_outcome"),
                              keeps_status=F.col("pii_action") == "deny", cfg=cfg["policies"])
    return L.with_final_status(st, dup.where("not replayed"), reps), dup.where("replayed").drop("replayed")
