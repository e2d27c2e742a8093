"""Stored tables that are brought up to date without being rewritten.

A store is a Parquet folder partitioned by a period of the capture time (``part``) or by
buckets of the key.  A change replaces the partitions it touches, by Spark's dynamic
partition overwrite, and leaves the files of all others as they are; run again after a failure it
leaves the same rows.  What comes to the driver is a list of partitions, never rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import AsOf
from ..operators import reports as R
from ..operators.lifecycle import apply_status_updates, snapshot_diff
from .sinks import write_partitioned

# ----------------------------------------------------------------- S9

PART = "part"
#: Files a partition is written in (a hot day is split over as many tasks).
SLICES = 4


def part_of(at: Column, grain: str) -> Column:
    """The partition a capture time falls in: its day, or the first day of its week, month or year."""
    return F.to_date(at) if grain == "day" else F.trunc(F.to_date(at), grain)


def day_in_id(lead_id: Column) -> Column:
    """The capture day that a business id carries (``LD-YYYYMMDD-…``); null where it carries none."""
    return F.try_to_date(F.regexp_extract(lead_id, r"^[A-Z]+-([0-9]{8})-", 1), "yyyyMMdd")


def _write(rows: DataFrame, path: str, key: str, slices: int = SLICES) -> None:
    write_partitioned(rows.repartition(PART, F.pmod(F.xxhash64(key), F.lit(slices))), path, [PART])


def write_store(leads: DataFrame, path: str, ts_col: str = "created_at", key: str = "lead_id", grain: str = "day") -> None:
    """Store leads by period of capture (a null time is the null partition)."""
    _write(leads.withColumn(PART, part_of(F.col(ts_col), grain)), path, key)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def touched_parts(store: DataFrame, updates: DataFrame, key: str = "lead_id", grain: str = "day",
                  day_of: Callable[[Column], Column] | None = day_in_id) -> list[dt.date | None]:
    """Partitions that hold a lead with an update: a list of days, not of leads.

    Reads the key column alone; where ids carry their capture day, only the partitions that the updates'
    ids name (and those of ids without a day, for which all are read)."""
    ids = updates.select(key).where(F.col(key).isNotNull()).distinct()
    if day_of is not None:
        named = [r[0] for r in ids.select(part_of(day_of(F.col(key)), grain).alias(PART)).distinct().collect()]
        if None not in named:
            store = store.where(F.col(PART).isin(named) if named else F.lit(False))
    found = store.select(key, PART).join(ids, key, "left_semi").select(PART).distinct().collect()
    return [r[0] for r in found]


def merge_status_updates(spark: SparkSession, path: str, updates: DataFrame, key: str = "lead_id", grain: str = "day",
                         day_of: Callable[[Column], Column] | None = day_in_id) -> list[dt.date | None]:
    """S9 on a store: the touched partitions are read, updated as ``apply_status_updates`` does and replaced.

    Updates of ids the store does not hold change nothing.  Returns the partitions that were rewritten."""
    store = read_store(spark, path)
    parts = touched_parts(store, updates, key, grain, day_of)
    if parts:
        own = F.col(PART).isin([p for p in parts if p is not None])
        old = store.where(own | F.col(PART).isNull() if None in parts else own)
        _write(apply_status_updates(old, updates), path, key)
        spark.catalog.refreshByPath(path)
    return parts


# ----------------------------------------------------------------- S12, A19

def changed_days(leads: DataFrame, since: AsOf | dt.datetime, ts_col: str = "updated_at") -> list[dt.date]:
    """Capture days of leads changed after ``since``."""
    days = leads.where(F.col(ts_col) > F.lit(since)).select(F.to_date("created_at").alias("day")).distinct()
    return [r[0] for r in days.collect() if r[0] is not None]


def _month(day: dt.date) -> dt.date:
    return day.replace(day=1)


def refresh_summary(spark: SparkSession, path: str, leads: DataFrame, mql: DataFrame, sql: DataFrame,
                    days: Sequence[dt.date] | None = None, as_of: AsOf = None) -> None:
    """Bring the stored summary up to date for leads captured on ``days`` (None: all days).

    ``path/partials`` holds mergeable sums and counts per day and channel in a partition a month.  Those of
    the given days are computed anew from the leads of these days and replace the stored ones; the summary rows of
    the months with such a day (weeks: the months in which they start) are rolled up from partials alone and
    replace their partitions of ``path/summary`` (period, month of the report date).  Leads of other days are
    not read and other partitions not written.  Run again, it leaves the same rows."""
    if days is not None and not len(days):
        return
    if days is not None:
        leads = leads.where(F.to_date("created_at").isin(list(days)))
    fresh = R.summary_partials(leads, mql, sql).withColumn(PART, F.trunc("day", "month"))
    place = f"{path}/partials"
    if days is None:
        write_partitioned(fresh.repartition(PART), place, [PART])
    else:
        months = {_month(d) for d in days}
        kept = spark.read.schema(fresh.schema).parquet(place).where(F.col(PART).isin(list(months)) & ~F.col("day").isin(list(days)))
        write_partitioned(kept.unionByName(fresh).repartition(PART), place, [PART])
    spark.catalog.refreshByPath(place)
    partials, own = spark.read.schema(fresh.schema).parquet(place), F.lit(True)
    if days is not None:
        starts = {_month(d - dt.timedelta(d.weekday())) for d in days}  # months in which the days' weeks start
        nearby = months | starts | {_month(m + dt.timedelta(31)) for m in starts}
        partials = partials.where(F.col(PART).isin(list(nearby)))
        own = F.when(F.col("report_period") == "weekly", F.col("report_month").isin(list(starts))).otherwise(
            F.col("report_month").isin(list(months)))
    rolled = R.summary_rollup(partials.drop(PART), as_of).withColumn("report_month", F.trunc("report_date", "month")).where(own)
    write_partitioned(rolled.repartition("report_period", "report_month"), f"{path}/summary", ["report_period", "report_month"])


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/summary").drop("report_month")


# ----------------------------------------------------------------- S14

#: Buckets of a stored snapshot (folders) and parts of a bucket, each with a digest.
BUCKETS, SUBS = 256, 256


def row_digest(cols: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row, nulls told apart by place."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(F.lit(seed), nulls, *cols)


def write_snapshot(df: DataFrame, path: str, key: str = "lead_id", buckets: int = BUCKETS, subs: int = SUBS) -> None:
    """Store a snapshot by bucket of its key, with the digests of its rows per bucket and part of a bucket."""
    cols = sorted(df.columns)
    h = F.xxhash64(key)
    rows = df.withColumn("_bucket", F.pmod(h, F.lit(buckets)).cast("int")).withColumn(
        "_sub", F.pmod(F.shiftrightunsigned(h, 32), F.lit(subs)).cast("int"))
    write_partitioned(rows.repartition("_bucket", "_sub"), f"{path}/rows", ["_bucket"])
    rows.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/columns")  # an empty snapshot has a schema, too
    stored = _snapshot_rows(df.sparkSession, path)
    digests = stored.groupBy("_bucket", "_sub").agg(
        F.count("*").alias("n"), F.bit_xor(row_digest(cols, 1)).alias("x1"), F.bit_xor(row_digest(cols, 2)).alias("x2"),
        F.sum(F.shiftright(row_digest(cols, 3), 24)).alias("s"))
    digests.coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def _snapshot_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def differing(old: DataFrame, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups ``by`` whose digests differ or that one side lacks."""
    figures = ["n", "x1", "x2", "s"]

    def side(d: DataFrame, name: str) -> DataFrame:
        merged = d.groupBy(*by).agg(F.sum("n").alias("n"), F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("s").alias("s"))
        return merged.select(*by, F.struct(*figures).alias(name))
    both = side(old, "_old").join(side(new, "_new"), list(by), "full_outer")
    return both.where(~F.col("_old").eqNullSafe(F.col("_new"))).select(*by)


def diff_snapshots(spark: SparkSession, old_path: str, new_path: str, key: str = "lead_id") -> DataFrame:
    """S14 between stored snapshots of equal bucketing: digests per bucket, then per part of the buckets that
    differ; only rows of parts that differ are compared, and only folders of buckets that differ are read.

    The digests are one row per part of a bucket (``BUCKETS`` x ``SUBS`` at most), whatever the snapshots' size."""
    old, new = (spark.read.parquet(f"{p}/digests") for p in (old_path, new_path))
    buckets = [r[0] for r in differing(old, new, ["_bucket"]).collect()]
    here = F.col("_bucket").isin(buckets) if buckets else F.lit(False)
    parts = F.broadcast(differing(old.where(here), new.where(here), ["_bucket", "_sub"]))

    def rows(path: str) -> DataFrame:
        return _snapshot_rows(spark, path).where(here).join(parts, ["_bucket", "_sub"], "left_semi").drop("_bucket", "_sub")
    return snapshot_diff(rows(old_path), rows(new_path), key)
