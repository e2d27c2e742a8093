"""Ordered window results that stay parallel when one key holds a large share of rows.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to one
task.  When the ordering starts with a column that can be cut into ordered
buckets (an hour of the timestamp, a load level, a hash prefix), the same result
is computed in two levels: per-(key, bucket) windows in parallel, plus a small
per-key table over the buckets (their sizes or last rows) joined back.  The small
table is derived from the windowed rows, so the input is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _join_keys(keys: Sequence[str]) -> list[str]:
    return [*keys, "_b"]


def null_safe_join(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` in which null meets null, so rows with a null key or bucket stay."""
    renamed = per_key.select(*[F.col(k).alias(f"_key_{k}") if k in keys else F.col(k) for k in per_key.columns])
    on = F.lit(True)
    for k in keys:
        on = on & rows[k].eqNullSafe(renamed[f"_key_{k}"])
    return rows.join(renamed, on).drop(*[f"_key_{k}" for k in keys])


def bucketed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                        bucket: Column, out: str = "_rn") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)``; ``bucket`` must be
    non-decreasing along ``order`` inside a key."""
    w = df.withColumn("_b", bucket).withColumn(
        "_rn_in", F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)))
    sizes = w.groupBy(*keys, "_b").agg(F.max("_rn_in").alias("_size"))
    offsets = sizes.select(*keys, "_b", F.coalesce(F.sum("_size").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    return (null_safe_join(w, offsets, _join_keys(keys))
            .withColumn(out, (F.col("_off") + F.col("_rn_in")).cast("int"))
            .drop("_b", "_off", "_rn_in"))


def bucketed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                 cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``lag(col) OVER (PARTITION BY keys ORDER BY order)`` for each of ``cols``.

    Inside a bucket the previous row comes from a window over (key, bucket); the
    first row of a bucket takes the last row of the key's previous non-empty
    bucket, read from the bucket-last rows (one per key and bucket)."""
    w_in = Window.partitionBy(*keys, "_b").orderBy(*order)
    w = df.withColumn("_b", bucket).select(
        "*", (F.row_number().over(w_in) == 1).alias("_first"),
        F.lead(F.lit(1)).over(w_in).isNull().alias("_last"),
        *[F.lag(c).over(w_in).alias(f"_lag_{c}") for c in cols])
    last = w.filter("_last").select(*keys, "_b", *[F.col(c).alias(f"_v_{c}") for c in cols])
    w_b = Window.partitionBy(*keys).orderBy("_b")
    prev_last = last.select(*keys, "_b", *[F.lag(f"_v_{c}").over(w_b).alias(f"_p_{c}") for c in cols])
    out = null_safe_join(w, prev_last, _join_keys(keys))
    return out.select(
        *df.columns,
        *[F.when(F.col("_first"), F.col(f"_p_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"{prefix}{c}")
          for c in cols])


def bucketed_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, value: Column,
                 out: str) -> DataFrame:
    """``max(value) OVER (PARTITION BY keys ORDER BY order)`` up to the row itself, nulls left out; with a
    struct that starts with a position it carries the last row that has a value.  Keys and bucket not null."""
    w = df.withColumn("_b", bucket).withColumn("_v", value)
    tops = w.groupBy(*keys, "_b").agg(F.max("_v").alias("_top"))
    before = tops.select(*keys, "_b", F.max("_top").over(
        Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    within = F.max("_v").over(Window.partitionBy(*keys, "_b").orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (w.withColumn("_in", within).join(before, _join_keys(keys))
            .withColumn(out, F.coalesce("_in", "_before")).drop("_b", "_v", "_in", "_before"))
