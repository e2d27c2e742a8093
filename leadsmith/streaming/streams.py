"""Structured Streaming forms of the per-lead path.

Each ``stream_*`` function takes a streaming DataFrame and returns one; the
caller picks sink, trigger and checkpoint.  ``run_available_now`` is the
batch-equivalent runner used by the checks: it drains the source with an
available-now trigger into Parquet under the shared checkpoint folder and
reads the result back.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..config import DEFAULT
from ..operators import scoring as S
from ..operators import screening as W
from ..session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory (never a machine-local temp dir)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def stage_as_files(df: DataFrame, path: str) -> str:
    """Write a derived table as Parquet files for a file-stream source, in the partitions it has."""
    df.write.mode("overwrite").parquet(path)
    return path


def run_available_now(sdf: DataFrame, name: str, mode: str = "append", keys: list[str] | None = None,
                      conf: dict[str, str] | None = None, progress: list | None = None) -> DataFrame:
    """Drain a streaming query (available-now trigger) into Parquet and return the result.

    ``conf`` holds while the query starts (a state store, say); ``progress`` receives its progress reports.

    Each micro-batch owns one folder and overwrites it, so a batch run again after a failure
    leaves its rows once.  ``append`` returns all rows; ``update`` the newest row of each ``keys``.
    """
    spark = sdf.sparkSession
    base = scratch(spark, name)
    out, ckpt = f"{base}/out", f"{base}/checkpoint"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_no={batch_id}")

    before = {k: spark.conf.get(k, None) for k in conf or {}}
    for k, v in (conf or {}).items():
        spark.conf.set(k, v)
    try:
        q = (sdf.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if progress is not None:
        progress.extend(q.recentProgress)
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    rows = spark.read.schema(T.StructType([*sdf.schema.fields, T.StructField("batch_no", T.LongType())])).parquet(out)
    if mode != "update":
        return rows.drop("batch_no")
    rest = [c for c in sdf.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_no").alias("_newest"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in sdf.columns])


# ----------------------------------------------------------------- X1

def stream_screen(leads: DataFrame, end_col: str = "processed_at", cfg: dict | None = None) -> DataFrame:
    """Screen, score and route leads as they arrive (stateless; the batch functions)."""
    cfg = cfg or DEFAULT
    return W.screen_leads(leads, cfg["form"], end_col=end_col)


def stream_score(leads: DataFrame, as_of=None, cfg: dict | None = None) -> DataFrame:
    """MQL and BANT scores of leads as they arrive (stateless)."""
    cfg = cfg or DEFAULT
    m = S.score_mql(leads, cfg["scoring"])
    return S.score_bant(m.withColumnRenamed("qualified", "mql_qualified"), cfg["scoring"], as_of)


# ----------------------------------------------------------------- X2

DUP_OUT = T.StructType([
    T.StructField("lead_id", T.StringType()), T.StructField("dup_action", T.StringType()),
    T.StructField("anchor_id", T.StringType()), T.StructField("days_since_anchor", T.LongType()),
])
DUP_STATE = T.StructType([T.StructField("by_email", T.StringType())])
#: Groups of emails by hash that share one state: a call of the state function costs far more than a row.
GROUPS = 1024
DAY = 24 * 3_600_000_000


def _dup_state_fn(days: int, allow: tuple[str, ...]):
    limit = (days + 1) * DAY

    def keep(state, held: dict) -> None:
        """Keep the anchors that can still deny or pass on a status, until the first of them can not."""
        mark = state.getCurrentWatermarkMs()
        # a re-submittable status keeps its (possibly old) anchor: no expiry; after expiry every later row registers anew
        held = {em: a for em, a in held.items() if a[2] in allow or (a[1] + limit) // 1000 > mark}
        if not held:
            state.remove()
            return
        state.update((json.dumps(held),))
        expiries = [(a[1] + limit) // 1000 for a in held.values() if a[2] not in allow]
        if expiries:
            # the anchor can no longer deny anything once the watermark passes anchor + window
            state.setTimeoutTimestamp(min(expiries))

    def fn(key, pdfs: Iterator[pd.DataFrame], state):
        held = json.loads(state.get[0]) if state.exists else {}
        if state.hasTimedOut:
            keep(state, held)
            return
        # rows of this group in this micro-batch (bounded by the trigger size), in time order
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(["_us", "lead_id"], kind="stable")
        acts, anchors, ds = [], [], []
        for i, em, us, o, keeps in zip(pdf["lead_id"], pdf["_em"], pdf["_us"].tolist(), pdf["_outcome"], pdf["_keeps"].tolist()):
            anchor_id, anchor_us, status = held.get(em, (None, None, None))
            if anchor_id is None or (status not in allow and us - anchor_us >= limit):
                held[em] = (i, us, o)
                acts.append("allow"); anchors.append(i); ds.append(0)
            elif status in allow:
                if not keeps:
                    held[em] = (anchor_id, anchor_us, o)
                acts.append("allow"); anchors.append(anchor_id); ds.append((us - anchor_us) // DAY)
            else:
                acts.append("deny"); anchors.append(anchor_id); ds.append((us - anchor_us) // DAY)
        keep(state, held)
        yield pd.DataFrame({"lead_id": pdf["lead_id"].values, "dup_action": acts, "anchor_id": anchors,
                            "days_since_anchor": pd.Series(ds, dtype="int64")})
    return fn


def stream_duplicates(leads: DataFrame, key: str = "email", ts_col: str = "created_at",
                      outcome=None, watermark: str = "1 day", cfg: dict | None = None, keeps_status=None,
                      groups: int = GROUPS) -> DataFrame:
    """The anchored duplicate rule on a stream — an anchor per lower/trimmed email, kept with those of
    its group, event-time timeout ``days + 1`` after the anchor; rows without an email or a time pass through as allowed."""
    p = cfg or DEFAULT["policies"]
    days, allow = p["lookback_days"], tuple(p["allow_resubmit_statuses"])
    em = F.lower(F.trim(F.col(key)))
    base = leads.select("lead_id", F.col(ts_col).cast("timestamp").alias("_ts"), em.alias("_em"),
                        F.unix_micros(F.col(ts_col).cast("timestamp")).alias("_us"), F.pmod(F.xxhash64(em), F.lit(groups)).cast("int").alias("_group"),
                        (outcome if outcome is not None else F.lit("processing")).alias("_outcome"),
                        F.coalesce(keeps_status if keeps_status is not None else F.lit(False), F.lit(False)).alias("_keeps"))
    alone = F.col("_em").isNull() | (F.col("_em") == "") | F.col("_ts").isNull()
    keyed = base.filter(~alone).withWatermark("_ts", watermark)
    folded = keyed.groupBy("_group").applyInPandasWithState(
        _dup_state_fn(days, allow), DUP_OUT, DUP_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    blank = base.filter(alone).select(
        "lead_id", F.lit("allow").alias("dup_action"), F.lit(None).cast("string").alias("anchor_id"),
        F.lit(None).cast("long").alias("days_since_anchor"))
    return folded.unionByName(blank)


# ----------------------------------------------------------------- X3

def stream_event_windows(events: DataFrame, ts_col: str = "ts", window: str = "1 hour",
                         watermark: str = "10 minutes", by: str = "event_type") -> DataFrame:
    """Events per type in tumbling windows (append or update mode: the watermark closes windows and
    leaves out rows that come after their window closed)."""
    return (events.withWatermark(ts_col, watermark)
            .groupBy(F.window(ts_col, window).alias("w"), by)
            .agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value_sum"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), by, "events", "value_sum"))


# ----------------------------------------------------------------- X4

def stream_enrich(sql_stream: DataFrame, reps: DataFrame) -> DataFrame:
    """Attach each streamed SQL lead's rep contact (stream-static join to the whole roster,
    full and inactive reps included)."""
    rep = reps.select(F.col("rep_id").alias("assigned_rep_id"), F.col("email").alias("rep_email"),
                      F.col("team").alias("rep_team"), F.col("current_load").alias("rep_load"))
    return sql_stream.join(rep, "assigned_rep_id", "left")
