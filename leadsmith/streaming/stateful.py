"""Streams that carry state from one micro-batch to the next.

* ``stream_duplicates_ordered``: the duplicate rule (P9) on ``transformWithState``.  Emails share state in groups by
  hash; rows wait in a map state by time slot and are judged by a timer, in order of time, once the watermark
  has passed them, so rows may arrive in any order within the watermark's delay.
* ``close_windows``: event windows written once, when the watermark closes them, and a quarantine
  of rows that come later.
* ``assign_stream``: reps for streamed leads (R3 by capacity), with a ledger of what was assigned so far.

The last two are sinks for ``foreachBatch``.  What a micro-batch leaves lies in folders of its number and
is written by overwriting them, and it reads only folders of smaller numbers: run again, it leaves the same.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..config import DEFAULT
from ..operators import routing as R
from ..sources.files import exists

ROCKSDB = {"spark.sql.streaming.stateStore.providerClass":
           "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

# ----------------------------------------------------------------- X2

VERDICTS = "lead_id string, dup_action string, anchor_id string, days_since_anchor long"
DAY = 24 * 3_600_000_000


#: Groups of emails by hash that share state.  Each call to the state store costs far more than a row,
#: so calls are per group and time slot.
GROUPS = 256
#: Width of a time slot of waiting rows: the most that is read at once of a group.
SLOT = 31 * DAY


class AnchoredLookback(StatefulProcessor):
    """State of a group of emails: their anchors, and the rows the watermark has not passed yet, by time slot.

    One timer stands at the time of the earliest waiting row or of the first anchor that denies nothing any more."""

    def __init__(self, span_days: int, allow: tuple[str, ...]):
        self.span, self.allow = span_days * DAY, allow

    def init(self, handle) -> None:
        self.handle = handle
        self.anchors = handle.getValueState("anchors", "by_email string")
        self.waiting = handle.getMapState("waiting", "slot long", "rows string")
        self.due = handle.getValueState("due", "ms long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:  # one Arrow batch at a time
            new: dict[int, list] = {}
            for us, i, em, status, keeps in zip(pdf["us"].tolist(), pdf["lead_id"], pdf["email"], pdf["outcome"], pdf["keeps"].tolist()):
                new.setdefault(us // SLOT, []).append([us, i, em, status, keeps])
                first = us if first is None else min(first, us)
            for slot, own in new.items():
                text = json.dumps(own)
                if self.waiting.containsKey((slot,)):
                    text = self.waiting.getValue((slot,))[0][:-1] + "," + text[1:]
                self.waiting.updateValue((slot,), (text,))
        if first is not None:
            self._wake(first)
        return iter(())

    def _wake(self, us: int) -> None:
        """Have the timer no later than this time."""
        ms = -(-us // 1000)
        if not self.due.exists() or ms < self.due.get()[0]:
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Judge the rows that the watermark has passed, slot by slot in order of time."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        anchors = json.loads(self.anchors.get()[0]) if self.anchors.exists() else {}
        slots, later = sorted(k[0] for k in self.waiting.keys()), []
        for slot in slots:
            if slot * SLOT > mark:
                later.append(slot * SLOT)
                continue
            rows = json.loads(self.waiting.getValue((slot,))[0])
            rest = [r for r in rows if r[0] > mark]
            if len(rest) < len(rows):
                yield pd.DataFrame(self._judged(rows, anchors, mark), columns=["lead_id", "dup_action", "anchor_id", "days_since_anchor"])
            if not rest:
                self.waiting.removeKey((slot,))
            else:
                later.append(min(r[0] for r in rest))
                if len(rest) < len(rows):
                    self.waiting.updateValue((slot,), (json.dumps(rest),))
        # an anchor that denies nothing any more goes
        anchors = {em: a for em, a in anchors.items() if a[2] in self.allow or a[1] + self.span > mark}
        later += [a[1] + self.span for a in anchors.values() if a[2] not in self.allow]
        if anchors:
            self.anchors.update((json.dumps(anchors),))
        else:
            self.anchors.clear()
        self.due.clear()
        if later:
            self._wake(min(later))

    def _judged(self, rows: list, anchors: dict, mark: int) -> list:
        out = []
        for us, i, em, status, keeps in sorted((r for r in rows if r[0] <= mark), key=lambda r: (r[0], r[1] or "")):
            state = anchors.get(em)
            if state is None or (state[2] not in self.allow and us - state[1] >= self.span):
                anchors[em] = (i, us, status)
                out.append((i, "allow", i, 0))
            elif state[2] in self.allow:
                if not keeps:
                    anchors[em] = (state[0], state[1], status)
                out.append((i, "allow", state[0], (us - state[1]) // DAY))
            else:
                out.append((i, "deny", state[0], (us - state[1]) // DAY))
        return out

    def close(self) -> None:
        pass


def stream_duplicates_ordered(leads: DataFrame, key: str = "email", ts_col: str = "created_at", outcome: Column | None = None,
                              keeps_status: Column | None = None, watermark: str = "1 day", cfg: dict | None = None,
                              groups: int = GROUPS) -> DataFrame:
    """P9 on a stream whose rows come in any order within ``watermark``; needs the RocksDB state store (``ROCKSDB``).

    A row is judged once the watermark has passed it; rows that come after that are left out and counted by the
    query (``late_rows``).  Rows without an email or a time are allowed at once.  Equal to the batch rule
    on all rows that were not late."""
    p = cfg or DEFAULT["policies"]
    em, ts = F.lower(F.trim(F.col(key))), F.col(ts_col).cast("timestamp")
    base = leads.select("lead_id", ts.alias("_ts"), F.unix_micros(ts).alias("us"), em.alias("email"),
                        (outcome if outcome is not None else F.lit("processing")).alias("outcome"),
                        F.coalesce(keeps_status if keeps_status is not None else F.lit(False), F.lit(False)).alias("keeps"))
    alone = F.col("email").isNull() | (F.col("email") == "") | F.col("_ts").isNull()
    grouped = base.where(~alone).withColumn("_group", F.pmod(F.xxhash64("email"), F.lit(groups)).cast("int"))
    judged = grouped.withWatermark("_ts", watermark).groupBy("_group").transformWithStateInPandas(
        statefulProcessor=AnchoredLookback(p["lookback_days"] + 1, tuple(p["allow_resubmit_statuses"])),
        outputStructType=VERDICTS, outputMode="append", timeMode="eventTime")
    return judged.unionByName(base.where(alone).select("lead_id", F.lit("allow").alias("dup_action"), F.lit(None).cast("string").alias("anchor_id"),
                                                       F.lit(None).cast("long").alias("days_since_anchor")))


def late_rows(progress: list) -> int:
    """Rows that the state operators of a query left out because they came behind the watermark."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in progress for op in json.loads(p.json).get("stateOperators", []))


# ----------------------------------------------------------------- runner

def drain(source: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``sink`` over what a source has that this checkpoint has not seen, then stop."""
    q = source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _put(df: DataFrame, path: str, batch_no: int) -> DataFrame:
    """Write a micro-batch's folder and read it back."""
    own = f"{path}/batch_no={batch_no}"
    df.write.mode("overwrite").parquet(own)
    return df.sparkSession.read.schema(df.schema).parquet(own)


def _earlier(spark: SparkSession, path: str, schema: str, batch_no: int) -> DataFrame:
    """What earlier micro-batches left below ``path``."""
    whole = f"{schema}, batch_no long"
    df = spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)
    return df.where(F.col("batch_no") < batch_no)


# ----------------------------------------------------------------- X3

WINDOW_SCHEMA = "window_start timestamp_ntz, window_end timestamp_ntz, {by} string, events long, value_sum double"


def close_windows(path: str, ts_col: str = "ts", window: str = "1 hour", delay: dt.timedelta = dt.timedelta(minutes=10),
                  by: str = "event_type", value: str = "value") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink for final windows below ``path``.

    The watermark of a micro-batch is the largest time of the batches before it, less ``delay``.  Rows whose window
    ended by then, or without a time, go to ``late``; the others are added to ``partials`` as one row per window and group.  A
    window is written to ``windows`` once, by the batch whose rows move the watermark past its end.
    Every row is in exactly one of a final window, a window still open, and the quarantine."""
    sums = [F.sum("events").alias("events"), F.sum("value_sum").alias("value_sum")]

    def sink(batch: DataFrame, batch_no: int) -> None:
        spark = batch.sparkSession
        timeless = batch.where(F.col(ts_col).isNull())  # in no window
        batch = batch.withColumn("_w", F.window(F.col(ts_col).cast("timestamp"), window))
        end = F.col("_w.end").cast("timestamp_ntz")
        marks = _earlier(spark, f"{path}/marks", "mark timestamp_ntz", batch_no)
        mark = marks.agg(F.max("mark")).first()[0]
        late = F.coalesce(end <= F.lit(mark).cast("timestamp_ntz"), F.lit(False))
        _put(batch.where(late).drop("_w").unionByName(timeless), f"{path}/late", batch_no)
        fresh = _put(batch.where(~late).groupBy(F.col("_w.start").cast("timestamp_ntz").alias("window_start"), end.alias("window_end"), by)
                     .agg(F.count("*").alias("events"), F.sum(F.col(value).cast("double")).alias("value_sum")), f"{path}/partials", batch_no)
        top = batch.agg(F.max(F.col(ts_col).cast("timestamp_ntz")).alias("t")).select(
            F.greatest(F.col("t") - F.lit(delay), F.lit(mark).cast("timestamp_ntz")).alias("mark"))
        now = _put(top, f"{path}/marks", batch_no).first()[0]
        closed = F.col("window_end") <= F.lit(now).cast("timestamp_ntz")
        still = F.lit(True) if mark is None else F.col("window_end") > F.lit(mark)
        before = _earlier(spark, f"{path}/partials", WINDOW_SCHEMA.format(by=by), batch_no).where(still & closed).drop("batch_no")
        _put(before.unionByName(fresh.where(closed)).groupBy("window_start", "window_end", by).agg(*sums), f"{path}/windows", batch_no)
    return sink


def open_windows(spark: SparkSession, path: str, by: str = "event_type") -> DataFrame:
    """Windows that no micro-batch has closed yet, as far as they have come."""
    schema = WINDOW_SCHEMA.format(by=by)
    mark = spark.read.schema("mark timestamp_ntz").parquet(f"{path}/marks").agg(F.max("mark")).first()[0]
    rows = spark.read.schema(schema).parquet(f"{path}/partials").where(F.col("window_end") > F.lit(mark))
    return rows.groupBy("window_start", "window_end", by).agg(F.sum("events").alias("events"), F.sum("value_sum").alias("value_sum"))


# ----------------------------------------------------------------- X4

def assign_stream(path: str, reps: DataFrame, team_col: str = "assigned_team", order_col: str = "created_at") -> Callable[[DataFrame, int], None]:
    """X4 with R3: a ``foreachBatch`` sink that gives streamed leads the least-loaded reps below ``path/assigned``.

    ``path/ledger`` holds, per micro-batch and rep, the leads assigned; a batch starts from the roster's loads plus
    what earlier batches assigned.  Inside a batch, leads of a team are served in order of ``order_col``
    by the balanced rule (R4): least-loaded first, loads grow as leads are assigned, overflow takes spare slots of other
    teams, and no rep goes past its capacity in any batch."""
    def sink(batch: DataFrame, batch_no: int) -> None:
        used = _earlier(batch.sparkSession, f"{path}/ledger", "rep_id string, n long", batch_no)
        used = used.groupBy("rep_id").agg(F.sum("n").alias("_used"))
        now = reps.join(used, "rep_id", "left").withColumn(
            "current_load", (F.col("current_load") + F.coalesce("_used", F.lit(0))).cast("int")).drop("_used")
        done = _put(R.assign_balanced(batch, now, team_col, order_col=order_col), f"{path}/assigned", batch_no)
        _put(done.where("assigned_rep_id is not null").groupBy(F.col("assigned_rep_id").alias("rep_id")).agg(F.count("*").alias("n")),
             f"{path}/ledger", batch_no)
    return sink
