"""The anchored duplicate rule (P9): a fold over each key's rows, and joins and windows that split a hot key by time.

Most keys have few rows.  The rows of a key of at most ``MOST`` rows are gathered in order (so a group is
bounded) and folded once.  Keys with more rows go the way below, which never has a whole key in one task.

Rows of a key are put in order and numbered.  A row is *shut* once a status that denies is in
force: at the row itself if its own outcome denies, else at the next row whose outcome does
(a row that leaves no status shuts nothing).  The next anchor after an anchor is the first row
behind its shut position that is at least the span later, so it depends on that anchor alone.

A row that follows a denying row by the span or more is an anchor whatever came before it, as
is a key's first row; every row before the next anchor belongs to the last such sure anchor.
Rows at least a span behind their sure anchor (only runs of submissions without such a pause
have any) get a pointer to the anchor that would follow them; the pointers are doubled until
all anchors of a run are marked: rounds grow with the logarithm of its time, not with its rows.

Numbers, pointers and anchors come from windows over (key, hour) and one row per key and hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import bucketed_max
from ..session import staged

HOUR = 3_600_000_000
DAY = 24 * HOUR
ORDER = ["t", "id", "resubmits", "shuts"]
#: Rows of a key that are gathered and folded, at most.
MOST = 512
BEFORE = (Window.unboundedPreceding, -1)
UP_TO = (Window.unboundedPreceding, Window.currentRow)


def _hour(t: Column | str) -> Column:
    return F.floor((F.col(t) if isinstance(t, str) else t) / HOUR)


def _numbered(rows: DataFrame, span: int) -> DataFrame:
    """Rows with ``pos`` (1, 2, … in their key), ``shut`` (a position; null: never) and their last sure ``anchor``.

    A pause of the span parts hours, so only an hour's first row can be a sure anchor: the anchors
    come from the table of hours."""
    w = rows.withColumn("_b", _hour("t")).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("key", "_b").orderBy(*ORDER)).cast("long"))
    w = w.withColumn("_shut_in", F.min(F.when(F.col("shuts"), F.col("_rn"))).over(
        Window.partitionBy("key", "_b").orderBy(F.desc("_rn")).rowsBetween(*UP_TO)))
    hours = w.groupBy("key", "_b").agg(
        F.max("_rn").alias("_size"), F.min(F.struct("_rn", "t", "id", "resubmits", "_shut_in")).alias("_first"),
        F.max(F.struct("_rn", "t", "shuts")).alias("_last"))
    by_hour = Window.partitionBy("key").orderBy("_b")
    hours = hours.select(
        "key", "_b", "_first", F.coalesce(F.sum("_size").over(by_hour.rowsBetween(*BEFORE)), F.lit(0)).alias("_off"),
        F.lag("_last").over(by_hour).alias("_before"))
    hours = hours.withColumn("_shut_after", F.min(F.col("_off") + F.col("_first._shut_in")).over(
        Window.partitionBy("key").orderBy(F.desc("_b")).rowsBetween(*BEFORE)))

    def shut(pos, resubmits, inside):
        return F.when(resubmits, F.coalesce(F.col("_off") + inside, "_shut_after")).otherwise(pos)
    first = F.struct((F.col("_off") + 1).alias("pos"), F.col("_first.t").alias("t"), F.col("_first.id").alias("id"),
                     shut(F.col("_off") + 1, F.col("_first.resubmits"), F.col("_first._shut_in")).alias("shut"))
    sure = F.col("_before").isNull() | (F.col("_before.shuts") & (F.col("_first.t") - F.col("_before.t") >= span))
    hours = hours.select("key", "_b", "_off", "_shut_after",
                         F.max(F.when(sure, first)).over(by_hour.rowsBetween(*UP_TO)).alias("anchor"))
    pos = F.col("_off") + F.col("_rn")
    return w.join(hours, ["key", "_b"]).select(
        "key", "id", "t", pos.alias("pos"), shut(pos, F.col("resubmits"), F.col("_shut_in")).alias("shut"), "anchor")


def _pointers(run: DataFrame, span: int) -> DataFrame:
    """key, run, pos and the position ``to`` of the anchor that would follow if the row were one."""
    rows = run.select("key", "run", "pos", "shut", F.col("t").alias("at"), F.lit(1).alias("is_row"))
    probes = run.select("key", "run", "pos", "shut", (F.col("t") + span).alias("at"), F.lit(0).alias("is_row"))
    both = rows.unionByName(probes).withColumn("_b", _hour("at"))
    own = F.when(F.col("is_row") == 1, F.col("pos"))
    w = both.withColumn("_in", F.min(own).over(
        Window.partitionBy("key", "run", "_b").orderBy(F.desc("at"), F.desc("is_row")).rowsBetween(*UP_TO)))
    hours = both.groupBy("key", "run", "_b").agg(F.min(own).alias("_first"))
    hours = hours.select("key", "run", "_b", F.min("_first").over(
        Window.partitionBy("key", "run").orderBy(F.desc("_b")).rowsBetween(*BEFORE)).alias("_after"))
    late = F.coalesce("_in", "_after")
    return (w.where("is_row = 0 and shut is not null").join(hours, ["key", "run", "_b"]).where(late.isNotNull())
            .select("key", "run", "pos", F.greatest(F.col("shut") + 1, late).alias("to")))


def _marked(run: DataFrame, span: int) -> DataFrame:
    """key, run, pos of the anchors inside the runs: the first row and all that its pointers reach."""
    at = ["key", "run", "pos"]
    marks = run.groupBy("key", "run").agg(F.min("pos").alias("pos"))
    jump = staged(_pointers(run, span), "duplicate-jumps")
    while not jump.isEmpty():
        new = marks.join(jump, at).select("key", "run", F.col("to").alias("pos"))
        marks = staged(marks.unionByName(new), "duplicate-marks")
        further = jump.select("key", "run", F.col("pos").alias("to"), F.col("to").alias("_to"))
        jump = staged(jump.join(further, ["key", "run", "to"]).select("key", "run", "pos", F.col("_to").alias("to")), "duplicate-jumps")
    return marks


def _folded(rows: DataFrame, span: int) -> DataFrame:
    """``anchored`` for keys of few rows.  An anchor's ``shut`` is as it stands at the row: null until the row that shuts it."""
    kind = rows.schema["id"].dataType.simpleString()
    none = F.array().cast(f"array<struct<id:{kind},t:bigint,pos:bigint,anchor:struct<pos:bigint,t:bigint,id:{kind},shut:bigint>>>")

    def step(done, x):
        pos, a = (F.size(done) + 1).cast("long"), F.get(done, F.size(done) - 1)["anchor"]

        def anchor(pos, t, id_, shut):
            return F.struct(pos.alias("pos"), t.alias("t"), id_.alias("id"), shut.cast("long").alias("shut"))
        now = (F.when(a.isNull() | (a["shut"].isNotNull() & (x["t"] - a["t"] >= span)), anchor(pos, x["t"], x["id"], F.when(~x["resubmits"], pos)))
               .when(a["shut"].isNull() & x["shuts"], anchor(a["pos"], a["t"], a["id"], pos)).otherwise(a))
        return F.concat(done, F.array(F.struct(x["id"].alias("id"), x["t"].alias("t"), pos.alias("pos"), now.alias("anchor"))))
    in_order = F.sort_array(F.collect_list(F.struct(*ORDER)))
    return rows.groupBy("key").agg(in_order.alias("rows")).select("key", F.inline(F.aggregate("rows", none, step)))


def _split(rows: DataFrame, span: int) -> DataFrame:
    """``anchored`` for keys of any number of rows."""
    first = staged(_numbered(rows, span), "duplicate-rows")
    behind = (F.col("t") - F.col("anchor.t") >= span) & F.coalesce(F.col("pos") > F.col("anchor.shut"), F.lit(False))
    out = ["key", "id", "t", "pos", "anchor"]
    run = first.where(behind).select("key", F.col("anchor.pos").alias("run"), "id", "t", "pos", "shut")
    if run.isEmpty():
        return first.select(*out)
    marks = _marked(run, span).withColumn("marked", F.lit(True))
    rest = bucketed_max(run.join(marks, ["key", "run", "pos"], "left"), ["key", "run"], ["pos"], _hour("t"),
                        F.when(F.col("marked"), F.struct("pos", "t", "id", "shut")), "anchor")
    return first.where(~behind).select(*out).unionByName(rest.select(*out))


def anchored(rows: DataFrame, span: int) -> DataFrame:
    """``rows``: key, id, t (micros), resubmits (its outcome lets the next one pass), shuts (its
    outcome denies and is written); none null but id.  Returns key, id, t, pos and its ``anchor``
    (pos, t, id, shut): the row passes unless the anchor is shut before it.  ``span`` is an hour or more."""
    hot = staged(rows.groupBy("key").count().where(F.col("count") > MOST).select("key"), "duplicate-hot-keys")
    if hot.isEmpty():
        return _folded(rows, span)
    return _folded(rows.join(hot, "key", "left_anti"), span).unionByName(_split(rows.join(hot, "key", "left_semi"), span))
