"""Sales routing and assignment.

Reps are a dimension table; teams are a handful of configured values.  Per-team
"best rep" tables therefore have one row per team, and the overall best rep is
a one-row scalar subquery — neither grows with the lead volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.windows import bucketed_row_number, null_safe_join
from ..session import staged
from .scoring import assign_team_col  # noqa: F401  (R1 lives with the scoring columns)

REP_FIELDS = ["current_load", "rep_id", "name", "email", "team"]


def available_reps(reps: DataFrame, ordered: bool = True) -> DataFrame:
    """R2: active reps under capacity; name = first + ' ' + last; least loaded first."""
    out = (reps.filter(F.col("is_active") & (F.col("current_load") < F.col("max_load")))
           .select("rep_id", F.concat_ws(" ", "first_name", "last_name").alias("name"), "email",
                   "team", "current_load", "max_load"))
    return out.orderBy("current_load", "rep_id") if ordered else out


def _best(df: DataFrame, *by: str) -> DataFrame:
    best = F.min(F.struct(*[F.col(c) for c in REP_FIELDS])).alias("best")
    return df.groupBy(*by).agg(best) if by else df.agg(best)


def assign_rep(leads: DataFrame, reps: DataFrame, team_col: str = "assigned_team",
               eligible: Column | None = None) -> DataFrame:
    """Least-loaded available rep of the lead's team, else least-loaded overall,
    else null (ties by rep_id).  Rows where ``eligible`` is false get no rep — one
    pass over the leads instead of splitting and re-uniting them."""
    avail = available_reps(reps, ordered=False)
    per_team = _best(avail, "team").withColumnRenamed("team", "_team")
    overall = _best(avail).select("best").scalar()
    # one row per team, and teams are a closed set (enterprise, mid-market, SMB, channel):
    # a bounded broadcast, so the leads are never shuffled on the 3-4 valued team key
    j = leads.join(F.broadcast(per_team), leads[team_col] == per_team["_team"], "left")
    pick = F.coalesce(F.col("best"), overall)
    ok = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    reason = (F.when(F.col("best").isNotNull(), "team").when(pick.isNotNull(), "fallback_any_team")
              .otherwise("no_rep_available"))
    return j.select(*leads.columns, F.when(ok, pick["rep_id"]).alias("assigned_rep_id"),
                    F.when(ok, pick["name"]).alias("assigned_rep_name"),
                    F.when(ok, pick["email"]).alias("assigned_rep_email"),
                    F.when(ok, reason).alias("assignment_reason"))


#: Hex digits of the hash that cut a team's leads into buckets: 65,536 buckets, a million rows each at 65 billion leads.
RANK_DIGITS = 4


def _lead_ranks(leads: DataFrame, team_col: str, digits: int = RANK_DIGITS) -> DataFrame:
    """Rank leads inside their team by (sha256(lead_id), lead_id) without a per-team window:
    the hash prefix cuts every team into 16**digits ordered buckets, so a team
    holding a third of all leads is spread over many window partitions."""
    b = leads.withColumn("_h", F.sha2(F.col("lead_id"), 256))
    r = bucketed_row_number(b, [team_col], ["_h", "lead_id"], F.substring("_h", 1, digits), out="_n")
    return r.withColumn("_n", F.col("_n").cast("long")).drop("_h")


def rep_slots(reps: DataFrame) -> DataFrame:
    """Free capacity as rows: one slot per unit between current and max load, numbered per
    team in water-filling order (lowest load level first, then rep_id); the load level
    is the bucket, so large teams still number their slots in parallel."""
    avail = available_reps(reps, ordered=False)
    slots = avail.select("rep_id", "name", "email", "team",
                         F.explode(F.sequence(F.col("current_load"), F.col("max_load") - 1)).alias("slot_load"))
    r = bucketed_row_number(slots, ["team"], ["slot_load", "rep_id"], F.col("slot_load"), out="_n")
    return r.withColumn("_n", F.col("_n").cast("long"))


def _arrival_ranks(leads: DataFrame, team_col: str, order_col: str) -> DataFrame:
    """Rank leads inside their team by time of arrival (then id), over hour buckets."""
    r = bucketed_row_number(leads, [team_col], [order_col, "lead_id"], F.date_trunc("hour", order_col), out="_n")
    return r.withColumn("_n", F.col("_n").cast("long"))


def assign_balanced(leads: DataFrame, reps: DataFrame, team_col: str = "assigned_team",
                    digits: int = RANK_DIGITS, order_col: str | None = None) -> DataFrame:
    """Give a whole batch of leads to reps so loads grow as leads are assigned.

    Leads of a team are served in an order without meaning (the hash of their id), or by ``order_col``, a time.

    Leads numbered 1..N inside their team meet free slots numbered 1..S inside the same team.
    Leads beyond their team's slots (or without a team) are numbered on across the teams and meet
    the slots that no team's own leads need, least loaded first; no rep goes past its capacity, and
    leads beyond all slots get none (``no_capacity``).  Both kinds are one equi-join on the number;
    the numbered leads are staged once, and offsets come from one row per team.
    """
    cols = leads.columns
    ranked = _arrival_ranks(leads, team_col, order_col) if order_col else _lead_ranks(leads, team_col, digits)
    ranked = staged(ranked, "balanced-ranks")
    slots = rep_slots(reps).withColumnRenamed("team", team_col)
    wanted = ranked.groupBy(team_col).agg(F.max("_n").alias("_wanted"))
    free = slots.groupBy(team_col).agg(F.max("_n").alias("_free"))
    team_free = wanted.join(free, team_col, "left").select(team_col, "_wanted", F.coalesce("_free", F.lit(0)).alias("_free"))
    earlier = Window.orderBy(team_col).rowsBetween(Window.unboundedPreceding, -1)  # one row per team
    team_free = team_free.select(team_col, "_free", F.coalesce(
        F.sum(F.greatest(F.col("_wanted") - F.col("_free"), F.lit(0))).over(earlier), F.lit(0)).alias("_off"))
    over = F.col("_n") > F.col("_free")
    at = [over.alias("_over"), F.when(over, "").otherwise(F.col(team_col)).alias("_pool"),
          F.when(over, F.col("_off") + F.col("_n") - F.col("_free")).otherwise(F.col("_n")).alias("_at")]
    numbered = null_safe_join(ranked, team_free, [team_col]).select(*cols, *at)

    needed = free.join(wanted, team_col, "left").select(team_col, F.coalesce("_wanted", F.lit(0)).alias("_wanted"))
    slots = null_safe_join(slots, needed, [team_col])
    spare = bucketed_row_number(slots.where("_n > _wanted").withColumn("_all", F.lit(0)), ["_all"], ["slot_load", "rep_id"],
                                F.col("slot_load"), out="_at")
    rep = [F.col("rep_id").alias("_rid"), F.col("name").alias("_rname"), F.col("email").alias("_remail")]
    places = slots.where("_n <= _wanted").select(F.lit(False).alias("_over"), F.col(team_col).alias("_pool"), F.col("_n").alias("_at"), *rep)
    places = places.unionByName(spare.select(F.lit(True).alias("_over"), F.lit("").alias("_pool"), F.col("_at").cast("long").alias("_at"), *rep))
    return numbered.join(places, ["_over", "_pool", "_at"], "left").select(
        *cols, F.col("_rid").alias("assigned_rep_id"), F.col("_rname").alias("assigned_rep_name"),
        F.col("_remail").alias("assigned_rep_email"),
        F.when(F.col("_rid").isNull(), "no_capacity").when(F.col("_over"), "overflow_other_team").otherwise("balanced")
        .alias("assignment_reason"))


def handoff_outbox(sql_leads: DataFrame, leads: DataFrame, reps: DataFrame) -> DataFrame:
    """One notification row per SQL not yet handed off (the outbox a CRM or chat
    connector drains)."""
    lead = leads.select("lead_id", "first_name", "last_name", "company")
    rep = reps.select(F.col("rep_id").alias("assigned_rep_id"), F.col("email").alias("rep_email"))
    s = sql_leads.filter(~F.col("handoff_confirmed")).select(
        "sql_id", "lead_id", "assigned_rep_id", "assigned_rep_name", "estimated_deal_size", "sql_score")
    j = s.join(lead, "lead_id", "left").join(rep, "assigned_rep_id", "left")
    text = F.concat(F.lit("New SQL assigned to "), F.coalesce(F.col("assigned_rep_name"), F.lit("")),
                    F.lit(": "), F.concat_ws(" ", "first_name", "last_name"), F.lit(" @ "),
                    F.coalesce(F.col("company"), F.lit("")))
    return j.select("sql_id", "lead_id", "assigned_rep_id", "rep_email", "estimated_deal_size", "sql_score",
                    text.alias("notification"))
