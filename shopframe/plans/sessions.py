"""Sessions as mergeable summaries.

A session ends where a user is silent for longer than the gap. Time is cut into
slots of exactly one gap. All events of a user in one slot are less than a gap
apart, so they belong to one session, and a slot is summarised by plain
aggregates (first and last time, counts, sums, minima, maxima) that combine
map-side: the events are exchanged once, already reduced. Sessions are then
merged from the slots: a slot continues the session of the user's previous slot
if its first event follows that one's last event within the gap. The window
for that runs over a user's slots, of which there are at most (time span / gap)
however many events the user has, so a user with a third of all events costs
one small group.

Events without a time belong to no session. A null user is a user of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopframe.functions.exprs import epoch_us


def slot_of(ts: str | Column, gap_us: int) -> Column:
    """Number of the gap-wide slot of a time (floor, also before 1970)."""
    us = epoch_us(F.col(ts) if isinstance(ts, str) else ts)
    return F.floor((us - F.pmod(us, F.lit(gap_us))) / gap_us).cast("long")


def slots(ev: DataFrame, user: str, ts: str, gap_us: int, aggs: Mapping[str, Column] | None = None) -> DataFrame:
    """(user, _slot, _lo, _hi, n_events, aggs..., session_start): each slot with the start of its session."""
    e = ev.where(F.col(ts).isNotNull()).withColumn("_slot", slot_of(ts, gap_us))
    s = e.groupBy(user, "_slot").agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"), F.count(F.lit(1)).alias("n_events"),
                                     *[c.alias(n) for n, c in (aggs or {}).items()])
    w = Window.partitionBy(user).orderBy("_slot")
    before = F.lag("_hi").over(w)
    s = s.withColumn("_new", before.isNull() | (epoch_us(F.col("_lo")) - epoch_us(before) > gap_us))
    start = F.max(F.when(F.col("_new"), F.col("_lo"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return s.withColumn("session_start", start).drop("_new")


def session_summaries(ev: DataFrame, user: str, ts: str, gap_us: int, sums: Mapping[str, Column] | None = None,
                      mins: Mapping[str, Column] | None = None, maxes: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per session: (user, session_start, session_end, n_events, sums..., mins..., maxes...)."""
    parts = ((F.sum, sums or {}), (F.min, mins or {}), (F.max, maxes or {}))
    s = slots(ev, user, ts, gap_us, {n: f(c) for f, named in parts for n, c in named.items()})
    return s.groupBy(user, "session_start").agg(F.max("_hi").alias("session_end"), F.sum("n_events").alias("n_events"),
                                                *[f(n).alias(n) for f, named in parts for n in named])


def session_values(ev: DataFrame, user: str, ts: str, gap_us: int, value: Column, keep: Column) -> DataFrame:
    """(user, session_start, value): the distinct values of the kept events of each session.

    Values are made distinct within their slot before they meet the session, so
    no session's values are gathered in one row.
    """
    e = ev.where(F.col(ts).isNotNull()).withColumn("_slot", slot_of(ts, gap_us))
    v = e.where(keep).select(user, "_slot", value.alias("value")).distinct()
    at = slots(ev, user, ts, gap_us).select(F.col(user).alias("_u"), F.col("_slot").alias("_s"), "session_start")
    return v.join(at, v[user].eqNullSafe(at["_u"]) & (v["_slot"] == at["_s"])).select(user, "session_start", "value").distinct()


def as_sessions(ev: DataFrame) -> DataFrame:
    """Session summaries as they are, or made from events that carry a ``session_id``.

    Columns: ``user_id, session_id, session_start, n_events, depth, n_<type>``
    for the shop's event types, ``product_text`` (greatest product of the
    viewed uris, as text) and ``traffic_source``; from events, those whose
    columns are there.
    """
    if "n_events" in ev.columns:
        return ev
    aggs = [F.count(F.lit(1)).alias("n_events")]
    if "sequence_number" in ev.columns:
        aggs.append(F.max("sequence_number").alias("depth"))
    if "created_at" in ev.columns:
        aggs.append(F.min("created_at").alias("session_start"))
    if "traffic_source" in ev.columns:
        aggs.append(F.min("traffic_source").alias("traffic_source"))
    if "event_type" in ev.columns:
        aggs += [F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in ("product", "cart", "purchase", "cancel", "department")]
        if "uri" in ev.columns:
            aggs.append(F.max(F.when(F.col("event_type") == "product", F.split_part(F.col("uri"), F.lit("/"), F.lit(3)))).alias("product_text"))
    return ev.groupBy("session_id", *[c for c in ("user_id",) if c in ev.columns]).agg(*aggs)
