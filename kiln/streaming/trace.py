"""Begin/end trace-event pairing, first metadata and dense track numbers.

Batch: events are cut into slices by a range partitioning of (track, time), so a hot track spreads over many
slices. The depth of the stack inside a slice is a running sum that never falls below what the slice was
entered with; what a slice does to the stack is the pair (ends it takes from below, begins it leaves open),
which compose associatively, so the depth at the entry of each slice comes from a prefix scan over one row
a slice and track. Begins and ends of one level alternate: they are paired inside the slice, and the at most one end and one
begin that a level leaves over are paired across slices.

Stream: ``applyInPandasWithState`` keyed by track orders the events by event time behind the watermark, keeps
the stack across micro-batches and forgets tracks without open spans or waiting events.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kiln.operators.ranking import range_rank, range_slices

SPAN_SCHEMA = "track long, name string, depth long, begin_ts timestamp, end_ts timestamp, begin_id long, end_id long"


def pair_spans(events: DataFrame, track: str = "track", ph: str = "ph", ts: str = "ts", name: str = "name",
               event_id: str = "event_id", slices: int | None = None) -> DataFrame:
    """Spans (track, name, depth, begin, end) from B/E events; unmatched events dropped."""
    e = events.where(F.col(ph).isin("B", "E")).select(track, ph, ts, name, event_id)
    e = range_slices(e, [track, ts, event_id], "_slice", slices)
    step = F.when(F.col(ph) == "B", 1).otherwise(-1)
    local = Window.partitionBy(track, "_slice").orderBy(ts, event_id).rowsBetween(Window.unboundedPreceding, 0)
    e = e.withColumn("_sum", F.sum(step).over(local)).withColumn("_low", F.least(F.min("_sum").over(local), F.lit(0)))
    # one row a slice and track: what it adds, and how far below its entry it reaches
    ends = e.groupBy(track, "_slice").agg(F.sum(step).alias("_add"), F.min("_low").alias("_reach"))
    before = Window.partitionBy(track).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("_base", F.coalesce(F.sum("_add").over(before), F.lit(0)))
    ends = ends.withColumn("_floor", F.coalesce(F.least(F.min(F.col("_base") + F.col("_reach")).over(before), F.lit(0)), F.lit(0)))
    e = e.join(ends.select(track, "_slice", "_base", "_floor"), [track, "_slice"])
    total = F.col("_base") + F.col("_sum")
    depth = total - F.least(F.col("_floor"), F.col("_base") + F.col("_low"))
    # an end that finds an empty stack is the one that moves the floor: its total lies on a new low
    was = F.lag(F.col("_base") + F.col("_low")).over(Window.partitionBy(track, "_slice").orderBy(ts, event_id))
    floor_before = F.least(F.col("_floor"), F.coalesce(was, F.col("_base")))
    e = e.withColumn("level", F.when(F.col(ph) == "B", depth).when(total >= floor_before, total - floor_before + 1).cast("long"))
    e = e.where("level is not null").select(track, "level", "_slice", ph, ts, event_id, name)
    row = F.struct(F.col(ph).alias("ph"), F.col(ts).alias("ts"), F.col(event_id).alias("event_id"))
    inside = Window.partitionBy(track, "level", "_slice").orderBy(ts, event_id)
    e = e.withColumn("_next", F.lead(row).over(inside)).withColumn("_prev", F.lag(ph).over(inside))
    # left over: the last begin of a level in its slice, and a first end without a begin; these few are ordered across slices
    e = e.withColumn("_loose", F.when(F.col(ph) == "B", F.col("_next").isNull()).otherwise(F.col("_prev").isNull()))
    e = e.where((F.col(ph) == "B") | F.col("_loose")).withColumn("_at", F.when(F.col("_loose"), F.lit(-1)).otherwise(F.col("_slice")))
    across = Window.partitionBy(track, "level", "_at").orderBy("_slice", ts, event_id)
    both = e.withColumn("_end", F.when(F.col("_loose"), F.lead(row).over(across)).otherwise(F.col("_next")))
    both = both.where((F.col(ph) == "B") & (F.col("_end.ph") == "E"))
    return both.select(
        track, F.col(name).alias("name"), F.col("level").alias("depth"), F.col(ts).alias("begin_ts"), F.col("_end.ts").alias("end_ts"),
        F.col(event_id).alias("begin_id"), F.col("_end.event_id").alias("end_id"),
    )


def dense_ids(events: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Distinct ``key`` numbered from 0 by first appearance: first seen a key from partial aggregates, then a range rank."""
    first = events.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return range_rank(first, ["_first", key], "_rank").select(key, (F.col("_rank") - 1).alias(out))


def renumbered(events: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    """Events with ``key`` replaced by its dense number (K5)."""
    return events.join(dense_ids(events, key, order, out), key).drop(key)


def first_metadata(events: DataFrame, track: list[str], ts: str = "ts", event_id: str = "event_id") -> DataFrame:
    """K5: the first metadata (M) event of each track."""
    m = events.where(F.col("ph") == "M").groupBy(*track).agg(F.min_by(F.struct(*events.columns), F.struct(ts, event_id)).alias("_e"))
    return m.select("_e.*")


STATE = (
    "waiting array<struct<us:long, id:long, ph:string, name:string>>, open array<struct<us:long, id:long, name:string>>"
)


def stream_spans(events: DataFrame, delay: str, max_open_seconds: int | None = None) -> DataFrame:
    """K5 on a stream (track, ph, ts, name, event_id): pairs in event time, whatever order the events arrive in.

    Events wait until the watermark (``delay`` behind the latest event) has passed them. A track without waiting events
    and open spans leaves the state; with ``max_open_seconds``, spans open for longer are dropped from it, too. Events
    later than the watermark are dropped by Spark. The last events of a finite stream are paired once a later event
    (a heartbeat of another track) moves the watermark past them.
    """

    def pair(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, stack = ([tuple(w) for w in state.get[0]], [tuple(o) for o in state.get[1]]) if state.exists else ([], [])
        if not state.hasTimedOut:
            new = pd.concat(list(pdfs))
            waiting.extend(zip(*(new[c].tolist() for c in ("us", "event_id", "ph", "name")), strict=True))
        waiting.sort()
        now = state.getCurrentWatermarkMs()
        out = []
        ready = 0
        for us, i, ph, name in waiting:
            if us > now * 1000:
                break
            ready += 1
            if ph == "B":
                stack.append((us, i, name))
            elif ph == "E" and stack:
                began, b, opened = stack.pop()
                out.append((int(key[0]), opened, len(stack) + 1, began, us, b, i))
        waiting = waiting[ready:]
        if max_open_seconds is not None:
            stack = [o for o in stack if o[0] // 1000 + max_open_seconds * 1000 > now]
        if waiting or stack:
            state.update((waiting, stack))
            due = [waiting[0][0] // 1000] if waiting else []
            if stack and max_open_seconds is not None:
                due.append(stack[0][0] // 1000 + max_open_seconds * 1000)
            if due:
                state.setTimeoutTimestamp(max(min(due), now) + 1)
        elif state.exists:
            state.remove()
        if out:
            p = pd.DataFrame(out, columns=["track", "name", "depth", "begin_ts", "end_ts", "begin_id", "end_id"])
            for c in ("begin_ts", "end_ts"):
                p[c] = pd.to_datetime(p[c], unit="us")
            yield p

    seen = events.withWatermark("ts", delay).select("track", "ts", F.unix_micros("ts").alias("us"), "event_id", "ph", "name")
    return seen.groupBy("track").applyInPandasWithState(pair, SPAN_SCHEMA, STATE, "append", GroupStateTimeout.EventTimeTimeout)
