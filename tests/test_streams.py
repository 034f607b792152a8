"""Stateful streams against plain sequential versions: restarts, arrival order, hot tracks, declared lengths."""

import random
import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln.operators.ranking import range_slices
from kiln.streaming import groups, replay, shuffle_buffer, trace
from tests.conftest import SF_SMALL


def stack_spans(events):
    """(track, name, depth, begin_id, end_id) by a stack for each track, events in (ts, id) order."""
    stacks, out = {}, []
    for track, ph, _, name, i in sorted(events, key=lambda e: (e[0], e[2], e[4])):
        stack = stacks.setdefault(track, [])
        if ph == "B":
            stack.append((name, i))
        elif ph == "E" and stack:
            n, b = stack.pop()
            out.append((track, n, len(stack) + 1, b, i))
    return sorted(out)


def trace_events(n, seed=1):
    """Half of all events on track 0; ends without begins, begins without ends, equal times."""
    r = random.Random(seed)
    return [(0 if r.random() < 0.5 else r.randrange(1, 40), r.choice("BBEEEM" if k % 3 else "BBBE"), 1_000_000 * (1 + k // 2), f"n{k % 5}", k) for k in range(n)]


EVENTS = "track long, ph string, us long, name string, event_id long"


def frame(spark, events):
    return spark.createDataFrame(events, EVENTS).withColumn("ts", F.timestamp_micros("us")).drop("us")


def found(df):
    return sorted((r.track, r.name, r.depth, r.begin_id, r.end_id) for r in df.collect())


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_hot_track_pairs_over_slices(spark, slices):
    events = trace_events(3000)
    df = frame(spark, events).repartition(5)
    assert found(trace.pair_spans(df, slices=slices)) == stack_spans(events)


def test_hot_track_is_cut(spark):
    df = frame(spark, trace_events(8000))
    sizes = [r["count"] for r in range_slices(df, ["track", "ts", "event_id"], "s", 24).groupBy("s").count().collect()]
    assert max(sizes) < 8000 / 8  # though one track has half of the rows
    plan = trace.pair_spans(df, slices=24)._jdf.queryExecution().optimizedPlan().toString()
    keys = [re.sub(r"#\d+L?", "", m) for m in re.findall(r"Window .*\], \[([^\]]*)\], \[[^\]]*\]$", plan, re.M)]
    assert sorted(set(keys)) == ["track", "track, _slice", "track, level, _at", "track, level, _slice"]
    assert keys.count("track") <= 2  # over the one row of each slice


def test_stream_pairs_in_event_time_and_forgets(spark, tmp_path):
    """Ends that arrive runs before their begins pair; nothing is left in the state behind the last watermark."""
    r = random.Random(4)
    events = [e for e in trace_events(400, 2) if e[1] != "M"]
    r.shuffle(events)
    parts = [frame(spark, events[k::3]) for k in range(3)]
    beat = frame(spark, [(-1, "M", 10**12, "", -1)])
    out = str(tmp_path / "spans")
    replay.feed([*parts, beat], lambda s: trace.stream_spans(s, "1 hour", max_open_seconds=3600), out)
    assert found(replay.rows(spark, out, trace.SPAN_SCHEMA)) == stack_spans(events)
    state = spark.read.format("statestore").load(f"{out}/checkpoint").select("key.track").distinct().collect()
    assert [x.track for x in state] in ([], [-1])  # the heartbeat itself waits for the next watermark


def test_dense_ids_by_first_appearance(spark):
    events = trace_events(500, 3)
    got = {r.track: r.d for r in trace.dense_ids(frame(spark, events).repartition(7), "track", ["ts", "event_id"], "d").collect()}
    want = {}
    for e in sorted(events, key=lambda e: (e[2], e[4])):
        want.setdefault(e[0], len(want))
    assert got == want
    again = trace.renumbered(frame(spark, events), "track", ["ts", "event_id"], "d")
    assert sorted((r.d, r.event_id) for r in again.collect()) == sorted((want[e[0]], e[4]) for e in events)


def plain_shuffle(n, size, seed, spark):
    """The buffer, one row after another."""
    size = max(1, min(size, n))
    slots = {r.id: r.s for r in spark.range(n).select("id", shuffle_buffer.slot(F.col("id"), size, seed).alias("s")).collect()}
    end = [r.slot for r in shuffle_buffer.closing(spark, n, size, seed).orderBy("position").collect()]
    held, out = {}, []
    for p in range(n):
        if slots[p] in held:
            out.append(held[slots[p]])
        held[slots[p]] = p
    return out + [held[s] for s in end]


@pytest.mark.parametrize(("n", "size", "cuts"), [(500, 64, (0, 500)), (500, 64, (0, 30, 31, 290, 500)), (20, 64, (0, 7, 20)), (1, 8, (0, 1))])
def test_buffer_shuffle(spark, tmp_path, n, size, cuts):
    """Places don't depend on the micro-batches; a buffer beyond the stream is a whole shuffle."""
    parts = [spark.range(a, b).withColumnRenamed("id", "position") for a, b in zip(cuts, cuts[1:], strict=False)]
    got = shuffle_buffer.run_buffer_shuffle(parts, n, 8, str(tmp_path / "b"), size, seed=3)
    rows = {r.place: r.position for r in got.rows.collect()}
    want = plain_shuffle(n, size, 3, spark)
    assert [rows[k] for k in range(n)] == want and sorted(want) == list(range(n))
    assert len(got) == n // 8
    if len(got) > 1:
        with pytest.raises(ValueError, match="in order"):
            got.get_batch(1)
        assert [r.position for r in got.get_batch(0).collect()] == want[:8]
        assert [r.position for r in got.get_batch(1).collect()] == want[8:16]
        with pytest.raises(ValueError, match="in order"):
            got.get_batch(0)


def test_declared_length_is_checked(spark, tmp_path):
    rows = [spark.range(100).withColumnRenamed("id", "position")]
    with pytest.raises(Exception, match="longer than its declared length"):
        shuffle_buffer.run_buffer_shuffle(rows, 90, 8, str(tmp_path / "long"), 16)
    with pytest.raises(ValueError, match="not the declared 120"):
        shuffle_buffer.run_buffer_shuffle(rows, 120, 8, str(tmp_path / "short"), 16)


GROUPS = "lane long, group_id long, seconds long, usable boolean, sampler_step long"


def group_rows(n, seed=7):
    r = random.Random(seed)
    t, out = 1, []
    for g in range(n):
        t += r.choice([1, 5, 60, 60, 900])
        out.append((r.randrange(3), g, t, r.random() < 0.75, g // 8 - r.randrange(6)))
    return out


def run_groups(spark, rows, rules, cuts, out):
    df = [
        spark.createDataFrame(rows[a:b], GROUPS).repartition(2).withColumn("arrival", F.timestamp_seconds("seconds")).drop("seconds")
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    replay.feed(df, lambda s: groups.batch_groups(s, rules, "1 minute"), out)
    return sorted(tuple(r) for r in replay.rows(spark, out, groups.ROWS).collect())


def plain_minibatches(rows, size, per_step, placeholders, off_policy):
    """One queue a lane, as a loop over its groups."""
    out = []
    for lane in sorted({r[0] for r in rows}):
        buffer, done = [], 0
        for _, g, _, usable, sampled in (r for r in rows if r[0] == lane):
            if not usable and not placeholders:
                continue
            if usable and off_policy is not None and done // per_step - sampled > off_policy:
                out.append((lane, "requeue", done // per_step, g))
                continue
            buffer.append(g if usable else None)
            if len(buffer) == size:
                out.extend((lane, "train", done // per_step, x) for x in buffer if x is not None)
                buffer, done = [], done + 1
    return sorted(out)


@pytest.mark.parametrize("cuts", [(0, 240), (0, 50, 51, 200, 240)])
def test_group_batches_survive_restarts(spark, tmp_path, cuts):
    rows = group_rows(240)
    rules = {"held": groups.BatchRule(8, 2, 2, placeholders=True), "skipped": groups.BatchRule(8, 2, 2, max_steps_off_policy=3)}
    got = run_groups(spark, rows, rules, cuts, str(tmp_path / "g"))
    for name, rule in rules.items():
        mine = [r for r in got if r[0] == name]
        assert sorted((r[1], r[2], r[3], r[7]) for r in mine) == plain_minibatches(rows, 2, 4, rule.placeholders, rule.max_steps_off_policy)
        full = Counter(r[1:2] + r[3:6] for r in mine if r[2] == "train")
        assert all(n == 2 for n in full.values()) if name == "skipped" else all(n <= 2 for n in full.values())
    assert {r[2] for r in got if r[0] == "skipped"} == {"train", "requeue"}


def test_idle_buffers_expire(spark, tmp_path):
    """A gap within a run, a gap between runs, and a lane that gets nothing more."""
    rows = [(0, 1, 1, True, 0), (0, 2, 10, True, 0), (0, 3, 5000, True, 0), (0, 4, 5010, True, 0), (0, 5, 5020, True, 0), (1, 6, 5030, True, 0),
            (0, 7, 20000, True, 0), (0, 8, 90000, False, 0), (0, 9, 90001, False, 0)]
    got = run_groups(spark, rows, {"r": groups.BatchRule(3, gap_seconds=100)}, (0, 6, 7, 9), str(tmp_path / "g"))
    assert [(r[1], r[2], r[3], r[6], r[7]) for r in got] == [
        (0, "expired", 0, 0, 1), (0, "expired", 0, 1, 2), (0, "expired", 1, 0, 7), (0, "train", 0, 0, 3), (0, "train", 0, 1, 4), (0, "train", 0, 2, 5),
        (1, "expired", 0, 0, 6),
    ]


def test_sizes_must_divide():
    with pytest.raises(ValueError):
        groups.BatchRule(10, num_substeps=4)


def test_group_queries_reach_every_status(spark):
    q = E.queries()
    assert {r.status for r in q["stream_group_batches"](spark, SF_SMALL).select("status").distinct().collect()} == {"train", "requeue", "expired"}
    kinds = {tuple(r) for r in q["stream_minibatches"](spark, SF_SMALL).select("rule", "status").distinct().collect()}
    assert kinds == {("placeholders", "train"), ("filtered", "train"), ("filtered", "requeue")}


def test_lane_rows_leave_in_blocks():
    """A micro-batch of one lane in several frames, out of order: what leaves comes in bounded frames, as from one sorted pass."""
    r = random.Random(4)
    rows = [(i, r.randrange(500), r.random() < 0.8, 0) for i in range(1000)]
    frames = [pd.DataFrame(rows[a : a + 130], columns=["group_id", "arrival_us", "usable", "sampler_step"]) for a in range(0, 1000, 130)]
    rule = groups.BatchRule(4)
    lane = groups._Lane("r", 0, rule, None)
    out = [*lane.pass_rows(iter(frames), block=100), lane.taken()]
    assert max(len(f) for f in out) < 200 and len(out) > 4
    want = [g for g, _, ok, _ in sorted(rows, key=lambda x: (x[1], x[0])) if ok]
    assert pd.concat(out)["group_id"].tolist() == want[: len(want) // 4 * 4] and lane.ids == want[len(want) // 4 * 4 :]
