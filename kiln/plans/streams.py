"""Streaming queries on ``events``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators.ranking import range_rank
from kiln.plans.registry import REGISTRY, query
from kiln.sources.tables import table
from kiln.streaming import batches, groups, replay, shuffle_buffer, trace


def _event_stream(spark, sf_dir, by_file=True):
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema)
    if by_file:
        stream = stream.option("maxFilesPerTrigger", 1)
    if any(f.rstrip("/").endswith("/events.parquet") for f in spark.read.parquet(path).inputFiles()):
        # one file: the source watches its folder, filtered to it
        s = stream.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    else:
        s = stream.parquet(path)
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_fixed_batches", "K1 D7", """
WITH r AS (SELECT event_id, value, row_number() OVER (ORDER BY md5('0:' || event_id), event_id) AS p FROM events),
n AS (SELECT count(*) AS n FROM events)
SELECT CAST(floor((p - 1) / 256) AS BIGINT) AS batch_idx, count(*) AS n_rows, round(sum(value), 6) AS value_sum,
       CAST(min(p) AS BIGINT) AS first_pos
FROM r, n WHERE floor((p - 1) / 256) < n.n // 256 GROUP BY 1
""")
def stream_fixed_batches(spark, sf_dir):
    """K1: events streamed through foreachBatch into shuffled fixed batches of 256 (drop last).

    The shuffle is over all events that are there when the query starts (one micro-batch), so it doesn't depend on
    how the table is cut into files."""
    out = batches.run_count_batches(_event_stream(spark, sf_dir, by_file=False).select("event_id", "value"), 256, "event_id")
    rows = batches.read_batches(spark, out, 256, drop_last=True)
    return rows.groupBy("batch_idx").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("value_sum"),
                                         F.min("position").alias("first_pos"))


@query("stream_staleness", "K3", """
SELECT CASE WHEN 20 - day(ts) > 5 THEN 'requeue' ELSE 'fresh' END AS sink, count(*) AS n_rows, round(sum(value), 6) AS value_sum
FROM events GROUP BY 1
""")
def stream_staleness(spark, sf_dir):
    """K3: sampler step = day of month, current step 20, max 5 steps off policy; stale rows requeued."""
    s = _event_stream(spark, sf_dir).select("event_id", "value", F.dayofmonth("ts").alias("sampler_step"))
    out = batches.run_staleness_filter(s, 20, 5)
    fresh = spark.read.parquet(f"{out}/fresh").withColumn("sink", F.lit("fresh"))
    req = spark.read.parquet(f"{out}/requeue").withColumn("sink", F.lit("requeue"))
    return fresh.unionByName(req).groupBy("sink").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("value"), 6).alias("value_sum"))


@query("stream_step_metrics", "K6", """
SELECT CAST(day(ts) AS BIGINT) AS step, count(*) AS n, round(sum(value), 6) AS value_sum, round(avg(value), 6) AS value_mean
FROM events GROUP BY 1
""")
def stream_step_metrics(spark, sf_dir):
    """K6: running per-step (day) metrics as an update-mode streaming aggregation."""
    s = _event_stream(spark, sf_dir).select(F.dayofmonth("ts").cast("long").alias("step"), "value")
    out = batches.run_step_metrics(s, "step", "value")
    m = batches.read_step_metrics(spark, out, "step")
    return m.select("step", "n", F.round("value_sum", 6).alias("value_sum"), F.round("value_mean", 6).alias("value_mean"))


TRACE_SQL = """
e AS (
  SELECT user_id AS track, event_id, ts, event_type AS name,
         CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) % 4 IN (1, 2) THEN 'B' ELSE 'E' END AS ph
  FROM events)
"""


def _trace_events(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rn = F.row_number().over(w)
    return ev.select(F.col("user_id").alias("track"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_type").alias("name"),
                     F.when((rn % 4 == 1) | (rn % 4 == 2), F.lit("B")).otherwise(F.lit("E")).alias("ph"))


@query("trace_spans", "W4 J11", f"""
WITH {TRACE_SQL},
d AS (SELECT *, sum(CASE WHEN ph = 'B' THEN 1 ELSE -1 END) OVER (PARTITION BY track ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d FROM e),
l AS (SELECT *, CASE WHEN ph = 'B' THEN d ELSE d + 1 END AS level FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY track, level, ph ORDER BY ts, event_id) AS k FROM l)
SELECT b.track, b.name, CAST(b.level AS BIGINT) AS depth, b.event_id AS begin_id, x.event_id AS end_id,
       CAST(epoch_us(x.ts) - epoch_us(b.ts) AS BIGINT) AS duration_us
FROM k b JOIN k x ON b.track = x.track AND b.level = x.level AND b.k = x.k AND b.ph = 'B' AND x.ph = 'E'
WHERE b.level >= 1
""")
def trace_spans(spark, sf_dir):
    """Nested begin/end pairing per track (B B E E pattern per user)."""
    s = trace.pair_spans(_trace_events(spark, sf_dir))
    dur = (F.unix_micros("end_ts") - F.unix_micros("begin_ts")).cast("long")
    return s.select("track", "name", "depth", "begin_id", "end_id", dur.alias("duration_us"))


@query("stream_trace_spans", "K5", REGISTRY["trace_spans"].sql)
def stream_trace_spans(spark, sf_dir):
    """K5 on a stream: events arrive up to two hours late in three runs of the query; equals ``trace_spans``."""
    ev = _trace_events(spark, sf_dir)
    late = F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 4), 16, 10).cast("long") % 7200
    ev = ev.withColumn("_at", F.unix_micros("ts") + late * 1_000_000)
    out = batches.scratch_dir(spark, "trace-spans")
    # a heartbeat on a track of its own moves the watermark past the last events
    beat = ev.agg(F.max("ts").alias("ts")).select(
        F.lit(-1).cast("long").alias("track"), F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
        F.lit("").alias("name"), F.lit("M").alias("ph"))
    parts = [p.drop("_at") for p in replay.slices(ev, "_at", 3)]
    replay.feed([*parts, beat], lambda s: trace.stream_spans(s, "3 hours"), out)
    s = replay.rows(spark, out, trace.SPAN_SCHEMA)
    dur = (F.unix_micros("end_ts") - F.unix_micros("begin_ts")).cast("long")
    return s.select("track", "name", "depth", "begin_id", "end_id", dur.alias("duration_us"))


@query("trace_metadata", "K5", """
WITH e AS (SELECT user_id * 7919 + 11 AS pid, event_type AS tid, event_id, ts, CASE WHEN event_type IN ('signup', 'view') THEN 'M' ELSE 'B' END AS ph FROM events),
f AS (SELECT pid, row_number() OVER (ORDER BY min((ts, event_id)), pid) - 1 AS track FROM e GROUP BY pid),
m AS (SELECT pid, tid, arg_min(event_id, (ts, event_id)) AS first_id, count(*) AS n FROM e WHERE ph = 'M' GROUP BY pid, tid)
SELECT CAST(track AS BIGINT) AS track, tid, first_id FROM m JOIN f USING (pid)
""")
def trace_metadata(spark, sf_dir):
    """K5: the first metadata event of each (pid, tid), pids renumbered densely by first appearance among all events."""
    ev = table(spark, sf_dir, "events").select(
        (F.col("user_id") * 7919 + 11).alias("pid"), F.col("event_type").alias("tid"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type").isin("signup", "view"), "M").otherwise("B").alias("ph"))
    ids = trace.dense_ids(ev, "pid", ["ts", "event_id"], "track")
    return trace.first_metadata(ev, ["pid", "tid"]).join(ids, "pid").select("track", "tid", F.col("event_id").alias("first_id"))


SHUFFLE_SIZE, SHUFFLE_BATCH = 256, 64


@query("stream_buffer_shuffle", "K1", f"""
WITH p AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS p, count(*) OVER () AS n FROM events),
z AS (SELECT *, least({SHUFFLE_SIZE}, n) AS m FROM p),
s AS (SELECT *, CASE WHEN p < m THEN p ELSE ('0x' || substr(md5('0:' || p), 1, 8))::BIGINT % m END AS slot FROM z),
l AS (SELECT *, lead(p) OVER (PARTITION BY slot ORDER BY p) - m AS out FROM s),
e AS (SELECT *, coalesce(out, n - m + row_number() OVER (PARTITION BY out IS NULL ORDER BY md5('0:end:' || slot), slot) - 1) AS place FROM l)
SELECT CAST(place // {SHUFFLE_BATCH} AS BIGINT) AS batch_idx, CAST(place % {SHUFFLE_BATCH} AS BIGINT) AS in_batch, event_id, value
FROM e WHERE place < n // {SHUFFLE_BATCH} * {SHUFFLE_BATCH}
""")
def stream_buffer_shuffle(spark, sf_dir):
    """K1: events pass a shuffle buffer of 256 rows in three runs; batches of 64 in sequence, the declared length checked, drop last."""
    ev = table(spark, sf_dir, "events").select("event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    placed = range_rank(ev, ["ts", "event_id"], "rank").withColumn("position", F.col("rank") - 1)
    parts = replay.slices(placed.select("position"), "position", 3)
    out = batches.scratch_dir(spark, "buffer-shuffle")
    shuffled = shuffle_buffer.run_buffer_shuffle(parts, placed.count(), SHUFFLE_BATCH, out, SHUFFLE_SIZE)
    found = shuffled.all().join(placed.select("position", "event_id", "value"), "position")
    return found.select("batch_idx", F.pmod("place", F.lit(SHUFFLE_BATCH)).alias("in_batch"), "event_id", "value")


LANES, DELAY_MS = 4, 600_000


def _group_sql(name: str, rule: groups.BatchRule, sampler: str) -> str:
    """The rules of one lane's buffer, row by row."""
    size, per_step = rule.groups_per_minibatch, rule.num_substeps * rule.num_minibatches
    gap = f"(r.n > 0 AND g.us - r.last_us > {rule.gap_seconds * 1_000_000})" if rule.gap_seconds is not None else "false"
    stale = f"(g.usable AND r.done // {per_step} - g.sampler > {rule.max_steps_off_policy})" if rule.max_steps_off_policy is not None else "false"
    n0 = f"CASE WHEN {gap} THEN 0 ELSE r.n END"
    gen0 = f"CASE WHEN {gap} THEN r.gen + 1 ELSE r.gen END"
    full = f"({n0} + 1 = {size} AND NOT {stale})"
    due = f"last.last_us // 1000 + {rule.gap_seconds * 1000} < (SELECT max(us) // 1000 - {DELAY_MS} FROM all_groups)" if rule.gap_seconds is not None else "false"
    return f"""
SELECT rule, lane, status, step, substep, minibatch, position, group_id FROM (
WITH RECURSIVE all_groups AS (
  SELECT event_id AS group_id, epoch_us(ts) AS us, event_type <> 'error' AS usable, {sampler} AS sampler,
         ('0x' || substr(md5('lane:' || event_id), 1, 8))::BIGINT % {LANES} AS lane FROM events),
g AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lane ORDER BY us, group_id) AS rn FROM all_groups {"" if rule.placeholders else "WHERE usable"}),
r AS (
  SELECT DISTINCT lane, 0::BIGINT AS rn, NULL::BIGINT AS group_id, false AS usable, 0::BIGINT AS done, 0::BIGINT AS n, 0::BIGINT AS gen, 0::BIGINT AS last_us,
         'start' AS kind, 0::BIGINT AS at_done, 0::BIGINT AS at_gen FROM g
  UNION ALL
  SELECT g.lane, g.rn, g.group_id, g.usable, r.done + CASE WHEN {full} THEN 1 ELSE 0 END,
         CASE WHEN {stale} THEN {n0} WHEN {full} THEN 0 ELSE {n0} + 1 END, {gen0} + CASE WHEN {full} THEN 1 ELSE 0 END,
         CASE WHEN {stale} THEN r.last_us ELSE g.us END, CASE WHEN {stale} THEN 'requeue' ELSE 'in' END, r.done, {gen0}
  FROM r JOIN g ON g.lane = r.lane AND g.rn = r.rn + 1),
last AS (SELECT lane, arg_max(gen, rn) AS gen, arg_max(last_us, rn) AS last_us FROM r GROUP BY lane),
c AS (SELECT lane, at_gen, count(*) AS n FROM r WHERE kind = 'in' GROUP BY 1, 2),
o AS (
  SELECT r.lane, group_id, at_done, CASE WHEN c.n = {size} THEN 'train' WHEN r.at_gen < last.gen OR {due} THEN 'expired' END AS status,
         row_number() OVER (PARTITION BY r.lane, r.at_gen ORDER BY rn) - 1 AS position
  FROM r JOIN c ON r.lane = c.lane AND r.at_gen = c.at_gen JOIN last ON r.lane = last.lane WHERE kind = 'in' AND usable
  UNION ALL SELECT lane, group_id, at_done, 'requeue', 0 FROM r WHERE kind = 'requeue')
SELECT '{name}' AS rule, lane, status, CAST(at_done // {per_step} AS BIGINT) AS step, CAST(at_done % {per_step} // {rule.num_minibatches} AS INTEGER) AS substep,
       CAST(at_done % {rule.num_minibatches} AS INTEGER) AS minibatch, CAST(position AS INTEGER) AS position, group_id FROM o WHERE status IS NOT NULL)
"""


def _run_groups(spark, sf_dir, rules: dict[str, groups.BatchRule], sampler):
    ev = table(spark, sf_dir, "events")
    lane = F.conv(F.substring(F.md5(F.concat(F.lit("lane:"), F.col("event_id").cast("string"))), 1, 8), 16, 10).cast("long") % LANES
    g = ev.select(lane.alias("lane"), F.col("event_id").alias("group_id"), F.col("ts").cast("timestamp").alias("arrival"),
                  (F.col("event_type") != "error").alias("usable"), sampler.alias("sampler_step"))
    out = batches.scratch_dir(spark, "group-batches")
    parts = [p.drop("_at") for p in replay.slices(g.withColumn("_at", F.unix_micros("arrival")), "_at", 3)]
    replay.feed(parts, lambda s: groups.batch_groups(s, rules, f"{DELAY_MS} milliseconds"), out)
    return replay.rows(spark, out, groups.ROWS)


def _sampler(batch: int):
    """The step a group was sampled at: about the lane's step, up to 7 steps older."""
    lag = F.regexp_extract("props", "[0-9]+", 0).cast("long") % 8
    return F.floor(F.col("event_id") * 6 / (40 * batch)) - lag


def _sampler_sql(batch: int) -> str:
    return f"CAST(floor(event_id * 6 / {40 * batch}) AS BIGINT) - regexp_extract(props, '[0-9]+')::BIGINT % 8"


BATCH_RULES = {"batch": groups.BatchRule(4, max_steps_off_policy=5, gap_seconds=7200)}
MINIBATCH_RULES = {
    "placeholders": groups.BatchRule(8, num_substeps=2, num_minibatches=2, placeholders=True),
    "filtered": groups.BatchRule(8, num_substeps=2, num_minibatches=2, max_steps_off_policy=5),
}


@query("stream_group_batches", "K2 K3", " UNION ALL ".join(_group_sql(n, r, _sampler_sql(4)) for n, r in BATCH_RULES.items()))
def stream_group_batches(spark, sf_dir):
    """K2: batches of exactly 4 usable groups a lane from a stream in three runs; stale groups requeued, idle buffers expire."""
    return _run_groups(spark, sf_dir, BATCH_RULES, _sampler(4))


@query("stream_minibatches", "K4 D24", " UNION ALL ".join(_group_sql(n, r, _sampler_sql(8)) for n, r in MINIBATCH_RULES.items()))
def stream_minibatches(spark, sf_dir):
    """K4: minibatches of 2 groups (8 a step, 2 substeps of 2), place-holders counted and removed, or skipped with stale groups."""
    return _run_groups(spark, sf_dir, MINIBATCH_RULES, _sampler(8))
