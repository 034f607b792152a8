"""RL rollout queries on ``orders ⋈ lineitem`` (A*) and token rows from ``lineitem`` (L*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import joins
from kiln.operators import rollouts as ro
from kiln.operators import tokens as tk
from kiln.plans.registry import query
from kiln.sources import tables as tb


def r6(c):
    return F.round(c, 6)


T_CTE = """
t AS (
  SELECT o.o_custkey AS group_id, o.o_orderkey AS traj_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS step,
         l_discount + 0.0 AS reward, CAST(l_quantity AS BIGINT) AS ob_len, CAST(l_linenumber AS BIGINT) AS ac_len,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS m_format,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS m_correct
  FROM lineitem JOIN orders o ON l_orderkey = o.o_orderkey),
tr AS (
  SELECT o_custkey AS group_id, o_orderkey AS traj_id,
         CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END AS final_reward,
         CAST(month(o_orderdate) AS BIGINT) AS sampler_step, o_orderpriority, o_totalprice
  FROM orders),
tot AS (
  SELECT tr.group_id, tr.traj_id, coalesce(s.sr, 0.0) + tr.final_reward AS total_reward, coalesce(s.n, 0) AS n_steps
  FROM tr LEFT JOIN (SELECT group_id, traj_id, sum(reward) AS sr, count(*) AS n FROM t GROUP BY 1, 2) s
  ON tr.group_id = s.group_id AND tr.traj_id = s.traj_id),
gs AS (
  SELECT group_id, avg(total_reward) AS group_mean, min(total_reward) AS group_min, max(total_reward) AS group_max,
         count(*) AS group_size FROM tot GROUP BY group_id)
"""


def _totals(spark, sf_dir):
    return ro.total_rewards(tb.steps(spark, sf_dir), tb.trajectories(spark, sf_dir))


@query("total_rewards", "A1", f"""
WITH {T_CTE}
SELECT group_id, traj_id, round(total_reward, 6) AS total_reward, CAST(n_steps AS BIGINT) AS n_steps FROM tot
""")
def total_rewards(spark, sf_dir):
    """A1: Σ step rewards + final reward per trajectory (trajectories without steps kept)."""
    return _totals(spark, sf_dir).withColumn("total_reward", r6(F.col("total_reward")))


@query("group_advantages", "A2 W2", f"""
WITH {T_CTE}
SELECT tot.group_id, traj_id, round(total_reward - group_mean, 6) AS advantage
FROM tot JOIN gs ON tot.group_id = gs.group_id
""")
def group_advantages(spark, sf_dir):
    """A2: group-centred advantages (no std division)."""
    return ro.advantages(_totals(spark, sf_dir)).select("group_id", "traj_id", r6(F.col("advantage")).alias("advantage"))


@query("constant_groups_removed", "A3", f"""
WITH {T_CTE},
flags AS (SELECT max(CASE WHEN group_min <> group_max THEN 1 ELSE 0 END) AS v, min(group_id) AS g0 FROM gs)
SELECT tot.group_id, traj_id
FROM tot JOIN gs ON tot.group_id = gs.group_id, flags
WHERE group_min <> group_max OR (flags.v = 0 AND tot.group_id = flags.g0)
""")
def constant_groups_removed(spark, sf_dir):
    """A3: drop constant-reward groups (all constant → keep the first group)."""
    adv = ro.advantages(_totals(spark, sf_dir))
    return ro.drop_constant_groups(adv).select("group_id", "traj_id")


@query("zero_advantage_removed", "A4", f"""
WITH {T_CTE},
adv AS (SELECT tot.group_id, traj_id, total_reward - group_mean AS advantage FROM tot JOIN gs ON tot.group_id = gs.group_id)
SELECT group_id, traj_id FROM adv
WHERE group_id IN (SELECT group_id FROM adv GROUP BY group_id HAVING max(abs(advantage)) > 0)
""")
def zero_advantage_removed(spark, sf_dir):
    """A4: skip groups whose advantages are all exactly zero."""
    return ro.drop_zero_advantage_groups(ro.advantages(_totals(spark, sf_dir))).select("group_id", "traj_id")


@query("group_fractions", "A5", f"""
WITH {T_CTE}
SELECT round(avg(CASE WHEN group_min <> group_max THEN 1.0 ELSE 0.0 END), 6) AS frac_mixed,
       round(avg(CASE WHEN group_min = group_max AND group_min >= 0.5 THEN 1.0 ELSE 0.0 END), 6) AS frac_all_good,
       round(avg(CASE WHEN group_min = group_max AND group_min < 0.5 THEN 1.0 ELSE 0.0 END), 6) AS frac_all_bad
FROM gs
""")
def group_fractions(spark, sf_dir):
    """A5: fractions of mixed / all-good / all-bad groups."""
    f = ro.group_outcome_fractions(ro.group_stats(_totals(spark, sf_dir)))
    return f.select(*[r6(F.col(c)).alias(c) for c in f.columns])


@query("trajectory_metrics", "A6", f"""
WITH {T_CTE}
SELECT round(sum(ac_len) / count(*), 6) AS ac_tokens_per_turn, round(sum(ob_len) / count(*), 6) AS ob_tokens_per_turn,
       round(count(*) / (SELECT count(*) FROM tot), 6) AS turns_per_episode,
       (SELECT count(*) FROM tot) AS total_episodes, count(*) AS total_turns,
       CAST(sum(ac_len) AS BIGINT) AS total_ac_tokens, CAST(sum(ob_len) AS BIGINT) AS total_ob_tokens,
       round((SELECT avg(total_reward) FROM tot), 6) AS reward_total_mean
FROM t
""")
def trajectory_metrics(spark, sf_dir):
    """Token / turn / episode totals and ratios of sums."""
    m = ro.trajectory_metrics(tb.steps(spark, sf_dir), _totals(spark, sf_dir))
    return m.select(*[r6(F.col(c)).alias(c) if c not in ("total_episodes", "total_turns", "total_ac_tokens", "total_ob_tokens") else F.col(c) for c in m.columns])


@query("metric_means", "A7", f"""
WITH {T_CTE}
SELECT 'format' AS key, round(avg(m_format), 6) AS value FROM t
UNION ALL SELECT 'correct', round(avg(m_correct), 6) FROM t WHERE m_correct IS NOT NULL
UNION ALL SELECT 'final', round(avg(final_reward), 6) FROM tr
""")
def metric_means(spark, sf_dir):
    """Mean per key over only the dicts having it; step + trajectory metrics pooled."""
    steps = tb.steps(spark, sf_dir).select("metrics")
    trajs = tb.trajectories(spark, sf_dir).select(F.create_map(F.lit("final"), F.col("final_reward")).alias("metrics"))
    return ro.metric_means(steps, trajs).select("key", r6(F.col("value")).alias("value"))


@query("metrics_by_tag", "A8", f"""
WITH {T_CTE},
pg AS (
  SELECT gs.group_id, gs.group_mean AS reward_mean, CAST(gs.group_size AS DOUBLE) AS group_size,
         (SELECT arg_min(o_orderpriority, o_orderkey) FROM orders o WHERE o.o_custkey = gs.group_id) AS prio
  FROM gs),
tags AS (SELECT 'all_orders' AS tag, reward_mean, group_size FROM pg UNION ALL SELECT prio, reward_mean, group_size FROM pg),
ta AS (SELECT tag, count(*) AS n, avg(reward_mean) AS reward_mean, avg(group_size) AS group_size FROM tags GROUP BY tag),
gate AS (SELECT min(n) < (SELECT count(*) FROM pg) AS on_ FROM ta),
blk AS (
  SELECT tag, reward_mean, group_size FROM ta, gate WHERE gate.on_
  UNION ALL SELECT 'all', avg(reward_mean), avg(group_size) FROM pg)
SELECT 'env/' || tag || '/reward_mean' AS key, round(reward_mean, 6) AS value FROM blk
UNION ALL SELECT 'env/' || tag || '/group_size', round(group_size, 6) FROM blk
""")
def metrics_by_tag(spark, sf_dir):
    """Per-tag blocks (tags = all_orders + priority of the group's first order) and env/all."""
    stats = ro.group_stats(_totals(spark, sf_dir))
    first_prio = tb.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderpriority", "o_orderkey").alias("prio")
    )
    pg = stats.join(first_prio, stats.group_id == first_prio.o_custkey).select(
        "group_id", F.col("group_mean").alias("reward_mean"), F.col("group_size").cast("double").alias("group_size"),
        F.array(F.lit("all_orders"), F.col("prio")).alias("tags"),
    )
    return ro.metrics_by_tag(pg, F.col("tags"), ["reward_mean", "group_size"]).select("key", r6(F.col("value")).alias("value"))


@query("metric_set", "A5 A6 A7 A8", f"""
WITH {T_CTE},
first AS (SELECT o_custkey AS group_id, arg_min(o_orderpriority, o_orderkey) AS prio FROM orders GROUP BY 1),
tags AS (SELECT group_id, unnest(['all_orders', prio]) AS tag FROM first UNION ALL SELECT group_id, 'all' FROM first),
n AS (SELECT tag, count(*) AS n FROM tags GROUP BY tag),
used AS (SELECT tag FROM n WHERE tag = 'all' OR (SELECT min(n) FROM n WHERE tag <> 'all') < (SELECT n FROM n WHERE tag = 'all')),
st AS (
  SELECT tag, sum(ac_len) AS ac, sum(ob_len) AS ob, count(*) AS turns, avg(m_format) AS format, avg(m_correct) AS correct
  FROM t JOIN tags USING (group_id) GROUP BY tag),
ep AS (
  SELECT tag, count(*) AS episodes, avg(total_reward) AS reward, avg(final_reward) AS final
  FROM tot JOIN tr USING (group_id, traj_id) JOIN tags USING (group_id) GROUP BY tag),
bg AS (
  SELECT tag, avg(CASE WHEN group_min <> group_max THEN 1.0 ELSE 0.0 END) AS mixed, avg(CASE WHEN group_min = group_max AND group_min >= 0.5 THEN 1.0 ELSE 0.0 END) AS good,
         avg(CASE WHEN group_min = group_max AND group_min < 0.5 THEN 1.0 ELSE 0.0 END) AS bad FROM gs JOIN tags USING (group_id) GROUP BY tag),
w AS (SELECT * FROM used JOIN st USING (tag) JOIN ep USING (tag) JOIN bg USING (tag)),
l AS (
  SELECT tag, 'ac_tokens_per_turn' AS k, ac / turns AS v FROM w UNION ALL SELECT tag, 'ob_tokens_per_turn', ob / turns FROM w
  UNION ALL SELECT tag, 'turns_per_episode', turns / episodes FROM w UNION ALL SELECT tag, 'total_episodes', episodes FROM w
  UNION ALL SELECT tag, 'total_turns', turns FROM w UNION ALL SELECT tag, 'total_ac_tokens', ac FROM w UNION ALL SELECT tag, 'total_ob_tokens', ob FROM w
  UNION ALL SELECT tag, 'reward/total', reward FROM w UNION ALL SELECT tag, 'format', format FROM w UNION ALL SELECT tag, 'correct', correct FROM w
  UNION ALL SELECT tag, 'final', final FROM w UNION ALL SELECT tag, 'by_group/frac_mixed', mixed FROM w
  UNION ALL SELECT tag, 'by_group/frac_all_good', good FROM w UNION ALL SELECT tag, 'by_group/frac_all_bad', bad FROM w)
SELECT 'env/' || tag || '/' || k AS key, round(CAST(v AS DOUBLE), 6) AS value FROM l
""")
def metric_set(spark, sf_dir):
    """The whole metric set per tag (all_orders, priority of the group's first order) and over all groups."""
    orders = tb.table(spark, sf_dir, "orders")
    trajs = tb.trajectories(spark, sf_dir).withColumn("metrics", F.create_map(F.lit("final"), F.col("final_reward")))
    tags = orders.groupBy(F.col("o_custkey").alias("group_id")).agg(F.min_by("o_orderpriority", "o_orderkey").alias("_p"))
    tags = tags.select("group_id", F.array(F.lit("all_orders"), F.col("_p")).alias("tags"))
    m = ro.metric_set(tb.steps(spark, sf_dir), trajs, tags)
    return m.select("key", r6(F.col("value")).alias("value"))


@query("step_table", "A13", f"""
WITH {T_CTE},
body AS (SELECT group_id, traj_id, CAST(step AS VARCHAR) AS step, reward FROM t
         UNION ALL SELECT group_id, traj_id, 'final', final_reward FROM tr)
SELECT group_id, traj_id, step, round(reward, 6) AS reward FROM body
UNION ALL SELECT group_id, traj_id, 'total', round(sum(reward), 6) FROM body GROUP BY 1, 2
""")
def step_table(spark, sf_dir):
    """Step rows + final row + per-trajectory total row."""
    s = ro.step_table(tb.transitions(spark, sf_dir), tb.trajectories(spark, sf_dir))
    return s.withColumn("reward", r6(F.col("reward")))


@query("two_level_mean", "A15", f"""
WITH {T_CTE}
SELECT round(avg(m), 6) AS mean_total_reward FROM (SELECT group_id, avg(total_reward) AS m FROM tot GROUP BY group_id)
""")
def two_level_mean(spark, sf_dir):
    """Mean reward per group, then over groups."""
    return ro.two_level_mean(_totals(spark, sf_dir), "group_id", "total_reward").select(
        r6(F.col("mean_total_reward")).alias("mean_total_reward")
    )


@query("accuracy_by_source", "A16", f"""
WITH {T_CTE},
sc AS (
  SELECT tr.traj_id, tr.o_orderpriority AS source, coalesce(l.s, 0.0) AS score
  FROM tr LEFT JOIN (SELECT traj_id, arg_max(coalesce(m_correct, 0.0), step) AS s FROM t GROUP BY traj_id) l ON tr.traj_id = l.traj_id)
SELECT source, CAST(sum(score) AS DOUBLE) AS correct, count(*) AS total, round(sum(score) / count(*), 6) AS accuracy
FROM sc GROUP BY source
UNION ALL SELECT 'OVERALL', CAST(sum(score) AS DOUBLE), count(*), round(sum(score) / count(*), 6) FROM sc
""")
def accuracy_by_source(spark, sf_dir):
    """Last-step `correct` per trajectory (default 0), accuracy per priority + OVERALL."""
    trajs = tb.trajectories(spark, sf_dir).select("traj_id", F.col("o_orderpriority").alias("source"))
    last = ro.last_step_score(tb.transitions(spark, sf_dir)).select("traj_id", "score")
    scores = trajs.join(last, "traj_id", "left").withColumn("score", F.coalesce(F.col("score"), F.lit(0.0)))
    return ro.accuracy_by_source(scores).withColumn("accuracy", r6(F.col("accuracy")))


@query("rollout_report", "A18", f"""
WITH {T_CTE}
SELECT round(avg(total_reward), 6) AS total_reward_mean, round(stddev_pop(total_reward), 6) AS total_reward_std,
       round(avg(n_steps), 6) AS n_steps_mean, round(stddev_pop(n_steps), 6) AS n_steps_std
FROM tot
""")
def rollout_report(spark, sf_dir):
    """Mean and population std of the reward and of a metric."""
    r = ro.rollout_report(_totals(spark, sf_dir), ["total_reward", "n_steps"])
    return r.select(*[r6(F.col(c)).alias(c) for c in r.columns])


@query("sampler_metrics", "A22", f"""
WITH {T_CTE}
SELECT CAST(max(sampler_step) AS DOUBLE) AS sampler_step_max, CAST(min(sampler_step) AS DOUBLE) AS sampler_step_min,
       round(avg(sampler_step), 6) AS sampler_step_mean,
       round(max(o_totalprice / 1000.0), 6) AS sample_time_max, round(min(o_totalprice / 1000.0), 6) AS sample_time_min,
       round(avg(o_totalprice / 1000.0), 6) AS sample_time_mean
FROM tr
""")
def sampler_metrics(spark, sf_dir):
    """Sampler step (order month) and sample time (price / 1000) max / min / mean."""
    g = tb.trajectories(spark, sf_dir).join(
        tb.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("traj_id"), (F.col("o_totalprice") / 1000.0).alias("sample_time")),
        "traj_id",
    )
    m = ro.sampler_metrics(g)
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


# ---------------------------------------------------------------------------
# Token-level numerics (L*).

TOK_CTE = """
tk AS (
  SELECT l_orderkey AS seq_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos,
         -10.0 * l_discount + 0.0 AS logp_sample, -10.0 * l_tax + 0.0 AS logp_train,
         CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS mask,
         CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS weight,
         l_suppkey % 3 AS dataset_idx, l_partkey AS token, l_orderkey AS trial
  FROM lineitem)
"""


def _tok(spark, sf_dir, numbered=False):
    return tb.token_rows(spark, sf_dir, numbered)


@query("mean_nll", "L1", f"""
WITH {TOK_CTE}
SELECT CAST(dataset_idx AS BIGINT) AS dataset_idx,
       round(CASE WHEN sum(weight) = 0 THEN 'NaN'::DOUBLE ELSE -sum(logp_sample * weight) / sum(weight) END, 6) AS mean_nll,
       round(sum(weight), 6) AS sum_weights
FROM tk GROUP BY dataset_idx
""")
def mean_nll(spark, sf_dir):
    """L1: weighted mean NLL per dataset."""
    m = tk.mean_nll(_tok(spark, sf_dir), "logp_sample", "weight", ["dataset_idx"])
    return m.select(F.col("dataset_idx").cast("long"), r6(F.col("mean_nll")).alias("mean_nll"), r6(F.col("sum_weights")).alias("sum_weights"))


@query("kl_sample_train", "L2", f"""
WITH {TOK_CTE}
SELECT round(avg(logp_sample - logp_train), 6) AS kl_sample_train_v1,
       round(0.5 * avg((logp_sample - logp_train) * (logp_sample - logp_train)), 6) AS kl_sample_train_v2,
       round(-avg(logp_sample), 6) AS entropy, count(*) AS n_action_tokens
FROM tk WHERE mask > 0
""")
def kl_sample_train(spark, sf_dir):
    """L2: sample-vs-train KL and entropy over action tokens."""
    m = tk.kl_sample_train(_tok(spark, sf_dir), "logp_sample", "logp_train", "mask")
    return m.select(*[r6(F.col(c)).alias(c) if c != "n_action_tokens" else F.col(c) for c in m.columns])


@query("kl_penalty", "L4", f"""
WITH {TOK_CTE},
a AS (SELECT sum((logp_sample - logp_train) * mask) / sum(mask) AS avg_d FROM tk)
SELECT seq_id, CAST(pos AS BIGINT) AS pos,
       round(0.05 * mask * (a.avg_d - (logp_sample - logp_train) * mask), 6) AS advantage
FROM tk, a
""")
def kl_penalty(spark, sf_dir):
    """L4: centred KL penalty added to advantages (coef 0.05, base = training logprobs)."""
    r = tk.kl_penalty(_tok(spark, sf_dir).withColumn("advantage", F.lit(0.0)), "logp_sample", "logp_train", "mask", 0.05)
    return r.select("seq_id", "pos", r6(F.col("advantage")).alias("advantage"))


@query("teacher_kl", "L5", f"""
WITH {TOK_CTE}
SELECT CAST(dataset_idx AS VARCHAR) AS scope, round(sum((logp_sample - logp_train) * mask) / sum(mask), 6) AS teacher_kl
FROM tk GROUP BY dataset_idx HAVING sum(mask) > 0
UNION ALL SELECT 'all', round(sum((logp_sample - logp_train) * mask) / sum(mask), 6) FROM tk
""")
def teacher_kl(spark, sf_dir):
    """Reverse KL vs a per-dataset teacher (teacher = training logprobs), per dataset + batch."""
    _, m = tk.teacher_kl(_tok(spark, sf_dir), "logp_sample", "logp_train", "mask", 1.0)
    return m.select("scope", r6(F.col("teacher_kl")).alias("teacher_kl"))


@query("discounted_returns", "L6 W7", f"""
WITH RECURSIVE {TOK_CTE},
mx AS (SELECT seq_id, max(pos) AS n FROM tk GROUP BY seq_id),
r(seq_id, pos, y) AS (
  SELECT tk.seq_id, tk.pos, tk.logp_sample + 0.9 * 0.0 FROM tk JOIN mx ON tk.seq_id = mx.seq_id AND tk.pos = mx.n
  UNION ALL
  SELECT tk.seq_id, tk.pos, tk.logp_sample + 0.9 * r.y FROM r JOIN tk ON tk.seq_id = r.seq_id AND tk.pos = r.pos - 1)
SELECT seq_id, CAST(pos AS BIGINT) AS pos, round(y, 6) AS ret FROM r
""")
def discounted_returns(spark, sf_dir):
    """Discounted future sums (γ = 0.9) of per-token values within each sequence, by blocks of positions."""
    d = tk.discounted_rows(_tok(spark, sf_dir, True).select("seq_id", "pos", "logp_sample"), ["seq_id"], "pos", "logp_sample", 0.9, "ret")
    return d.select("seq_id", F.col("pos").cast("long").alias("pos"), r6(F.col("ret")).alias("ret"))


@query("kl_penalty_discounted", "L4 L6", f"""
WITH RECURSIVE {TOK_CTE},
a AS (SELECT sum((logp_sample - logp_train) * mask) / sum(mask) AS avg_d FROM tk),
k AS (SELECT seq_id, pos, 0.05 * mask * (a.avg_d - (logp_sample - logp_train) * mask) AS x FROM tk, a),
mx AS (SELECT seq_id, max(pos) AS n FROM k GROUP BY seq_id),
r(seq_id, pos, y) AS (
  SELECT k.seq_id, k.pos, k.x FROM k JOIN mx ON k.seq_id = mx.seq_id AND k.pos = mx.n
  UNION ALL SELECT k.seq_id, k.pos, k.x + 0.7 * r.y FROM r JOIN k ON k.seq_id = r.seq_id AND k.pos = r.pos - 1)
SELECT seq_id, CAST(pos AS BIGINT) AS pos, round(1.0 + y, 6) AS advantage FROM r
""")
def kl_penalty_discounted(spark, sf_dir):
    """L4 with a discount: each token's advantage takes the discounted KL penalties of the rest of its sequence."""
    t = _tok(spark, sf_dir, True).withColumn("advantage", F.lit(1.0))
    r = tk.kl_penalty(t, "logp_sample", "logp_train", "mask", 0.05, discount=0.7)
    return r.select("seq_id", F.col("pos").cast("long").alias("pos"), r6(F.col("advantage")).alias("advantage"))


@query("kl_pre_post", "L3 J4", f"""
WITH {TOK_CTE}
SELECT round(avg(p.logp_sample - q.logp_train), 6) AS kl_pre_post_v1,
       round(0.5 * avg(pow(p.logp_sample - q.logp_train, 2)), 6) AS kl_pre_post_v2
FROM tk p JOIN tk q ON p.seq_id = q.seq_id AND q.pos = p.pos + 1 WHERE p.mask > 0
""")
def kl_pre_post(spark, sf_dir):
    """L3: logged logprobs of the shifted targets against new logprobs of the whole sequence (first token: none)."""
    t = _tok(spark, sf_dir, True)
    last = F.max("pos").over(Window.partitionBy("seq_id"))
    datums = t.withColumn("_n", last).where(F.col("pos") < F.col("_n")).select("seq_id", (F.col("pos") - 1).alias("at"), F.col("logp_sample").alias("logprob"), "mask")
    post = t.select("seq_id", (F.col("pos") - 1).alias("position"), F.col("logp_train").alias("logprob"))
    m = tk.kl_pre_post(datums, post)
    return m.select(*[r6(F.col(c)).alias(c) for c in m.columns])


@query("dpo_metrics", "L7", f"""
WITH {TOK_CTE},
sd AS (SELECT seq_id, CASE WHEN pos % 2 = 1 THEN 'chosen' ELSE 'rejected' END AS side,
              sum(weight * (logp_sample - logp_train)) AS lr FROM tk GROUP BY 1, 2),
p AS (SELECT c.seq_id, c.lr AS c, r.lr AS r FROM sd c JOIN sd r ON c.seq_id = r.seq_id AND c.side = 'chosen' AND r.side = 'rejected'),
z AS (SELECT *, 0.1 * (c - r) AS z FROM p),
m AS (SELECT avg(CASE WHEN z > 0 THEN ln(1 + exp(-z)) ELSE -z + ln(1 + exp(z)) END) AS dpo_loss,
             avg(CASE WHEN c > r THEN 1.0 ELSE 0.0 END) AS accuracy, 0.1 * avg(c) AS chosen_reward, 0.1 * avg(r) AS rejected_reward,
             count(*) AS num_pairs FROM z)
SELECT round(dpo_loss, 6) AS dpo_loss, round(accuracy, 6) AS accuracy, round(chosen_reward, 6) AS chosen_reward,
       round(rejected_reward, 6) AS rejected_reward, num_pairs,
       round(0.1 * (chosen_reward - rejected_reward), 6) AS margin, round(chosen_reward - rejected_reward, 6) AS reward_margin
FROM m
""")
def dpo_metrics(spark, sf_dir):
    """DPO loss/accuracy/rewards/margin, β = 0.1; odd positions = chosen, even = rejected."""
    t = _tok(spark, sf_dir, True)
    sides = t.select(
        F.col("seq_id").alias("pair_id"),
        F.when(F.col("pos") % 2 == 1, "chosen").otherwise("rejected").alias("side"),
        (F.col("weight") * (F.col("logp_sample") - F.col("logp_train"))).alias("log_ratio"),
    )
    m = tk.dpo_metrics(sides, 0.1)
    return m.select(*[r6(F.col(c)).alias(c) if c != "num_pairs" else F.col(c) for c in m.columns])


@query("pairwise_ratio", "L9 L10 J7", f"""
WITH {TOK_CTE},
b AS (SELECT token, arg_min(logp_sample, (trial, logp_sample)) AS lp FROM tk GROUP BY 1),
tt AS (SELECT token, arg_min(logp_train, (trial, logp_train)) AS lp FROM tk GROUP BY 1),
j AS (SELECT b.token, tt.lp - b.lp / 2.0 AS a FROM b JOIN tt ON b.token = tt.token),
pr AS (SELECT abs(x.a - y.a) AS e FROM j x JOIN j y ON x.token < y.token)
SELECT round(avg(e), 6) AS mean_abs_err, round(max(e), 6) AS max_abs_err,
       (SELECT count(*) FROM j) AS n_tokens, count(*) AS n_pairs FROM pr
""")
def pairwise_ratio(spark, sf_dir):
    """L9 + L10: temperature check (τ = 2) over token pairs common to two first-seen tables."""
    t = _tok(spark, sf_dir)
    base = tk.first_seen(t.select("token", "trial" if "trial" in t.columns else F.col("seq_id").alias("trial"), F.col("logp_sample").alias("lp")), "token", "trial", "lp")
    temp = tk.first_seen(t.select("token", F.col("seq_id").alias("trial"), F.col("logp_train").alias("lp")), "token", "trial", "lp")
    m = tk.pairwise_ratio_metrics(base, temp, 2.0)
    return m.select(r6(F.col("mean_abs_err")).alias("mean_abs_err"), r6(F.col("max_abs_err")).alias("max_abs_err"), "n_tokens", "n_pairs")


@query("logprob_compare", "L11", f"""
WITH {TOK_CTE},
s AS (SELECT seq_id, count(*) AS n FROM tk GROUP BY seq_id),
c AS (SELECT tk.seq_id, abs(logp_sample - logp_train) AS d FROM tk JOIN s ON tk.seq_id = s.seq_id WHERE pos <= n - 1)
SELECT s.seq_id, round(CASE WHEN count(c.d) > 0 THEN avg(c.d) ELSE 'NaN'::DOUBLE END, 6) AS mean_abs_diff,
       round(CASE WHEN count(c.d) > 0 THEN max(c.d) ELSE 'NaN'::DOUBLE END, 6) AS max_abs_diff
FROM s LEFT JOIN c ON s.seq_id = c.seq_id GROUP BY s.seq_id
""")
def logprob_compare(spark, sf_dir):
    """Sampled (all positions) vs recomputed (all but last) logprob arrays per sequence."""
    t = _tok(spark, sf_dir, True)
    arr = t.groupBy("seq_id").agg(F.array_sort(F.collect_list(F.struct("pos", "logp_sample", "logp_train"))).alias("_s"))
    a = F.transform("_s", lambda s: s["logp_sample"])
    b = F.slice(F.transform("_s", lambda s: s["logp_train"]), 1, F.size("_s") - 1)
    mean, mx = tk.compare_logprob_arrays(a, b)
    return arr.select("seq_id", r6(mean).alias("mean_abs_diff"), r6(mx).alias("max_abs_diff"))


@query("mse_by_model", "L12", f"""
WITH {TOK_CTE}
SELECT CAST(dataset_idx AS BIGINT) AS model, round(avg(pow(logp_sample - logp_train, 2)), 6) AS mse_sample_train, count(*) AS n_tokens
FROM tk GROUP BY dataset_idx
""")
def mse_by_model(spark, sf_dir):
    """MSE of sampling vs training logprobs, one row per model (dataset index)."""
    m = tk.mse_by_model(_tok(spark, sf_dir).withColumnRenamed("dataset_idx", "model"), "model", "logp_sample", "logp_train")
    return m.select(F.col("model").cast("long"), r6(F.col("mse_sample_train")).alias("mse_sample_train"), "n_tokens")


def _logged_steps(spark, sf_dir):
    """Line items as steps of a log: each observation repeats what came before it, unless flag R starts over."""
    s = tb.numbered_items(spark, sf_dir).select("traj_id", "step", "l_suppkey", "l_partkey", "l_returnflag", "l_discount")
    w = Window.partitionBy("traj_id").orderBy("step")
    s = s.withColumn("_brk", ((F.col("step") == 1) | (F.col("l_returnflag") == "R")).cast("int"))
    s = s.withColumn("_d", F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wd = Window.partitionBy("traj_id", "_d").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.flatten(F.collect_list(F.array("l_suppkey", "l_partkey")).over(wd))
    return s.select("traj_id", "step", F.concat(prefix, F.array("l_suppkey")).alias("ob_tokens"), F.array("l_partkey").alias("ac_tokens"),
                    F.array(F.lit(-10.0) * F.col("l_discount") + F.lit(0.0)).alias("ac_logprobs"))


@query("prefix_merge_datums", "A9 W3", """
WITH s AS (
  SELECT l_orderkey AS traj_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS step,
         l_suppkey, l_partkey, l_returnflag FROM lineitem),
b AS (SELECT *, sum(CASE WHEN step = 1 OR l_returnflag = 'R' THEN 1 ELSE 0 END)
                OVER (PARTITION BY traj_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS datum_idx FROM s)
SELECT traj_id, CAST(datum_idx AS BIGINT) AS datum_idx, CAST(2 * count(*) AS BIGINT) AS n_tokens,
       md5(string_agg(l_suppkey || ',' || l_partkey, ',' ORDER BY step)) AS tokens_md5,
       repeat('01', CAST(count(*) AS BIGINT)) AS mask
FROM b GROUP BY traj_id, datum_idx
""")
def prefix_merge_datums(spark, sf_dir):
    """Multi-turn observations (prefix-extending unless flag R starts over) merged back into datums."""
    steps = _logged_steps(spark, sf_dir).drop("ac_logprobs")
    d = tk.prefix_merge(steps, ["traj_id"])
    return d.select(
        "traj_id", "datum_idx", F.size("tokens").cast("long").alias("n_tokens"),
        F.md5(F.array_join(F.transform("tokens", lambda x: x.cast("string")), ",")).alias("tokens_md5"),
        F.array_join(F.transform("mask", lambda x: x.cast("int").cast("string")), "").alias("mask"),
    )


def _e8(c: str) :
    """An array of doubles as text, in units of 1e-8."""
    return F.array_join(F.transform(c, lambda x: F.round(x * 1e8).cast("long").cast("string")), ",")


def _text(c: str) :
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


E8 = "list_transform({0}, lambda x: CAST(round(x * 1e8) AS BIGINT))"


@query("training_rows", "A2 A9 A10 J3 J4 W3", f"""
WITH {T_CTE},
s AS (
  SELECT l_orderkey AS traj_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS step,
         l_suppkey, l_partkey, l_returnflag, -10.0 * l_discount + 0.0 AS lp FROM lineitem),
b AS (SELECT *, sum(CASE WHEN step = 1 OR l_returnflag = 'R' THEN 1 ELSE 0 END)
                OVER (PARTITION BY traj_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS datum_idx FROM s),
d AS (
  SELECT traj_id, datum_idx, flatten(list([l_suppkey, l_partkey] ORDER BY step)) AS tok, flatten(list([0.0::DOUBLE, lp] ORDER BY step)) AS lp,
         flatten(list([0, 1] ORDER BY step)) AS mask FROM b GROUP BY 1, 2),
place AS (
  SELECT group_id, traj_id, dense_rank() OVER (ORDER BY group_id) - 1 AS group_idx, row_number() OVER (PARTITION BY group_id ORDER BY traj_id) - 1 AS traj_idx,
         total_reward - group_mean AS adv FROM tot JOIN gs USING (group_id))
SELECT CAST(group_idx AS BIGINT) AS group_idx, CAST(traj_idx AS BIGINT) AS traj_idx, CAST(datum_idx AS BIGINT) AS datum_idx,
       array_to_string(tok[:-2], ',') AS input_tokens, array_to_string(tok[2:], ',') AS target_tokens, array_to_string({E8.format("lp[2:]")}, ',') AS logprobs,
       array_to_string({E8.format("list_transform(mask[2:], lambda m: m * adv)")}, ',') AS advantages, array_to_string(mask[2:], '') AS mask
FROM d JOIN place USING (traj_id)
""")
def training_rows(spark, sf_dir):
    """A9 + A10: whole datums (inputs, targets, logprobs, advantages, mask) of all trajectories with group and trajectory numbers."""
    adv = ro.advantages(_totals(spark, sf_dir)).select("group_id", "traj_id", "advantage")
    d = tk.training_rows(_logged_steps(spark, sf_dir), adv)
    return d.select(
        "group_idx", "traj_idx", "datum_idx", _text("input_tokens").alias("input_tokens"), _text("target_tokens").alias("target_tokens"),
        _e8("logprobs").alias("logprobs"), _e8("advantages").alias("advantages"),
        F.array_join(F.transform("target_mask", lambda x: x.cast("int").cast("string")), "").alias("mask"),
    )


@query("single_turn_rows", "A4 A11", f"""
WITH {T_CTE},
adv AS (SELECT tot.group_id, traj_id, total_reward - group_mean AS adv FROM tot JOIN gs ON tot.group_id = gs.group_id),
kept AS (SELECT * FROM adv WHERE group_id IN (SELECT group_id FROM adv GROUP BY group_id HAVING max(abs(adv)) > 0)),
x AS (
  SELECT traj_id, list(l_partkey ORDER BY step) AS tok, list(lp ORDER BY step) AS lp FROM (
    SELECT l_orderkey AS traj_id, l_partkey, -10.0 * l_discount + 0.0 AS lp,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS step FROM lineitem) GROUP BY 1),
p AS (SELECT group_id, traj_id, adv, tok, lp, [group_id, group_id + 1, group_id + 2] AS prompt FROM kept JOIN x USING (traj_id))
SELECT traj_id, array_to_string(list_concat(prompt, tok)[:-2], ',') AS input_tokens, array_to_string(list_concat(prompt, tok)[2:], ',') AS target_tokens,
       array_to_string({E8.format("list_concat([0.0::DOUBLE, 0.0], lp)")}, ',') AS logprobs,
       array_to_string({E8.format("list_concat([0.0::DOUBLE, 0.0], list_transform(tok, lambda _: adv))")}, ',') AS advantages
FROM p
""")
def single_turn_rows(spark, sf_dir):
    """Prompt + sampled tokens of each order as one datum; groups whose advantages are all zero are skipped."""
    adv = ro.drop_zero_advantage_groups(ro.advantages(_totals(spark, sf_dir))).select("group_id", "traj_id", "advantage")
    t = _tok(spark, sf_dir, True).groupBy(F.col("seq_id").alias("traj_id")).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "logp_sample"))).alias("_s"))
    samples = adv.join(t, "traj_id").select(
        "traj_id", F.array(*[F.col("group_id") + k for k in range(3)]).alias("prompt_tokens"), F.transform("_s", lambda x: x["token"]).alias("tokens"),
        F.transform("_s", lambda x: x["logp_sample"]).alias("logprobs"), "advantage")
    d = tk.single_turn_rows(samples)
    return d.select("traj_id", _text("input_tokens").alias("input_tokens"), _text("target_tokens").alias("target_tokens"),
                    _e8("logprobs").alias("logprobs"), _e8("advantages").alias("advantages"))


@query("datum_teachers", "J3 J4", """
SELECT o_orderkey AS datum_id, o_custkey AS group_id, CAST(c_nationkey AS BIGINT) AS dataset_idx, r_name AS teacher, round(o_totalprice - n.total / n.n, 6) AS over_mean
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
JOIN (SELECT o_custkey AS g, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1) n ON n.g = o_custkey
""")
def datum_teachers(spark, sf_dir):
    """Datum → group → dataset → teacher, every step a checked lookup; J3: group sums and sizes joined one to one."""
    od = tb.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("datum_id"), F.col("o_custkey").alias("group_id"), "o_totalprice")
    groups = tb.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("group_id"), F.col("c_nationkey").cast("long").alias("dataset_idx"))
    datasets = tb.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("dataset_idx"), F.col("n_regionkey").alias("teacher_idx"))
    teachers = tb.table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("teacher_idx"), F.col("r_name").alias("teacher"))
    total = od.groupBy("group_id").agg(F.sum("o_totalprice").alias("total"))
    size = od.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"))
    d = joins.lookup(od, groups, ["group_id"], "groups")
    d = joins.lookup(d, datasets, ["dataset_idx"], "datasets")
    d = joins.lookup(d, teachers, ["teacher_idx"], "teachers")
    d = joins.lookup(d, joins.strict_join(total, size, ["group_id"], "group sums"), ["group_id"], "group sums")
    return d.select("datum_id", "group_id", "dataset_idx", "teacher", F.round(F.col("o_totalprice") - F.col("total") / F.col("n"), 6).alias("over_mean"))


@query("metric_logs", "A20 A24", """
WITH w AS (SELECT CAST(day(ts) AS BIGINT) AS step, avg(value) AS value_mean, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1),
l AS (SELECT step, 'value_mean' AS key, value_mean AS value FROM w UNION ALL SELECT step, 'n', n FROM w),
p AS (SELECT step, 'train/' || key AS key, value, 0 AS prio FROM l
      UNION ALL SELECT step, 'train/n', value * 2, 1 FROM l WHERE key = 'n')
SELECT step, key, round(arg_max(value, prio), 6) AS value FROM p GROUP BY step, key
""")
def metric_logs(spark, sf_dir):
    """A24 wide → long metric rows per step (day); A20 prefixing and merge where the later source wins."""
    ev = tb.table(spark, sf_dir, "events")
    wide = ev.groupBy(F.dayofmonth("ts").cast("long").alias("step")).agg(
        F.avg("value").alias("value_mean"), F.count(F.lit(1)).cast("double").alias("n"))
    long = ro.metrics_long(wide)
    first = ro.prefix_metrics(long, "train", 0)
    second = ro.prefix_metrics(long.filter(F.col("key") == "n").withColumn("value", F.col("value") * 2), "train", 1)
    return ro.merge_metrics(first, second).select("step", "key", r6(F.col("value")).alias("value"))


@query("compare_runs", "A23 J10", """
WITH a AS (SELECT CAST(day(ts) AS BIGINT) AS step, avg(value) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1),
b AS (SELECT CAST(day(ts) AS BIGINT) AS step, avg(value) AS v FROM events WHERE event_id % 2 = 1 GROUP BY 1)
SELECT a.step, round(abs(a.v - b.v) / greatest(abs(a.v), abs(b.v)), 6) AS rel_diff,
       abs(a.v - b.v) / greatest(abs(a.v), abs(b.v)) < 0.05 AS within_limit
FROM a JOIN b ON a.step = b.step
""")
def compare_runs(spark, sf_dir):
    """Step-aligned relative difference of two runs (even vs odd event ids), limit 5 %."""
    ev = tb.table(spark, sf_dir, "events").withColumn("step", F.dayofmonth("ts").cast("long"))
    a = ev.filter(F.col("event_id") % 2 == 0).groupBy("step").agg(F.avg("value").alias("v"))
    b = ev.filter(F.col("event_id") % 2 == 1).groupBy("step").agg(F.avg("value").alias("v"))
    c = ro.compare_runs(a, b, "v", 0.05)
    return c.select("step", r6(F.col("rel_diff")).alias("rel_diff"), "within_limit")
