"""Training rows, discounted sums over long sequences, checked joins and the metric set against plain versions."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln.operators import joins, rollouts, tokens
from kiln.sources import tables
from tests.conftest import SF_SMALL


def plain_sum(xs, gamma):
    out, acc = [], 0.0
    for x in reversed(xs):
        acc = x + gamma * acc
        out.append(acc)
    return out[::-1]


@pytest.mark.parametrize("gamma", [0.0, 1e-200, 0.5, 0.9, 0.9999, 1.0])
@pytest.mark.parametrize(("block", "levels"), [(64, 5), (3, 2), (2, 0)])
def test_long_discounted_sums(spark, gamma, block, levels):
    """Sequences of one row up to many blocks of blocks; other columns stay."""
    r = random.Random(5)
    seqs = {k: [r.uniform(-1, 1) for _ in range(n)] for k, n in {1: 1, 2: 2, 3: 3, 4: 64, 5: 65, 6: 700}.items()}
    rows = [(k, i + 1, x, f"c{i}") for k, xs in seqs.items() for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "seq long, pos long, x double, tag string").repartition(4)
    got = tokens.discounted_rows(df, ["seq"], "pos", "x", gamma, "y", block, levels).collect()
    assert len(got) == len(rows) and all(g.tag == f"c{g.pos - 1}" for g in got)
    for k, xs in seqs.items():
        mine = [g.y for g in sorted((g for g in got if g.seq == k), key=lambda g: g.pos)]
        assert mine == pytest.approx(plain_sum(xs, gamma), rel=1e-12, abs=1e-12)


def test_one_long_sequence_is_cut(spark):
    """20 000 positions of one sequence: no group of the plan holds more than a block."""
    n = 20_000
    df = spark.range(n).select(F.lit(1).alias("seq"), (F.col("id") + 1).alias("pos"), ((F.col("id") % 7) - 3).cast("double").alias("x"))
    got = [r.y for r in tokens.discounted_rows(df, ["seq"], "pos", "x", 0.99, "y").orderBy("pos").collect()]
    assert got == pytest.approx(plain_sum([float(i % 7 - 3) for i in range(n)], 0.99), rel=1e-10, abs=1e-10)
    with pytest.raises(ValueError):
        tokens.discounted_rows(df, ["seq"], "pos", "x", 1.5, "y")


def plain_datums(steps, adv):
    """The merge of one trajectory, token by token."""
    out, full = [], None
    for ob, ac, lp in steps:
        if full is not None and ob[: len(full[0])] == full[0]:
            new = ob[len(full[0]) :]
        else:
            full = ([], [], [], [])
            out.append(full)
            new = ob
        for t in new:
            for a, v in zip(full, (t, 0.0, 0.0, 0.0), strict=True):
                a.append(v)
        for t, p in zip(ac, lp, strict=True):
            for a, v in zip(full, (t, p, adv, 1.0), strict=True):
                a.append(v)
    return [(f[0][:-1], f[0][1:], f[1][1:], f[2][1:], f[3][1:]) for f in out]


def trajectory(r):
    steps, full = [], []
    for _ in range(r.randrange(1, 6)):
        kind = r.random()
        if kind < 0.6:
            ob = full + [r.randrange(3) for _ in range(r.randrange(3))]
        elif kind < 0.8:
            ob = full[: max(1, len(full) - 1)] or [1]  # shorter: no prefix
        else:
            ob = [r.randrange(3) for _ in range(r.randrange(1, 8))]
        ac = [r.randrange(3) for _ in range(r.randrange(1, 3))]
        steps.append((ob, ac, [-r.random() for _ in ac]))
        full = ob + ac
    return steps


def test_training_rows(spark):
    r = random.Random(11)
    trajs = {t: (t % 5 if t > 12 else 0, round(r.uniform(-1, 1), 3), trajectory(r)) for t in range(60)}  # a group of a third
    steps = [(t, i, *s) for t, (_, _, ss) in trajs.items() for i, s in enumerate(ss)]
    df = spark.createDataFrame(steps, "traj_id long, step long, ob_tokens array<long>, ac_tokens array<long>, ac_logprobs array<double>").repartition(4)
    adv = spark.createDataFrame([(g, t, a) for t, (g, a, _) in trajs.items()] + [(9, 99, 0.5)], "group_id long, traj_id long, advantage double")
    got = tokens.training_rows(df, adv).collect()
    places = defaultdict(list)
    for t, (g, _, _) in trajs.items():
        places[g].append(t)
    groups = sorted(places) + [9]
    want = []
    for t, (g, a, ss) in trajs.items():
        want += [(groups.index(g), sorted(places[g]).index(t), i, *d) for i, d in enumerate(plain_datums(ss, a))]
    cols = ("group_idx", "traj_idx", "datum_idx", "input_tokens", "target_tokens", "logprobs", "advantages", "target_mask")
    assert sorted(tuple(row[c] for c in cols) for row in got) == sorted(want)
    assert {row.traj_id for row in got} == set(trajs)
    with pytest.raises(Exception, match="advantages: no row for"):
        tokens.training_rows(df, adv.where("traj_id <> 7")).collect()
    with pytest.raises(Exception, match="unequal length"):
        tokens.training_rows(df.withColumn("ac_logprobs", F.array_append("ac_logprobs", F.lit(0.0))), adv).collect()


def test_single_turn_rows(spark):
    df = spark.createDataFrame([(1, [7, 8, 9], [4, 5], [-0.5, -0.25], 0.75)], "id long, prompt_tokens array<long>, tokens array<long>, logprobs array<double>, advantage double")
    r = tokens.single_turn_rows(df).first()
    assert (r.id, r.input_tokens, r.target_tokens) == (1, [7, 8, 9, 4], [8, 9, 4, 5])
    assert (r.logprobs, r.advantages) == ([0.0, 0.0, -0.5, -0.25], [0.0, 0.0, 0.75, 0.75])


def test_kl_pre_post_shift(spark):
    datums = spark.createDataFrame([(1, 0, -1.0, 0.0), (1, 1, -2.0, 1.0), (1, 2, -3.0, 1.0)], "seq_id long, at long, logprob double, mask double")
    post = spark.createDataFrame([(1, 0, None), (1, 1, -9.0), (1, 2, -2.5), (1, 3, -2.0)], "seq_id long, position long, logprob double")
    r = tokens.kl_pre_post(datums, post).first()
    assert (r.kl_pre_post_v1, r.kl_pre_post_v2) == (-0.25, 0.5 * (0.25 + 1.0) / 2)
    with pytest.raises(Exception, match="no row for"):
        tokens.kl_pre_post(datums, post.where("position < 3")).collect()


def test_checked_joins_raise(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    right = spark.createDataFrame([(1, 10), (2, 20)], "k long, y long")
    assert sorted(map(tuple, joins.strict_join(left, right, ["k"], "t").collect())) == [(1, "a", 10), (2, "b", 20)]
    for a, b in ((left, right.where("k = 1")), (left.where("k = 2"), right)):
        with pytest.raises(Exception, match="t: key on one side only"):
            joins.strict_join(a, b, ["k"], "t").collect()
        with pytest.raises(Exception, match="t: key on one side only"):
            joins.strict_join(a, b, ["k"], "t").count()  # also where no column is read
    with pytest.raises(Exception, match="doubled key"):
        joins.strict_join(left, right.union(right), ["k"], "t").collect()
    with pytest.raises(Exception, match="doubled key"):
        joins.lookup(left, right.union(right), ["k"], "t").collect()
    with pytest.raises(Exception, match="t: no row for"):
        joins.lookup(left, right.where("k = 1"), ["k"], "t").select("x").collect()
    with pytest.raises(Exception, match="t: no row for"):  # a later filter on what the join adds doesn't lose the check
        joins.lookup(left, right.where("k = 1"), ["k"], "t").where("y is not null").collect()
    with pytest.raises(Exception, match="t: key on one side only"):
        joins.strict_join(left, right.where("k = 1"), ["k"], "t").where("y > 0 and x is not null").collect()
    assert joins.lookup(left.union(left), right, ["k"], "t").count() == 4
    lists = spark.createDataFrame([([1, 2], ["a", "b"])], "a array<long>, b array<string>")
    assert [tuple(z) for z in lists.select(joins.strict_zip("t", a="a", b="b").alias("z")).first().z] == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="t: lists of unequal length"):
        lists.select(joins.strict_zip("t", a="a", b=F.slice("b", 1, 1)).alias("z")).collect()


def test_metric_set(spark):
    """Missing metrics, trajectories without steps, a doubled tag, a metric named like a base value, a hot group."""
    r = random.Random(2)
    trajs = [(0 if t < 20 else t % 4, t, float(r.random() < 0.5), {"final": float(t)} if t % 3 else {"total_turns": 5.0}) for t in range(40)]
    steps = [(t, r.randrange(9), r.randrange(9), r.random(), {"ok": float(t % 2)} if i % 2 else {}) for _, t, _, _ in trajs if t % 7 for i in range(t % 4 + 1)]
    tags = [(0, ["a", "b"]), (1, ["a", "a"]), (2, ["a"]), (3, [])]
    got = rollouts.metric_set(
        spark.createDataFrame(steps, "traj_id long, ob_len long, ac_len long, reward double, metrics map<string,double>").repartition(3),
        spark.createDataFrame(trajs, "group_id long, traj_id long, final_reward double, metrics map<string,double>"),
        spark.createDataFrame(tags, "group_id long, tags array<string>"),
    )
    want = {}
    for tag in ("a", "b", "all"):
        ids = [g for g, names in tags for n in names + ["all"] if n == tag]
        tr = [t for g in ids for t in trajs if t[0] == g]
        st = [s for t in tr for s in steps if s[0] == t[1]]
        total = {t[1]: t[2] + sum(s[3] for s in steps if s[0] == t[1]) for t in tr}
        m = {
            "ac_tokens_per_turn": sum(s[2] for s in st) / len(st), "ob_tokens_per_turn": sum(s[1] for s in st) / len(st), "turns_per_episode": len(st) / len(tr),
            "total_episodes": len(tr), "total_turns": len(st), "total_ac_tokens": sum(s[2] for s in st), "total_ob_tokens": sum(s[1] for s in st),
            "reward/total": sum(total[t[1]] for t in tr) / len(tr),
        }
        values = defaultdict(list)
        for d in [s[4] for s in st] + [t[3] for t in tr]:
            for k, v in d.items():
                values[k].append(v)
        m.update({k: sum(v) / len(v) for k, v in values.items()})
        kinds = []
        for g in ids:
            x = {total[t[1]] for t in trajs if t[0] == g}
            kinds.append("mixed" if len(x) > 1 else "all_good" if min(x) >= 0.5 else "all_bad")
        m.update({f"by_group/frac_{k}": kinds.count(k) / len(kinds) for k in ("mixed", "all_good", "all_bad")})
        want.update({f"env/{tag}/{k}": v for k, v in m.items()})
    assert {row.key: row.value for row in got.collect()} == pytest.approx(want, rel=1e-12)


def test_metric_set_without_a_smaller_tag(spark):
    trajs = spark.createDataFrame([(1, 1, 0.0, None), (2, 2, 1.0, None)], "group_id long, traj_id long, final_reward double, metrics map<string,double>")
    steps = spark.createDataFrame([], "traj_id long, ob_len long, ac_len long, reward double, metrics map<string,double>")
    tags = spark.createDataFrame([(1, ["t"]), (2, ["t"])], "group_id long, tags array<string>")
    got = {r.key: r.value for r in rollouts.metric_set(steps, trajs, tags).collect()}
    assert {k.split("/")[1] for k in got} == {"all"}  # every tag covers all groups: only the whole
    assert got["env/all/total_episodes"] == 2 and got["env/all/ac_tokens_per_turn"] is None and got["env/all/by_group/frac_all_good"] == 0.5


def test_metric_set_explodes_metrics_only(spark):
    """Fixed numbers of a step fold as columns: no row a number and step."""
    trajs = spark.createDataFrame([(1, 1, 0.5, None)], "group_id long, traj_id long, final_reward double, metrics map<string,double>")
    steps = spark.createDataFrame([(1, 2, 3, 0.25, {"ok": 1.0})], "traj_id long, ob_len long, ac_len long, reward double, metrics map<string,double>")
    m = rollouts.metric_set(steps, trajs, spark.createDataFrame([(1, ["t"])], "group_id long, tags array<string>"))
    plan = m._jdf.queryExecution().optimizedPlan().toString()
    exploded = [line for line in plan.splitlines() if "Generate inline" in line]
    assert len(exploded) == 2 and not any("turns" in line or "reward" in line for line in exploded)
    assert {r.key: r.value for r in m.collect()}["env/all/reward/total"] == 0.75


@pytest.mark.parametrize("name", ["prefix_merge_datums", "training_rows", "accuracy_by_source"])
def test_numbered_items_are_dealt_by_rows(spark, name, monkeypatch):
    """Tasks follow the rows, and what is dealt by order once is not dealt by it again."""
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 150)
    rows = tables.table(spark, SF_SMALL, "lineitem").count()
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-rows // 150)}), REPARTITION_BY_NUM" in plan
    assert "hashpartitioning(l_orderkey" not in plan
    assert plan.count("Exchange hashpartitioning(traj_id") == {"prefix_merge_datums": 1}.get(name, plan.count("Exchange hashpartitioning(traj_id"))
