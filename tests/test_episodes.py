"""Episode rules, hooks and adapters on hand-made rows; every query's cases really occur."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from kiln.operators import adapters, episodes, prefs, render, retrieve, rollouts, split
from kiln.sources import io
from kiln.sources.tables import messages
from tests.conftest import SF_SMALL


def test_every_tool_failure(spark):
    rows = [
        (1, 1, "search", False, 10, None), (1, 2, "browse", False, 10, None), (1, 3, "search", False, 10, None),
        (2, 1, "search", False, 10, None), (2, 2, "search", False, 10, None), (2, 3, "search", True, 99, None),
        (3, 1, "search", True, 99, None), (4, 1, "search", False, 99, None), (5, 1, "search", None, 10, None), (5, 2, None, None, 99, 1.0), (5, 3, None, None, 10, 0.5),
        (6, 1, "search", False, 10, None),
    ]
    df = spark.createDataFrame(rows, "traj_id long, turn long, tool string, tool_error boolean, prompt_tokens long, reward double")
    got = episodes.tool_episode(df, ["search"], max_calls=2, max_tokens=50).orderBy("traj_id", "turn").collect()
    assert [(r.traj_id, r.turn, r.failure, r.reward, r.episode_done) for r in got] == [
        (1, 1, None, 0.0, False), (1, 2, "unknown_tool", 0.0, True), (2, 1, None, 0.0, False), (2, 2, None, 0.0, False), (2, 3, "too_many_calls", 0.0, True),
        (3, 1, "tool_error", 0.0, True), (4, 1, "prompt_too_long", 0.0, True), (5, 1, None, 0.0, False), (5, 2, None, 1.0, True), (6, 1, None, 0.0, False),
    ]


def test_queries_reach_every_case(spark):
    q = E.queries()
    assert {r.failure for r in q["tool_episodes"](spark, SF_SMALL).select("failure").distinct().collect()} == {
        None, "unknown_tool", "too_many_calls", "tool_error", "prompt_too_long"}
    assert {r.reward for r in q["two_player_games"](spark, SF_SMALL).select("reward").distinct().collect()} == {-2.0, -1.0, 0.0, 1.0}
    acc = [r.accuracy for r in q["plain_accuracy"](spark, SF_SMALL).collect()]
    assert any(0 < a < 1 for a in acc)
    assert {r.valid for r in q["search_results"](spark, SF_SMALL).collect()} == {True, False}
    w = q["win_rate"](spark, SF_SMALL).first()
    assert 0 < w.win_rate < 1 and w.stderr > 0


def test_turn_limit(spark):
    df = spark.createDataFrame([(1, t, t == 9) for t in range(1, 10)] + [(2, t, t == 2) for t in range(1, 5)], "traj_id long, turn long, win boolean")
    got = episodes.cut_at_first(df, F.col("win"), max_turns=4).groupBy("traj_id").count().orderBy("traj_id").collect()
    assert [r["count"] for r in got] == [4, 2]


def test_two_player_rewards(spark):
    turns = spark.createDataFrame([(1, 1, 0), (1, 2, 1), (1, 3, 0), (2, 1, 0), (2, 2, 0), (2, 3, 1), (3, 1, 1)], "traj_id long, turn long, player long")
    game = spark.createDataFrame([(1, 0, 1.0), (1, 1, -1.0), (2, 0, 1.0), (2, 1, -1.0)], "traj_id long, player long, reward double")
    got = {(r.traj_id, r.player): r.reward for r in episodes.two_player_rewards(turns, game).collect()}
    assert got == {(1, 0): 1.0, (1, 1): -1.0, (2, 0): -2.0, (2, 1): -1.0, (3, 1): 0.0}


def test_calls_to_transitions(spark):
    calls = spark.createDataFrame([(1, 5), (1, 3), (2, 1)], "traj_id long, at long")
    scores = spark.createDataFrame([(1, 0.75)], "traj_id long, score double")
    got = episodes.calls_to_transitions(calls, scores).orderBy("traj_id", "step").collect()
    assert [(r.traj_id, r["at"], r.step, r.done, r.reward) for r in got] == [(1, 3, 1, False, 0.0), (1, 5, 2, True, 0.75), (2, 1, 1, True, 0.0)]


def test_hook_contracts(spark):
    df = spark.createDataFrame([(1, "Yes it is", "yes"), (2, None, "yes"), (3, "no", "yes")], "id long, r string, t string")
    for bad in ({}, {"map_fn": lambda d: d, "flatmap_fn": lambda d: F.array("id")}):
        with pytest.raises(ValueError, match="exactly one"):
            episodes.map_rows(df, **bad)
    got = episodes.graded(df, lambda a, b: F.contains(F.lower(a), F.lower(b)), "r", "t").orderBy("id").collect()
    assert [r.correct for r in got] == [True, False, False]
    cmp = spark.createDataFrame([(1, ([], [("assistant", "<think>x</think>aa")], [("assistant", "a")]))],
                                "id long, cmp struct<prompt:array<string>,completion_a:array<struct<role:string,content:string>>,completion_b:array<struct<role:string,content:string>>>")
    size = lambda c: F.length(c["completion_a"][0]["content"])
    assert episodes.preferred(cmp, lambda c: size(c) / 4.0, preprocess=adapters.strip_thinking).first().score == 0.5
    with pytest.raises(Exception, match="outside"):
        episodes.preferred(cmp, lambda c: size(c) * 1.0).collect()


def test_mixed_golds(spark):
    rows = [('{"ground_truth": {"target": ["a", "b"]}}', '["x"]'), ('{"ground_truth": ["c"]}', None), ('"text"', '["d"]'), (None, "[]"), (None, None), ("not json", '["e"]')]
    df = spark.createDataFrame(rows, "m string, g string")
    golds = adapters.mixed_golds(F.col("m"), F.col("g"))
    assert [r.v for r in df.select(golds.alias("v")).collect()] == [["a", "b"], ["c"], ["d"], [], [], ["e"]]
    for bad in ('{"ground_truth": {"target": [1, 2]}}', '{"ground_truth": "x"}'):
        with pytest.raises(Exception, match="no list of strings"):
            spark.createDataFrame([(bad, None)], "m string, g string").select(golds.alias("v")).collect()


def test_unknown_source(spark):
    with pytest.raises(ValueError, match="unknown dataset"):
        io.read_dataset(spark, "nothing", [])


def test_prompt_groups_drop_nulls_after_batching(spark):
    """T4: a batch keeps its number, its null prompts go, so it may be smaller."""
    rows = [(k, k + 1, None if k == 1 else [str(k)]) for k in range(7)]
    df = spark.createDataFrame(rows, "group_id long, global_rank long, prompt array<string>")
    got = prefs.prompt_groups(df, 3, 2).groupBy("batch_idx").agg(F.count("*").alias("n"), F.countDistinct("group_id").alias("g")).orderBy("batch_idx")
    assert [tuple(r) for r in got.collect()] == [(0, 4, 2), (1, 6, 3)]


def test_split_errors(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "i long")
    for k in (0, 4):
        with pytest.raises(Exception, match="cannot cut 3 rows into"):
            df.select(split.even_chunk(F.col("i"), F.lit(3), F.lit(k))).collect()
    with pytest.raises(ValueError, match="batch sizes"):
        split.composite_batches([df], [1, 2])


@pytest.mark.parametrize("rows", [None, 10, 10**9])
def test_shuffle_rank_of_a_hot_group(spark, rows):
    """A group with two thirds of the rows is ranked as the others, whatever the number of buckets."""
    df = spark.createDataFrame([(k, "hot" if k % 3 else f"g{k % 5}") for k in range(600)], "id long, g string").repartition(4)
    got = split.shuffle_rank(df, 9, "id", group=["g"], rows=rows, keep_total=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.global_rank, r._group_rows))
    assert sum(map(len, by.values())) == 600
    for v in by.values():
        assert sorted(x for x, _ in v) == list(range(1, len(v) + 1)) and {n for _, n in v} == {len(v)}


def test_trials(spark):
    df = spark.range(1, 12).withColumnRenamed("id", "_rank").withColumn("reward", F.col("_rank") * 1.0)
    got = {(r.rollout_idx, r.example_idx): r.reward for r in rollouts.trials(df, 3).collect()}
    assert got == {(i // 3, i % 3): i + 1.0 for i in range(9)}


def test_mask_contract(spark):
    m = messages(spark, SF_SMALL).withColumn("trainable", F.when(F.col("turn") > 0, F.col("turn") % 2 == 0))
    with pytest.raises(Exception, match="trainable on every message"):
        render.render_segments(m, "llama3", "customized", trainable="trainable").collect()
    with pytest.raises(Exception, match="forbids"):
        render.render_segments(m, "llama3", "all_messages", trainable="trainable").collect()
    assert render.render_segments(m.withColumn("trainable", F.lit(None).cast("boolean")), "llama3", "all_messages", trainable="trainable").count() > 0


@pytest.mark.parametrize("block_bytes", [64, 1 << 20])
def test_nearest_neighbours_over_blocks(spark, block_bytes):
    """Blocks of one to two vectors: the same as one block; ties by id, other lengths and nulls never found, text ids."""
    import random

    r = random.Random(3)
    docs = [(i, [float(r.randrange(-2, 3)) for _ in range(4)]) for i in range(150)] + [(500, None), (501, [9.0] * 3)]
    queries = [(f"q{i}", [float(r.randrange(-2, 3)) for _ in range(4)]) for i in range(40)] + [("short", [1.0, 1.0, 1.0])]
    d = spark.createDataFrame(docs, "vec_id long, embedding array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query_id string, embedding array<float>").repartition(3)
    got = {}
    for x in retrieve.nearest_neighbours(q, d, 7, block_bytes=block_bytes, shards=4).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    for name, v in queries:
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in docs if w is not None and len(w) == len(v)]
        assert sorted(got[name]) == [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:7])]
    assert retrieve.nearest_neighbours(q.limit(0), d, 3).count() == 0


def test_search_calls(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0], "one"), (2, [0.0, 1.0], "two")], "vec_id long, embedding array<double>, doc string")
    vectors = spark.createDataFrame([("x", [1.0, 0.1]), ("y", [0.1, 1.0])], "text string, embedding array<double>")
    calls = spark.createDataFrame([(1, "search", ["y", "x", "y"]), (2, "search", []), (3, "search", None), (4, "other", ["x"])], "call_id long, name string, query_list array<string>")
    got = {r.call_id: (r.valid, r.content) for r in retrieve.search_calls(calls, vectors, docs, 2).collect()}
    part = {"x": "Query: x\nDocument 1:\none\nDocument 2:\ntwo\n", "y": "Query: y\nDocument 1:\ntwo\nDocument 2:\none\n"}
    assert got[1] == (True, part["y"] + part["x"] + part["y"])
    assert [got[k][0] for k in (2, 3, 4)] == [False] * 3 and got[2][1] == retrieve.ERR_NON_EMPTY and got[3][1] == retrieve.ERR_REQUIRED
    with pytest.raises(Exception, match="query vectors: no row for"):
        retrieve.search_calls(calls, vectors.where("text = 'x'"), docs).collect()


def test_group_rewards_over_frames_of_many_groups(spark):
    """Groups longer than an Arrow frame, of one row and of null keys: one call a whole group, in as many tasks as the session shuffles to."""
    sizes = {None: 7, 0: 1, 1: 950, 2: 3, 3: 1, **{k: k % 9 + 1 for k in range(4, 150)}}
    rows = spark.createDataFrame([(k, float(i)) for k, n in sizes.items() for i in range(n)], "group_id long, reward double").repartition(5)

    def shares(f):
        assert f["group_id"].nunique(dropna=False) == 1 and list(f.index) == list(range(len(f)))
        return f.assign(reward=f["reward"].rank(method="min") / len(f), ids=str(f["group_id"].dtype))

    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = episodes.group_rewards(rows, shares, "group_id long, reward double, ids string")
        assert got.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = sorted(((r.group_id is None, r.group_id or 0, r.reward, r.ids) for r in got.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    kinds = {True: "float64", False: "int64"}
    none = {x[3] for x in found if x[0]}
    assert [x[:3] for x in found] == sorted((k is None, k or 0, (i + 1) / n) for k, n in sizes.items() for i in range(n))
    assert {x[3] for x in found if not x[0]} == {kinds[False]} and none <= {"float64", "object"}
