"""Rows of training and evaluation sets: source adapters, distillation, episodes, hooks, logs (N*, S*, P*, G*, U*)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions import graders, math_grade
from kiln.operators import adapters as ad
from kiln.operators import episodes, prefs, rollouts, split
from kiln.operators.ranking import range_rank
from kiln.plans.registry import query
from kiln.sources import io
from kiln.sources.tables import messages, numbered_items, table
from kiln.streaming.batches import scratch_dir


@query("chat_text", "N1 N2", """
SELECT md5('<|begin_of_text|>' || string_agg('<|start_header_id|>' || CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END || '<|end_header_id|>'
                                             || chr(10) || chr(10) || text || '<|eot_id|>', '' ORDER BY turn)) AS text_md5, count(*) AS n_messages
FROM conversations GROUP BY conv_id
""")
def chat_text(spark, sf_dir):
    """ShareGPT rows → messages → one ``text`` column of the chat template; nothing else is kept."""
    m = messages(spark, sf_dir)
    said = F.when(F.col("role") == "user", "human").otherwise("gpt")
    sg = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", said.alias("from"), F.col("content").alias("value")))).alias("conversations"))
    text = ad.chat_text(sg, "llama3")
    return text.select(F.md5("text").alias("text_md5"), (F.size(F.split("text", r"<\|start_header_id\|>")) - 1).cast("long").alias("n_messages"))


@query("preference_adapters", "N7 N8 N9 S4 S5 S6", """
WITH li AS (SELECT *, l_linenumber - 4 AS pref, l_orderkey || '.' || l_suppkey AS one, l_partkey || '.' || l_linenumber AS two FROM lineitem)
SELECT 'tulu3' AS kind, count(*) AS n, sum(length(one) + length(two)) AS chars, 'A' AS label, 'user' AS prompt_role, min(one) AS least FROM li
UNION ALL SELECT 'ultrafeedback', count(*), sum(length(one) + length(two)), 'A', 'user', min(one) FROM li
UNION ALL SELECT 'helpsteer3', count(*), sum(length(one) + length(two)), CASE WHEN pref < 0 THEN 'A' ELSE 'B' END, 'system', min(one) FROM li WHERE pref <> 0 GROUP BY pref < 0
""")
def preference_adapters(spark, sf_dir):
    """Three preference sources written in their own schemas, in two parts each, and read back by name into one shape."""
    li = table(spark, sf_dir, "lineitem")
    one = F.concat_ws(".", "l_orderkey", "l_suppkey")
    two = F.concat_ws(".", "l_partkey", "l_linenumber")
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    p = F.col("l_returnflag")
    raw = {
        "tulu3": li.select(p.alias("prompt"), F.array(said("user", p), said("assistant", one)).alias("chosen"), F.array(said("user", p), said("assistant", two)).alias("rejected"), "l_linestatus"),
        "ultrafeedback": li.select(p.alias("instruction"), one.alias("chosen_response"), two.alias("rejected_response"), "l_linestatus"),
        "helpsteer3": li.select(F.array(said("system", p), said("user", p)).alias("context"), one.alias("response1"), two.alias("response2"),
                                (F.col("l_linenumber") - 4).alias("overall_preference"), "l_linestatus"),
    }
    base, out = scratch_dir(spark, "preference-sources"), []
    for kind, df in raw.items():
        df.write.partitionBy("l_linestatus").parquet(f"{base}/{kind}")
        paths = [f"{base}/{kind}/l_linestatus={s}" for s in ("F", "O")]
        c = F.col("comparison")
        content = lambda side: F.element_at(c[side], 1)["content"]  # noqa: B023, E731
        rows = io.read_dataset(spark, kind, paths).select(
            F.lit(kind).alias("kind"), F.col("label"), F.element_at(c["prompt"], 1)["role"].alias("prompt_role"), content("completion_a").alias("one"),
            content("completion_b").alias("two"))
        out.append(rows)
    u = out[0].unionByName(out[1]).unionByName(out[2])
    g = u.groupBy("kind", "label", "prompt_role").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("one") + F.length("two")).alias("chars"), F.min("one").alias("least"))
    return g.select("kind", "n", "chars", "label", "prompt_role", "least")


@query("qa_golds", "N15", """
SELECT p_partkey AS item_id, p_brand AS question, CASE p_partkey % 4 WHEN 0 THEN p_name || '|' || p_type WHEN 1 THEN p_name WHEN 2 THEN p_type || '|é' ELSE '' END AS answers,
       split_part(p_type, ' ', 1) AS data_source FROM part
""")
def qa_golds(spark, sf_dir):
    """Gold answers of mixed type: an object with the list, the list itself, or none and a list beside it."""
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    kind = F.col("p_partkey") % 4
    model = (
        F.when(kind == 0, F.concat(F.lit('{"style": "rule", "ground_truth": {"n": 2, "target": ['), quoted("p_name"), F.lit(", "), quoted("p_type"), F.lit("]}}")))
        .when(kind == 1, F.concat(F.lit('{"ground_truth": ['), quoted("p_name"), F.lit("]}"))).when(kind == 2, F.lit('"none"'))
    )
    golds = F.when(kind == 2, F.concat(F.lit("["), quoted("p_type"), F.lit(', "\\u00e9"]'))).when(kind == 1, F.lit('["unused"]'))
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("question"), model.alias("reward_model"), golds.alias("golden_answers"),
        F.element_at(F.split("p_type", " "), 1).alias("data_source"))
    out = p.withColumn("answers", ad.mixed_golds(F.col("reward_model"), F.col("golden_answers")))
    return out.select("item_id", "question", F.array_join("answers", "|").alias("answers"), "data_source")


@query("math_rows", "N14 G1 G2", """
SELECT p_partkey AS problem_id, 'math' AS source, CAST(p_size AS VARCHAR) AS answer FROM part WHERE p_size % 3 <> 0
UNION ALL SELECT p_partkey, 'gsm8k', CAST(p_size * 1000 AS VARCHAR) FROM part WHERE p_size % 4 <> 0
""")
def math_rows(spark, sf_dir):
    """Reference answers out of MATH solutions and GSM8K answers; rows without one are dropped."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    solution = F.when(F.col("p_size") % 3 == 0, F.lit("so it is $5$")).otherwise(F.concat(F.lit("so \\boxed{"), size, F.lit("}")))
    answer = F.when(F.col("p_size") % 4 == 0, F.lit("no marker")).otherwise(F.concat("p_name", F.lit("\n#### "), size, F.lit(",000")))
    math = p.select(F.col("p_partkey").alias("problem_id"), F.lit("math").alias("source"), math_grade.extract_boxed(solution).alias("answer"))
    gsm = p.select(F.col("p_partkey").alias("problem_id"), F.lit("gsm8k").alias("source"), graders.gsm8k_answer(answer).alias("answer"))
    return math.unionByName(gsm).filter(F.col("answer").isNotNull())


@query("distillation_rows", "N22 G4b S1 S8", """
SELECT md5(p_name) AS query_md5, 'user' AS first_role, 'assistant' AS second_role, CASE p_size % 3 WHEN 0 THEN 'en' ELSE 'fr' END AS label, count(*) AS n
FROM part WHERE p_size % 5 <> 0 GROUP BY 1, 2, 3, 4
""")
def distillation_rows(spark, sf_dir):
    """The teacher saw prompt and query; the student row has query → label only. Written as JSONL (S8) and read back."""
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_size") % 3 == 0, "en").otherwise("fr")
    queries = p.select(F.col("p_partkey").alias("query_id"), F.col("p_name").alias("query"))
    said = F.when(F.col("p_size") % 5 == 0, F.lit("I cannot tell")).otherwise(F.concat(F.lit("Reasons.\nFinal Answer: "), label, F.lit(" Final Answer: xx")))
    rows = ad.student_rows(queries, p.select(F.col("p_partkey").alias("query_id"), said.alias("response")), graders.final_answer_word)
    path = scratch_dir(spark, "student-rows") + "/rows"
    io.write_conversations(rows, path)
    back = io.read_conversations(spark, path)
    m = lambda k, f: F.element_at("messages", k)[f]
    g = back.select(F.md5(m(1, "content")).alias("query_md5"), m(1, "role").alias("first_role"), m(2, "role").alias("second_role"), m(2, "content").alias("label"))
    return g.groupBy(*g.columns).agg(F.count(F.lit(1)).alias("n"))


@query("preference_groups", "P4 P6 D7 D17 N26 U3 U4", """
WITH c AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('0:' || o_orderkey), o_orderkey) AS r, count(*) OVER () AS n, o_orderstatus = 'P' AS missing FROM orders),
b AS (SELECT o_orderkey, (r - 1) // 32 AS batch_idx FROM c WHERE (r - 1) // 32 < n // 32 AND NOT missing),
g AS (SELECT o_orderkey, batch_idx, i, j FROM b, (SELECT unnest([0, 1, 2, 3]) AS i), (SELECT unnest([0, 1, 2, 3]) AS j) WHERE i <> j)
SELECT CAST(batch_idx AS BIGINT) AS batch_idx, o_orderkey AS group_id, i AS idx_i, j AS idx_j,
       CAST(CASE WHEN (o_orderkey + i * 7) % 11 < (o_orderkey + j * 7) % 11 THEN -1 WHEN (o_orderkey + i * 7) % 11 > (o_orderkey + j * 7) % 11 THEN 1 ELSE 0 END AS DOUBLE) AS score
FROM g
""")
def preference_groups(spark, sf_dir):
    """Batches of 32 prompts, the null ones removed after batching, 4 players each; P4: comparison rows scored by a model."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("group_id"), "o_orderstatus")
    prompt = F.when(F.col("o_orderstatus") != "P", F.array(ad.msg(F.lit("user"), F.concat(F.lit("order "), F.col("group_id").cast("string")))))
    ranked = split.shuffle_rank(o.select("group_id", prompt.alias("prompt")), 0, "group_id", keep_total=True)
    players = prefs.prompt_groups(ranked, 32, 4)
    # a player's reply: thinking, then as many letters as its id says
    reply = F.concat(F.lit("<think>long</think>"), F.repeat(F.lit("x"), ((F.col("group_id") + F.col("idx") * 7) % 11).cast("int")))
    rows = prefs.comparison_rows(players.withColumn("completion", F.array(ad.msg(F.lit("assistant"), reply))), "all_pairs_both_ways", 4)
    length = lambda c, side: F.length(F.element_at(c[side], 1)["content"])
    shorter = lambda c: graders.shorter_preference(length(c, "completion_a"), length(c, "completion_b")).cast("double")
    scored = episodes.preferred(rows, shorter, "cmp", ad.strip_thinking)
    return scored.select("batch_idx", "group_id", F.col("idx_i").cast("int").alias("idx_i"), F.col("idx_j").cast("int").alias("idx_j"), "score")


EPISODE_SQL = """
t AS (
  SELECT l_orderkey AS traj_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS turn,
         CASE WHEN l_quantity < 46 THEN CASE WHEN l_suppkey % 13 = 0 THEN 'browse' ELSE 'search' END END AS tool, l_partkey % 17 = 0 AS tool_error,
         CAST(l_quantity AS BIGINT) * 10 AS grown, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.1 END AS reward FROM lineitem)
"""


@query("tool_episodes", "G19 G23", f"""
WITH {EPISODE_SQL},
r AS (
  SELECT *, sum(grown) OVER w AS prompt_tokens, sum(CASE WHEN tool = 'search' THEN 1 ELSE 0 END) OVER w AS n_calls FROM t
  WINDOW w AS (PARTITION BY traj_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (
  SELECT *, CASE WHEN tool IS NULL THEN NULL WHEN tool <> 'search' THEN 'unknown_tool' WHEN n_calls > 3 THEN 'too_many_calls' WHEN tool_error THEN 'tool_error'
                 WHEN prompt_tokens > 800 THEN 'prompt_too_long' END AS failure FROM r),
e AS (SELECT *, min(CASE WHEN tool IS NULL OR failure IS NOT NULL THEN turn END) OVER (PARTITION BY traj_id) AS last FROM f)
SELECT traj_id, CAST(turn AS BIGINT) AS turn, failure, CASE WHEN tool IS NULL THEN reward ELSE 0.0 END AS reward, coalesce(turn = last, false) AS episode_done
FROM e WHERE last IS NULL OR turn <= last
""")
def tool_episodes(spark, sf_dir):
    """All four failure rules of tool episodes; G19: each ends at its first answer or failure."""
    li = numbered_items(spark, sf_dir, step="turn")
    w = Window.partitionBy("traj_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    t = li.select(
        "traj_id", "turn",
        F.when(F.col("l_quantity") < 46, F.when(F.col("l_suppkey") % 13 == 0, "browse").otherwise("search")).alias("tool"),
        (F.col("l_partkey") % 17 == 0).alias("tool_error"), (F.col("l_quantity").cast("long") * 10).alias("grown"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.1).alias("reward"),
    ).withColumn("prompt_tokens", F.sum("grown").over(w))
    e = episodes.tool_episode(t, ["search"], max_calls=3, max_tokens=800)
    return e.select("traj_id", "turn", "failure", "reward", "episode_done")


@query("two_player_games", "G22 W6", """
WITH t AS (
  SELECT l_orderkey AS traj_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS turn,
         (l_suppkey // 3) % 2 AS player, l_quantity, l_returnflag FROM lineitem),
m AS (SELECT *, coalesce(lead(player) OVER (PARTITION BY traj_id ORDER BY turn) = player, false) AS bad FROM t),
p AS (SELECT traj_id, player, bool_or(bad) AS illegal, count(*) AS n_moves FROM m GROUP BY 1, 2),
g AS (SELECT o_orderkey AS traj_id, o_custkey % 2 AS player, 1.0 AS reward FROM orders WHERE o_orderstatus <> 'P'
      UNION ALL SELECT o_orderkey, 1 - o_custkey % 2, -1.0 FROM orders WHERE o_orderstatus <> 'P')
SELECT p.traj_id, p.player, n_moves, illegal, CASE WHEN illegal THEN -2.0 ELSE coalesce(reward, 0.0) END AS reward
FROM p LEFT JOIN g ON p.traj_id = g.traj_id AND p.player = g.player
""")
def two_player_games(spark, sf_dir):
    """-2 for the player who moved twice, else the game's reward of that player, else (unfinished games) 0."""
    t = numbered_items(spark, sf_dir, step="turn").select("traj_id", "turn", (F.floor(F.col("l_suppkey") / 3) % 2).alias("player"))
    o = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'")
    game = o.select(F.col("o_orderkey").alias("traj_id"), F.inline(F.array(
        F.struct((F.col("o_custkey") % 2).alias("player"), F.lit(1.0).alias("reward")), F.struct((1 - F.col("o_custkey") % 2).alias("player"), F.lit(-1.0).alias("reward")))))
    return episodes.two_player_rewards(t, game)


@query("word_guesses", "G18", """
SELECT p_partkey AS item_id, CASE p_size % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 1.0 ELSE 0.0 END AS reward FROM part
""")
def word_guesses(spark, sf_dir):
    """Guesses of the part's brand: right, a longer word, right in other case, no guess at the start."""
    p = table(spark, sf_dir, "part")
    kind = F.col("p_size") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit("Guess: "), "p_brand")).when(kind == 1, F.concat(F.lit("Guess: "), "p_brand", F.lit("s")))
        .when(kind == 2, F.concat(F.lit("Guess: "), F.upper("p_brand"))).otherwise(F.concat(F.lit("My Guess: "), "p_brand"))
    )
    return p.select(F.col("p_partkey").alias("item_id"), graders.word_guess_reward(text, F.col("p_brand")).alias("reward"))


@query("plain_accuracy", "A17 G16 U2", """
WITH r AS (SELECT split_part(p_type, ' ', 1) AS source, contains(lower(p_type || ' ' || p_brand), lower(substr(p_name, 1, 1 + p_size % 2))) AS ok FROM part)
SELECT source, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n FROM r GROUP BY source
""")
def plain_accuracy(spark, sf_dir):
    """Accuracy of the containment grader (G16), passed in as a hook (U2), per source."""
    p = table(spark, sf_dir, "part").select(
        F.element_at(F.split("p_type", " "), 1).alias("source"), F.concat_ws(" ", "p_type", "p_brand").alias("response"),
        F.substring("p_name", F.lit(1), (F.col("p_size") % 2 + 1).cast("int")).alias("target"))
    g = episodes.graded(p, graders.contains_ci, "response", "target")
    return g.groupBy("source").agg(F.round(F.avg(F.col("correct").cast("double")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@query("rollout_trials", "A18", """
WITH r AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, count(*) OVER () // 4 AS n FROM orders)
SELECT CAST(i // n AS BIGINT) AS rollout_idx, CAST(i % n AS BIGINT) AS example_idx, o_totalprice AS reward FROM r WHERE i < 4 * n
""")
def rollout_trials(spark, sf_dir):
    """The rewards of 4 rollouts laid out by rollout and example."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("reward"))
    return rollouts.trials(range_rank(o, ["o_orderkey"], "_rank"), 4).select("rollout_idx", "example_idx", "reward")


@query("run_logs", "S11 S13 S14 S16", """
WITH m AS (SELECT user_id % 5 AS run, CAST(day(ts) AS BIGINT) AS step, round(avg(value), 6) AS loss FROM events GROUP BY 1, 2),
c AS (SELECT user_id % 5 AS run, arg_max(event_id, (day(ts), event_id)) AS last_id FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT m.run, count(*) AS steps, max(step) AS last_step, round(arg_max(loss, step), 6) AS last_loss, max(c.last_id) AS last_id, 'run' || m.run AS name
FROM m LEFT JOIN c ON m.run = c.run GROUP BY m.run
""")
def run_logs(spark, sf_dir):
    """Logs of five runs: metrics appended in two halves (S11) and read back (S13), last checkpoint of each run (S14), configs."""
    ev = table(spark, sf_dir, "events").withColumn("run", F.col("user_id") % 5).withColumn("step", F.dayofmonth("ts").cast("long"))
    base = scratch_dir(spark, "run-logs")
    m = ev.groupBy("run", "step").agg(F.round(F.avg("value"), 6).alias("loss"))
    for half in (F.col("step") <= 15, F.col("step") > 15):
        io.append_metrics(m.where(half), f"{base}/metrics")
    log = ev.select("run", F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("name"), F.col("step").alias("epoch"), F.col("event_id").alias("batch"),
                    F.when(F.col("event_type") == "purchase", F.col("event_id").cast("string")).alias("state_path"), F.lit("s").alias("sampler_path"))
    io.append_metrics(log, f"{base}/checkpoints")
    io.append_metrics(ev.select("run", F.concat(F.lit("run"), F.col("run").cast("string")).alias("name")).distinct(), f"{base}/config")
    metrics = io.read_jsonl(spark, f"{base}/metrics", "run long, step long, loss double")
    last = io.last_checkpoint(io.read_jsonl(spark, f"{base}/checkpoints", io.run_schema(io.CHECKPOINT_LOG)), by=["run"])
    configs = io.read_jsonl(spark, f"{base}/config", "run long, name string")
    out = metrics.groupBy("run").agg(F.count(F.lit(1)).alias("steps"), F.max("step").alias("last_step"), F.round(F.max_by("loss", "step"), 6).alias("last_loss"))
    out = out.join(last.select("run", F.col("batch").alias("last_id")), "run", "left").join(configs, "run")
    return out.select("run", "steps", "last_step", "last_loss", "last_id", "name")


@query("logged_calls", "U9 U1", """
WITH c AS (
  SELECT user_id AS traj_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step,
         lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS done, regexp_extract(props, '[0-9]+')::BIGINT AS k FROM events)
SELECT traj_id, CAST(step AS BIGINT) AS step, done, CASE WHEN done AND traj_id % 3 <> 0 THEN traj_id / 10.0 ELSE 0.0 END AS reward, CAST(unnest([k, k + 1]) AS BIGINT) AS token FROM c
""")
def logged_calls(spark, sf_dir):
    """Calls recorded by a third-party environment as transitions; U1: a flatmap hook takes two rows from each."""
    ev = table(spark, sf_dir, "events")
    calls = ev.select(F.col("user_id").alias("traj_id"), F.struct("ts", "event_id").alias("at"), F.regexp_extract("props", "[0-9]+", 0).cast("long").alias("k"))
    scores = ev.select(F.col("user_id").alias("traj_id")).distinct().where("traj_id % 3 <> 0").withColumn("score", F.col("traj_id") / 10.0)
    t = episodes.calls_to_transitions(calls, scores)
    flat = episodes.map_rows(t, flatmap_fn=lambda df: F.array("k", F.col("k") + 1), out="token")
    return flat.select("traj_id", "step", "done", "reward", "token")


@query("group_hooks", "U1 U5 U6", """
WITH g AS (SELECT o_custkey AS group_id, o_orderkey AS traj_id, round(o_totalprice / 1000, 3) AS reward FROM orders),
k AS (SELECT * FROM g WHERE group_id IN (SELECT group_id FROM g GROUP BY 1 HAVING count(*) >= 4 AND max(reward) - min(reward) > 100))
SELECT group_id, traj_id, CAST(rank() OVER (PARTITION BY group_id ORDER BY reward) AS DOUBLE) / count(*) OVER (PARTITION BY group_id) AS reward FROM k
""")
def group_hooks(spark, sf_dir):
    """Groups of four orders and more whose prices spread; U6: a user's rewards over each whole group (rank shares); U1: a map hook."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("traj_id"), "o_totalprice")
    g = episodes.map_rows(o, map_fn=lambda df: df.select("group_id", "traj_id", F.round(F.col("o_totalprice") / 1000, 3).alias("reward")))
    kept = episodes.keep_groups(g, lambda _: (F.count(F.lit(1)) >= 4) & (F.max("reward") - F.min("reward") > 100))

    def ranks(rows):
        by = rows.groupby("group_id")["reward"]
        return rows.assign(reward=by.rank(method="min") / by.transform("size"))

    return episodes.group_rewards(kept, ranks, "group_id long, traj_id long, reward double", many=True)
