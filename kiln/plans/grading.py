"""Grading queries: responses ⋈ problems (G*), QA accuracy, logged game turns."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from kiln.functions import graders, math_grade
from kiln.operators import rollouts, split
from kiln.plans.registry import query
from kiln.sources.tables import numbered_items, table

G2_SQL = """trim(replace(ltrim(trim(substr(list_filter(list_transform(string_split({t}, chr(10)), lambda l: trim(l)), lambda l: starts_with(l, '####'))[-1], 5)), ':'), ',', ''))"""


def _problems(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("problem_id"),
        F.concat(F.lit("How big is "), F.col("p_name"), F.lit("?")).alias("question"),
        F.concat(F.col("p_name"), F.lit("\n#### "), F.col("p_size").cast("string")).alias("answer"),
        "p_size",
    )


def _responses(problems):
    r = split.replicate(problems.select("problem_id", "p_size"), 4)
    s = F.col("p_size").cast("string")
    text = (
        F.when(F.col("sample_idx") == 0, F.concat(F.lit("so \\boxed{"), s, F.lit("}")))
        .when(F.col("sample_idx") == 1, F.concat(F.lit("so \\boxed{"), (F.col("p_size") + 1).cast("string"), F.lit("}")))
        .when(F.col("sample_idx") == 2, F.concat(F.lit("the answer is "), s))
        .otherwise(F.concat(F.lit("\\boxed{x} then \\boxed{"), s, F.lit("}")))
    )
    return r.select("problem_id", "sample_idx", text.alias("response"))


@query("grade_responses", "J8 G1 G2 G3 G11 G13 G14 D17", f"""
WITH pr AS (SELECT p_partkey AS problem_id, p_name || chr(10) || '#### ' || p_size AS answer, p_size FROM part),
rs AS (
  SELECT problem_id, CAST(s AS BIGINT) AS sample_idx,
         CASE s WHEN 0 THEN 'so \\boxed{{' || p_size || '}}' WHEN 1 THEN 'so \\boxed{{' || (p_size + 1) || '}}'
                WHEN 2 THEN 'the answer is ' || p_size ELSE '\\boxed{{x}} then \\boxed{{' || p_size || '}}' END AS response
  FROM pr, range(0, 4) t(s)),
g AS (
  SELECT rs.problem_id, sample_idx, regexp_extract_all(response, '\\\\boxed\\{{([^{{}}]*)\\}}', 1)[-1] AS given,
         {G2_SQL.format(t='answer')} AS truth
  FROM rs JOIN pr ON rs.problem_id = pr.problem_id)
SELECT problem_id, sample_idx, given, truth, coalesce(given = truth, false) AS correct,
       round(0.1 * ((CASE WHEN given IS NOT NULL THEN 1.0 ELSE 0.0 END) - 1.0) + (CASE WHEN given = truth THEN 1.0 ELSE 0.0 END), 6) AS reward
FROM g
""")
def grade_responses(spark, sf_dir):
    """Responses ⋈ problems: boxed answer (G1) vs GSM8K reference (G2), grade (G11), reward."""
    pr = _problems(spark, sf_dir)
    rs = _responses(pr)
    # answers are texts and as many as the responses' problems: never broadcast, however small the file looks
    j = rs.join(pr.select("problem_id", "answer").hint("merge"), "problem_id")
    j = j.withColumn("given", math_grade.extract_boxed(F.col("response"))).withColumn("truth", graders.gsm8k_answer(F.col("answer")))
    j = j.withColumn("correct", math_grade.grade_answer(F.col("given"), F.col("truth")))
    return j.select("problem_id", "sample_idx", "given", "truth", "correct",
                    F.round(graders.format_reward(F.col("correct"), F.col("given").isNotNull()), 6).alias("reward"))


def _forms(n, m):
    """(given, truth) per form: answers about number ``n`` held against a truth about ``m``."""
    a, b = (F.pmod(x.cast("int"), F.lit(9)) + 1 for x in (n, m))
    c = lambda *parts: F.concat(*[x if isinstance(x, Column) else F.lit(x) for x in parts])
    return [
        (c("\\frac{", n, "}{7}"), c(m, "/7")),
        (c(n, " cm"), m),
        (c("(1, ", n, ")"), c("(1,", m, ")")),
        (c("[1, ", n, ")"), c("(1,", m, ")")),
        (c("x = ", n, "\\%"), m),
        (c("1,", F.lpad(n, 3, "0")), c("1", F.lpad(m, 3, "0"))),
        (c("\\dfrac", a.cast("string"), "3"), c("\\frac{", b.cast("string"), "}{3}")),
        (c(n, ".5"), m),
        (c(n, " million"), c(m, "*10^6")),
        (c("(", n, "/3, 1/2]"), c("( ", m, "/3 , 1/2 ]")),
        (c("\\sqrt", a.cast("string")), c("\\sqrt{", b.cast("string"), "}")),
        (c(n, "\\text{ apples}"), m),
        (c("\\text{Big ", n, "}"), c("big ", m)),
    ]


@query("answer_forms", "G7 G8 G9 G10 G11", """
WITH f AS (SELECT p_partkey AS item_id, CAST(s AS BIGINT) AS form, CAST(p_size AS VARCHAR) AS n,
                  CAST(p_size % 9 + 1 AS VARCHAR) AS a, p_partkey % 2 = 0 AS same FROM part, range(0, 13) t(s))
SELECT item_id, form,
       CASE form WHEN 0 THEN '\\frac{' || n || '}{7}' WHEN 1 THEN n || 'cm' WHEN 2 THEN '(1,' || n || ')' WHEN 3 THEN '[1,' || n || ')'
         WHEN 4 THEN n WHEN 5 THEN '1,' || lpad(n, 3, '0') WHEN 6 THEN '\\frac{' || a || '}{3}' WHEN 7 THEN n || '.5'
         WHEN 8 THEN n || 'million' WHEN 9 THEN '(' || n || '/3,1/2]' WHEN 10 THEN '\\sqrt{' || a || '}' WHEN 11 THEN n
         ELSE 'Big' || n END AS cleaned,
       n IS NOT NULL AND same AND form NOT IN (3, 7) AS correct
FROM f
""")
def answer_forms(spark, sf_dir):
    """G7-G11 over part sizes written in thirteen forms (fractions, units, tuples, commas, roots, scale words);
    the truth is the same size for even keys and the next one for odd keys."""
    # two narrow columns are dealt anew: the rules cost far more than the rows, and a small table is one scan task
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    p = split.replicate(table(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(tasks, "p_partkey"), 13)
    n = F.col("p_size").cast("string")
    m = (F.col("p_size") + F.pmod("p_partkey", F.lit(2))).cast("string")
    forms = F.array(*[F.struct(g.alias("given"), t.alias("truth")) for g, t in _forms(n, m)])
    f = p.withColumn("f", F.element_at(forms, F.col("sample_idx").cast("int") + 1))
    return f.select(
        F.col("p_partkey").alias("item_id"), F.col("sample_idx").cast("long").alias("form"),
        math_grade.normalize_answer(F.col("f.given")).alias("cleaned"),
        math_grade.grade_answer(F.col("f.given"), F.col("f.truth")).alias("correct"),
    )


@query("problem_accuracy", "A15 G13", """
WITH pr AS (SELECT p_partkey AS problem_id, p_size FROM part),
rs AS (SELECT problem_id, s, CASE WHEN s = 0 OR s = 3 THEN 1.0 ELSE 0.0 END AS c FROM pr, range(0, 4) t(s))
SELECT round(avg(m), 6) AS mean_correct FROM (SELECT problem_id, avg(c) AS m FROM rs GROUP BY problem_id)
""")
def problem_accuracy(spark, sf_dir):
    """A15 over G13 rewards: mean per problem, then over problems."""
    g = grade_responses(spark, sf_dir).withColumn("c", F.col("correct").cast("double"))
    return rollouts.two_level_mean(g, "problem_id", "c").select(F.round("mean_c", 6).alias("mean_correct"))


QA_SQL = """
q AS (
  SELECT p_partkey AS item_id, split_part(p_type, ' ', 1) AS source, [p_name, p_brand] AS golds,
         CASE p_size % 3 WHEN 0 THEN 'Answer: The ' || p_name || '.' WHEN 1 THEN 'Answer: ' || p_brand || ' Answer: again'
              ELSE 'I do not know' END AS response
  FROM part),
x AS (SELECT *, CASE WHEN len(string_split(response, 'Answer:')) = 2 THEN trim(string_split(response, 'Answer:')[2]) END AS pred FROM q),
n AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(lower(pred), '[!-/:-@\\[-`{-~]', '', 'g'), '\\b(a|an|the)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS np FROM x),
s AS (SELECT *, coalesce(pred IS NOT NULL AND len(golds) > 0 AND
         len(list_filter(golds, lambda g: trim(regexp_replace(regexp_replace(regexp_replace(lower(g), '[!-/:-@\\[-`{-~]', '', 'g'), '\\b(a|an|the)\\b', ' ', 'g'), '\\s+', ' ', 'g')) = np)) > 0, false) AS correct
      FROM n)
"""


def _qa(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    resp = (
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("Answer: The "), F.col("p_name"), F.lit(".")))
        .when(F.col("p_size") % 3 == 1, F.concat(F.lit("Answer: "), F.col("p_brand"), F.lit(" Answer: again")))
        .otherwise(F.lit("I do not know"))
    )
    q = p.select(F.col("p_partkey").alias("item_id"), F.element_at(F.split("p_type", " "), 1).alias("source"),
                 F.array("p_name", "p_brand").alias("golds"), resp.alias("response"))
    q = q.withColumn("pred", graders.answer_after_marker(F.col("response")))
    return q.withColumn("correct", graders.exact_match_any(F.col("pred"), F.col("golds")))


@query("qa_grading", "G4a G5 G6 G14", f"""
WITH {QA_SQL}
SELECT item_id, pred, correct, round(0.1 * ((CASE WHEN pred IS NOT NULL THEN 1.0 ELSE 0.0 END) - 1.0) + CASE WHEN correct THEN 1.0 ELSE 0.0 END, 6) AS reward
FROM s
""")
def qa_grading(spark, sf_dir):
    """Single `Answer:` extraction, normalised exact match against gold answers, reward."""
    q = _qa(spark, sf_dir)
    return q.select("item_id", "pred", "correct", F.round(graders.format_reward(F.col("correct"), F.col("pred").isNotNull()), 6).alias("reward"))


@query("qa_accuracy_by_source", "A16", f"""
WITH {QA_SQL}
SELECT source, CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS DOUBLE) AS correct, count(*) AS total,
       round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM s GROUP BY source
UNION ALL
SELECT 'OVERALL', CAST(sum(CASE WHEN correct THEN 1 ELSE 0 END) AS DOUBLE), count(*), round(avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END), 6) FROM s
""")
def qa_accuracy_by_source(spark, sf_dir):
    """QA accuracy per source + OVERALL."""
    q = _qa(spark, sf_dir).withColumn("score", F.col("correct").cast("double"))
    return rollouts.accuracy_by_source(q, "source", "score").withColumn("accuracy", F.round("accuracy", 6))


@query("text_graders", "G4b G16", """
SELECT p_partkey AS item_id,
       nullif(regexp_extract('Final Answer: ' || p_brand, 'Final Answer: (\\w+)', 1), '') AS final_word,
       contains(lower(p_name || ' ' || p_type), lower(split_part(p_type, ' ', 2))) AS contains_ok
FROM part
""")
def text_graders(spark, sf_dir):
    """G4b `Final Answer:` word and G16 case-insensitive containment grader."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        graders.final_answer_word(F.concat(F.lit("Final Answer: "), F.col("p_brand"))).alias("final_word"),
        graders.contains_ci(F.concat_ws(" ", "p_name", "p_type"),
                            F.coalesce(F.try_element_at(F.split("p_type", " "), F.lit(2)), F.lit(""))).alias("contains_ok"),
    )


#: Turns after which a number-guess episode ends.
MAX_TURNS = 10


@query("game_turns", "G17 G19 G22 G23 W5 W6", """
WITH t AS (
  SELECT l_orderkey AS traj_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS turn,
         CASE WHEN l_returnflag = 'N' THEN 'I pass' ELSE 'Guess: ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS text,
         l_suppkey % 2 AS player, l_returnflag = 'A' AS is_call
  FROM lineitem),
r AS (
  SELECT *, CASE WHEN TRY_CAST(regexp_extract(text, '^Guess: (.*)', 1) AS BIGINT) IS NULL OR NOT starts_with(text, 'Guess: ') THEN -1.0
                 WHEN TRY_CAST(regexp_extract(text, '^Guess: (.*)', 1) AS BIGINT) = 25 THEN 1.0 ELSE 0.0 END AS reward,
         player = lag(player) OVER (PARTITION BY traj_id ORDER BY turn) AS illegal,
         sum(CASE WHEN is_call THEN 1 ELSE 0 END) OVER (PARTITION BY traj_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_calls
  FROM t),
w AS (SELECT *, min(CASE WHEN reward = 1.0 THEN turn END) OVER (PARTITION BY traj_id) AS first_win FROM r)
SELECT traj_id, CAST(turn AS BIGINT) AS turn, reward,
       CASE WHEN coalesce(illegal, false) THEN -2.0 ELSE reward END AS player_reward,
       CASE WHEN n_calls > 4 THEN 0.0 ELSE reward END AS tool_reward, n_calls > 4 AS tool_done
FROM w WHERE turn <= least(coalesce(first_win, 10), 10)
""")
def game_turns(spark, sf_dir):
    """Logged game turns: number-guess reward (G17), episode cut at first win or turn 10 (G19),
    illegal consecutive mover (G22) and tool-call cap (G23)."""
    li = numbered_items(spark, sf_dir, step="turn")
    t = li.select(
        "traj_id", "turn",
        F.when(F.col("l_returnflag") == "N", F.lit("I pass")).otherwise(
            F.concat(F.lit("Guess: "), F.col("l_quantity").cast("long").cast("string"))).alias("text"),
        F.pmod("l_suppkey", F.lit(2)).alias("player"), (F.col("l_returnflag") == "A").alias("is_call"),
    )
    w = Window.partitionBy("traj_id").orderBy("turn")
    t = t.withColumn("reward", graders.number_guess_reward(F.col("text"), F.lit(25)))
    t = t.withColumn("illegal", F.coalesce(F.col("player") == F.lag("player").over(w), F.lit(False)))
    t = t.withColumn("n_calls", F.sum(F.col("is_call").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    t = t.withColumn("first_win", F.min(F.when(F.col("reward") == 1.0, F.col("turn"))).over(Window.partitionBy("traj_id")))
    t = t.filter(F.col("turn") <= F.least(F.coalesce("first_win", F.lit(MAX_TURNS)), F.lit(MAX_TURNS)))
    return t.select(
        "traj_id", "turn", "reward",
        F.when(F.col("illegal"), F.lit(-2.0)).otherwise(F.col("reward")).alias("player_reward"),
        F.when(F.col("n_calls") > 4, F.lit(0.0)).otherwise(F.col("reward")).alias("tool_reward"),
        (F.col("n_calls") > 4).alias("tool_done"),
    )
