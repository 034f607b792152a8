"""Preference queries: comparisons from conversations, pair rows, tournaments, win rates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions import graders
from kiln.operators import prefs, rollouts
from kiln.plans.registry import query
from kiln.sources.tables import messages, table

PLAYERS_SQL = """
pl AS (
  SELECT o_custkey AS group_id, o_orderkey, o_totalprice AS len,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS BIGINT) AS idx
  FROM orders)
"""


def _players(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("group_id"), "o_orderkey", F.col("o_totalprice").alias("len"))
    w = Window.partitionBy("group_id").orderBy("o_orderkey")
    return o.withColumn("idx", (F.row_number().over(w) - 1).cast("long"))


@query("tournament_pairs", "J6 P1 P2 P3", f"""
WITH {PLAYERS_SQL}
SELECT a.group_id, a.idx AS idx_i, b.idx AS idx_j, 'one_way' AS pattern FROM pl a JOIN pl b
  ON a.group_id = b.group_id AND a.idx // 4 = b.idx // 4 AND a.idx < b.idx
UNION ALL
SELECT a.group_id, a.idx, b.idx, 'both_ways' FROM pl a JOIN pl b
  ON a.group_id = b.group_id AND a.idx // 3 = b.idx // 3 AND a.idx <> b.idx
""")
def tournament_pairs(spark, sf_dir):
    """Chunked matchups per customer (one way / chunks of 4, both ways / chunks of 3)."""
    p = _players(spark, sf_dir).select("group_id", "idx")
    one = prefs.tournament_pairs(p, "group_id", "idx", "all_pairs_one_way", 4).withColumn("pattern", F.lit("one_way"))
    both = prefs.tournament_pairs(p, "group_id", "idx", "all_pairs_both_ways", 3).withColumn("pattern", F.lit("both_ways"))
    return one.unionByName(both)


@query("tournament_rewards", "P5 G20 U6", f"""
WITH {PLAYERS_SQL},
m AS (SELECT a.group_id, a.idx AS i, b.idx AS j, sign(a.len - b.len) AS r FROM pl a JOIN pl b
      ON a.group_id = b.group_id AND a.idx // 4 = b.idx // 4 AND a.idx < b.idx),
c AS (SELECT group_id, j AS idx, r FROM m UNION ALL SELECT group_id, i, -r FROM m),
s AS (SELECT group_id, idx, sum(r) AS s, count(*) AS n FROM c GROUP BY 1, 2)
SELECT pl.group_id, pl.idx, CAST(coalesce(s.n, 0) AS BIGINT) AS n_matches,
       round(CAST(s.s AS DOUBLE) / s.n + 1.0 * ((CASE WHEN pl.o_orderkey % 7 = 0 THEN 0.0 ELSE 1.0 END) - 1.0), 6) AS reward
FROM pl LEFT JOIN s ON pl.group_id = s.group_id AND pl.idx = s.idx
""")
def tournament_rewards(spark, sf_dir):
    """P5: win-minus-loss per player with shorter-is-better scoring (G20); singles → null."""
    p = _players(spark, sf_dir)
    m = prefs.tournament_pairs(p, "group_id", "idx", "all_pairs_one_way", 4)
    m = m.withColumn("r", graders.shorter_preference(F.col("len_i"), F.col("len_j")))
    valid = p.select("group_id", "idx", (F.col("o_orderkey") % 7 != 0).alias("is_valid"))
    out = prefs.win_minus_loss(m, "group_id", "idx", "r", valid)
    return out.select("group_id", "idx", F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches"), F.round("reward", 6).alias("reward"))


CMP_SQL = """
r AS (
  SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k
  FROM conversations WHERE role = 'assistant'),
cmp AS (
  SELECT conv_id || '-' || k AS pair_id, conv_id, turn, text AS ca, next AS cb,
         CASE WHEN length(text) < length(next) THEN 'A' WHEN length(text) > length(next) THEN 'B' ELSE 'Tie' END AS label
  FROM r WHERE next IS NOT NULL)
"""

PROMPT_SQL = """
pr AS (
  SELECT pair_id, md5(coalesce(string_agg(c.role || ':' || c.text, chr(10) ORDER BY c.turn), '')) AS prompt_md5
  FROM cmp LEFT JOIN conversations c ON c.conv_id = cmp.conv_id AND c.turn < cmp.turn GROUP BY pair_id)
"""


def _comparisons(spark, sf_dir):
    """Every assistant reply against the next one of its conversation, after the turns before it (shorter preferred)."""
    m = messages(spark, sf_dir)
    # the prompt of a pair is what came before: each reply takes it from a join, no conversation is gathered to rank it
    reply = m.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("content").alias("ca"))
    w = Window.partitionBy("conv_id").orderBy("turn")
    pair = reply.withColumn("cb", F.lead("ca").over(w)).withColumn("k", F.row_number().over(w)).filter(F.col("cb").isNotNull())
    earlier = m.select("conv_id", F.col("turn").alias("_t"), "role", "content")
    before = pair.select("conv_id", "turn").join(earlier, "conv_id").filter(F.col("_t") < F.col("turn"))
    before = before.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("_t", "role", "content"))).alias("_p"))
    prompt = F.transform("_p", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    pair = pair.join(before.select("conv_id", "turn", prompt.alias("prompt")), ["conv_id", "turn"], "left")
    score = graders.shorter_preference(F.length("ca"), F.length("cb"))
    label = F.when(score < 0, "A").when(score > 0, "B").otherwise("Tie")
    msg = lambda c: F.array(F.struct(F.lit("assistant").alias("role"), F.col(c).alias("content")))
    prompt = F.coalesce("prompt", F.array().cast("array<struct<role:string,content:string>>"))
    return pair.select(
        F.concat_ws("-", "conv_id", "k").alias("pair_id"),
        F.struct(prompt.alias("prompt"), msg("ca").alias("completion_a"), msg("cb").alias("completion_b"), label.alias("label")).alias("cmp"),
    )


@query("dpo_pairs", "D18 D19 D20 D21 G21", f"""
WITH {CMP_SQL}, {PROMPT_SQL},
sw AS (SELECT pair_id, ca, cb, label, 0 AS swapped FROM cmp
       UNION ALL SELECT pair_id, cb, ca, CASE WHEN label = 'A' THEN 'B' WHEN label = 'B' THEN 'A' ELSE label END, 1 FROM cmp),
d AS (
  SELECT pair_id, CAST(swapped AS BIGINT) AS swapped, 'chosen' AS side,
         md5(CASE WHEN label = 'A' THEN ca ELSE cb END) AS completion_md5,
         CASE WHEN label = 'A' THEN -1.0 WHEN label = 'B' THEN 1.0 ELSE 0.0 END AS label_score FROM sw
  UNION ALL
  SELECT pair_id, swapped, 'rejected', md5(CASE WHEN label = 'A' THEN cb ELSE ca END),
         CASE WHEN label = 'A' THEN -1.0 WHEN label = 'B' THEN 1.0 ELSE 0.0 END FROM sw)
SELECT d.*, prompt_md5 FROM d JOIN pr USING (pair_id)
""")
def dpo_pairs(spark, sf_dir):
    """Each assistant reply against the next (shorter preferred) after its prompt, both orders, chosen/rejected rows."""
    c = prefs.swap_augment(_comparisons(spark, sf_dir), "cmp", both=True)
    rows = prefs.chosen_rejected(c, "cmp")
    said = F.transform("prompt", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return rows.select(
        "pair_id", "swapped", "side",
        F.md5(F.element_at("completion", 1)["content"]).alias("completion_md5"),
        graders.label_score(F.col("label")).alias("label_score"),
        F.md5(F.array_join(said, "\n")).alias("prompt_md5"),
    )


@query("swapped_comparisons", "D18 D19", f"""
WITH {CMP_SQL},
h AS (SELECT *, CAST(('0x' || substr(md5('3:' || pair_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.5 AS s FROM cmp)
SELECT pair_id, md5(CASE WHEN s THEN cb ELSE ca END) AS a_md5, md5(CASE WHEN s THEN ca ELSE cb END) AS b_md5,
       CASE WHEN NOT s OR label = 'Tie' THEN label WHEN label = 'A' THEN 'B' ELSE 'A' END AS label FROM h
""")
def swapped_comparisons(spark, sf_dir):
    """Each comparison once, its sides swapped with probability one half by a hash of its id."""
    c = prefs.swap_augment(_comparisons(spark, sf_dir), "cmp", both=False, seed=3)
    digest = lambda side: F.md5(F.element_at(f"cmp.{side}", 1)["content"])
    return c.select("pair_id", digest("completion_a").alias("a_md5"), digest("completion_b").alias("b_md5"), F.col("cmp.label").alias("label"))


@query("win_rate", "A19", f"""
WITH {CMP_SQL},
s AS (SELECT pair_id, CASE WHEN length(ca) <= length(cb) + 100 THEN -1.0 ELSE 1.0 END AS r0,
             CASE WHEN length(cb) <= length(ca) + 100 THEN -1.0 ELSE 1.0 END AS r1 FROM cmp)
SELECT round(avg((r0 - r1 + 2) / 4), 6) AS win_rate, round(stddev_pop((r0 - r1 + 2) / 4) / sqrt(count(*)), 6) AS stderr, count(*) AS n FROM s
""")
def win_rate(spark, sf_dir):
    """Win rate of completion B from both presentation orders, by a judge that leans to what it sees first.

    It takes the first completion unless that is more than 100 characters longer, so the two orders don't mirror each other."""
    c = _comparisons(spark, sf_dir)

    def judged(cmp):
        n = lambda side: F.length(F.element_at(cmp[side], 1)["content"])
        return F.when(n("completion_a") <= n("completion_b") + 100, F.lit(-1.0)).otherwise(F.lit(1.0)).alias("score")

    ab = c.select("pair_id", judged(F.col("cmp")))
    ba = c.select("pair_id", judged(prefs.swap(F.col("cmp"))))
    w = rollouts.win_rate(ab, ba, "pair_id")
    return w.select(F.round("win_rate", 6).alias("win_rate"), F.round("stderr", 6).alias("stderr"), "n")


@query("preference_rows", "R18 R19 R1 R4", f"""
WITH {CMP_SQL},
msgs AS (
  SELECT pair_id, -1 AS seat, c.role AS role, c.text AS content FROM cmp JOIN conversations c ON c.conv_id = cmp.conv_id AND c.turn < cmp.turn
  UNION ALL SELECT pair_id, 0, 'system', '{prefs.MARK_A}' FROM cmp
  UNION ALL SELECT pair_id, 1, 'assistant', ca FROM cmp
  UNION ALL SELECT pair_id, 2, 'system', '{prefs.MARK_B}' FROM cmp
  UNION ALL SELECT pair_id, 3, 'assistant', cb FROM cmp
  UNION ALL SELECT pair_id, 4, 'system', '{prefs.MARK_PREF}' FROM cmp
  UNION ALL SELECT pair_id, 5, 'assistant', label FROM cmp),
seg AS (
  SELECT pair_id, seat, '<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) AS ob,
         content || '<|eot_id|>' AS ac FROM msgs)
SELECT pair_id,
       CAST(1 + sum(length(regexp_replace(ob, '<\\|[a-z_]+\\|>|<｜[^｜]+｜>|[A-Za-z0-9]+', 'a', 'g')))
              + sum(CASE WHEN seat < 5 THEN length(regexp_replace(ac, '<\\|[a-z_]+\\|>|<｜[^｜]+｜>|[A-Za-z0-9]+', 'a', 'g')) ELSE 0 END) + 1 AS BIGINT) AS n_tokens,
       max(CASE WHEN seat = 5 THEN regexp_extract(ac, '(<\\|[a-z_]+\\|>|<｜[^｜]+｜>|[A-Za-z0-9]+|[^A-Za-z0-9])', 1) END) AS trained_piece
FROM seg GROUP BY pair_id
""")
def preference_rows(spark, sf_dir):
    """R18 comparison with its prompt → conversation with markers + label reply; R19 cut at the first trained token."""
    from kiln.operators import adapters, render

    c = _comparisons(spark, sf_dir)
    label_msg = F.array(F.struct(F.lit("assistant").alias("role"), F.col("cmp.label").alias("content")))
    conv = c.select(F.col("pair_id").alias("conv_id"), F.concat(prefs.comparison_to_conversation(F.col("cmp")), label_msg).alias("messages"))
    segs = render.render_segments(adapters.explode_conversations(conv), "llama3", "last_assistant_message")
    d = render.supervised_datums(segs)
    toks, wts = prefs.preference_row(d["tokens"], F.concat(F.array(F.lit(0.0).cast("float")), d["weights"]))
    return d.select(F.col("conv_id").alias("pair_id"), F.size(toks).cast("long").alias("n_tokens"),
                    F.element_at(toks, -1).alias("trained_piece"))
