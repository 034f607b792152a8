"""Source adapters and decontamination queries (N*, S*, D12/D13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import adapters as ad
from kiln.operators import decontam, split
from kiln.operators.ranking import md5_unit
from kiln.plans.registry import query
from kiln.sources.tables import messages, table

SPLIT_SQL = "CAST(('0x' || substr(md5('9:' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.5"


def _doc_halves(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    is_test = md5_unit(9, "doc_id") < 0.5
    return d.filter(~is_test), d.filter(is_test)


@query("decontaminate_documents", "D12 D13 J1 J2", f"""
WITH tr AS (SELECT doc_id, text FROM documents WHERE NOT ({SPLIT_SQL})),
te AS (SELECT doc_id, text FROM documents WHERE {SPLIT_SQL})
SELECT doc_id FROM tr WHERE text NOT IN (SELECT text FROM te)
""")
def decontaminate_documents(spark, sf_dir):
    """Training half of documents minus every text of the test half (exact match)."""
    train, test = _doc_halves(spark, sf_dir)
    return decontam.decontaminate(train, test).select("doc_id")


@query("contamination_check", "D13 J2", f"""
WITH tr AS (SELECT doc_id, text FROM documents WHERE NOT ({SPLIT_SQL})),
te AS (SELECT doc_id, text FROM documents WHERE {SPLIT_SQL}),
kept AS (SELECT doc_id, text FROM tr WHERE text NOT IN (SELECT text FROM te))
SELECT (SELECT count(*) FROM tr) AS n_train, (SELECT count(*) FROM tr WHERE text IN (SELECT text FROM te)) AS n_contaminated,
       (SELECT count(*) FROM kept WHERE text IN (SELECT text FROM te)) AS n_left
""")
def contamination_check(spark, sf_dir):
    """Contaminated rows before and after decontamination (after must be 0)."""
    train, test = _doc_halves(spark, sf_dir)
    kept = decontam.decontaminate(train, test)
    n_train = train.agg(F.count(F.lit(1))).scalar()
    before = decontam.contaminated(train, test).agg(F.count(F.lit(1))).scalar()
    after = decontam.contaminated(kept, test).agg(F.count(F.lit(1)).alias("n_left"))
    return after.select(n_train.alias("n_train"), before.alias("n_contaminated"), "n_left")


@query("sharegpt_messages", "N1", """
SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN role = 'user' THEN 'user' ELSE 'assistant' END AS role, md5(text) AS content_md5
FROM conversations
""")
def sharegpt_messages(spark, sf_dir):
    """ShareGPT rows (from/value) built from conversations, mapped back to messages."""
    m = messages(spark, sf_dir)
    sg = m.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        "turn", F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "gpt").otherwise(F.col("role")).alias("from"),
        F.col("content").alias("value")))).alias("conversations"))
    conv = sg.select("conv_id", ad.sharegpt_to_messages(F.col("conversations")).alias("messages"))
    long = ad.explode_conversations(conv)
    return long.select("conv_id", "turn", "role", F.md5("content").alias("content_md5"))


HH_SQL = """
tx AS (
  SELECT conv_id,
         string_agg(CASE role WHEN 'user' THEN chr(10) || chr(10) || 'Human: ' WHEN 'assistant' THEN chr(10) || chr(10) || 'Assistant: ' ELSE '' END || text, '' ORDER BY turn) AS chosen,
         string_agg(CASE role WHEN 'user' THEN chr(10) || chr(10) || 'Human: ' WHEN 'assistant' THEN chr(10) || chr(10) || 'Assistant: ' ELSE '' END ||
                    CASE WHEN is_last AND conv_id % 3 <> 0 THEN text || ' (worse)' ELSE text END, '' ORDER BY turn)
                    FILTER (WHERE NOT (is_last AND conv_id % 5 = 0)) AS rejected
  FROM (SELECT *, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last FROM conversations)
  GROUP BY conv_id)
"""


def _hh_transcripts(spark, sf_dir):
    m = messages(spark, sf_dir)
    last = m.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    m = m.join(last, "conv_id").withColumn("is_last", F.col("turn") == F.col("_last"))
    marker = F.when(F.col("role") == "user", F.lit("\n\nHuman: ")).when(F.col("role") == "assistant", F.lit("\n\nAssistant: ")).otherwise(F.lit(""))
    rej_text = F.when(F.col("is_last") & (F.col("conv_id") % 3 != 0), F.concat("content", F.lit(" (worse)"))).otherwise(F.col("content"))
    keep_rej = ~(F.col("is_last") & (F.col("conv_id") % 5 == 0))
    g = m.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", F.concat(marker, F.col("content")).alias("s")))).alias("_c"),
        F.array_sort(F.collect_list(F.when(keep_rej, F.struct("turn", F.concat(marker, rej_text).alias("s"))))).alias("_r"),
    )
    j = lambda c: F.array_join(F.transform(c, lambda x: x["s"]), "")
    return g.select("conv_id", j("_c").alias("chosen"), j("_r").alias("rejected"))


@query("hh_pairs", "N5 N6 S3 D21", f"""
WITH {HH_SQL},
parts AS (
  SELECT conv_id, 'c' AS side, string_split(regexp_replace(chosen, '(Human:|Assistant:)', chr(1) || '\\1' || chr(2), 'g'), chr(1)) AS p FROM tx
  UNION ALL
  SELECT conv_id, 'r', string_split(regexp_replace(rejected, '(Human:|Assistant:)', chr(1) || '\\1' || chr(2), 'g'), chr(1)) FROM tx),
msgs AS (
  SELECT conv_id, side,
         CASE WHEN regexp_replace(p[1], '^\\s+|\\s+$', '', 'g') = '' THEN
           list_transform(p[2:], lambda e: {{'role': CASE WHEN split_part(e, chr(2), 1) = 'Human:' THEN 'user' ELSE 'assistant' END,
                                            'content': regexp_replace(substr(e, strpos(e, chr(2)) + 1), '^\\s+|\\s+$', '', 'g')}})
         ELSE [] END AS m
  FROM parts),
pr AS (SELECT c.conv_id, c.m AS a, r.m AS b FROM msgs c JOIN msgs r ON c.conv_id = r.conv_id AND c.side = 'c' AND r.side = 'r')
SELECT conv_id, CAST(len(a) - 1 AS BIGINT) AS n_prompt, md5(a[len(a)].content) AS chosen_md5, md5(b[len(b)].content) AS rejected_md5
FROM pr
WHERE len(a) = len(b) AND len(a) >= 1 AND a[1:len(a) - 1] = b[1:len(b) - 1] AND a[len(a)] <> b[len(b)]
""")
def hh_pairs(spark, sf_dir):
    """N5 + N6: Human/Assistant transcripts parsed back; pairs kept when only the last message differs."""
    t = _hh_transcripts(spark, sf_dir)
    c = t.select("conv_id", ad.hh_pair(ad.hh_parse(F.col("chosen")), ad.hh_parse(F.col("rejected"))).alias("comparison"),
                 F.lit("A").alias("label"))
    c = ad.drop_incomplete_comparisons(c)
    return c.select(
        "conv_id", F.size("comparison.prompt").cast("long").alias("n_prompt"),
        F.md5(F.element_at("comparison.completion_a", 1)["content"]).alias("chosen_md5"),
        F.md5(F.element_at("comparison.completion_b", 1)["content"]).alias("rejected_md5"),
    )


@query("helpsteer2_pairs", "N12", """
WITH r AS (SELECT l_partkey AS prompt, l_orderkey || '-' || l_linenumber || '-' || l_suppkey || '-' || l_quantity AS response,
                  l_quantity AS h, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem),
g AS (SELECT prompt, count(*) AS n, max(h) AS hi, min(h) AS lo,
             arg_max(response, (h, -l_orderkey, -l_linenumber, -l_suppkey, -l_quantity)) AS chosen_response,
             arg_max(response, (-h, l_orderkey, l_linenumber, l_suppkey, l_quantity)) AS rejected_response FROM r GROUP BY prompt)
SELECT prompt, chosen_response, rejected_response, hi - lo AS helpfulness_diff FROM g WHERE n >= 2 AND hi > lo
""")
def helpsteer2_pairs(spark, sf_dir):
    """Best vs worst response per prompt (part key), score = quantity, stable ties."""
    li = table(spark, sf_dir, "lineitem")
    r = li.select(
        F.col("l_partkey").alias("prompt"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")]).alias("response"),
        F.col("l_quantity").alias("h"), "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
    )
    return ad.best_vs_worst(r, "prompt", "response", "h", ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])


@query("history_truncation", "N19 N23 N24", """
WITH c AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, CASE WHEN len(m) > 4 THEN list_concat(m[1:1], m[len(m) - 2:]) ELSE m END AS m FROM c)
SELECT conv_id, CAST(len(m) AS BIGINT) AS n_messages,
       CASE m[1].role WHEN 'assistant' THEN 'player' WHEN 'user' THEN 'answerer' ELSE m[1].role END AS first_role,
       md5(regexp_replace(m[len(m)].content, '^\\s+|\\s+$', '', 'g')) AS last_md5
FROM t
""")
def history_truncation(spark, sf_dir):
    """N24 (keep first + last 3 when longer than 4), N23 role remap, N19 strip."""
    conv = ad.conversation_arrays(messages(spark, sf_dir))
    m = ad.truncate_history(F.col("messages"), 4)
    m = ad.strip_messages(ad.role_remap(m, {"assistant": "player", "user": "answerer"}))
    c = conv.select("conv_id", m.alias("m"))
    return c.select("conv_id", F.size("m").cast("long").alias("n_messages"), F.element_at("m", 1)["role"].alias("first_role"),
                    F.md5(F.element_at("m", -1)["content"]).alias("last_md5"))


@query("helpsteer3_labels", "N8", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_linenumber - 4 < 0 THEN 'A' ELSE 'B' END AS label
FROM lineitem WHERE l_linenumber - 4 <> 0
""")
def helpsteer3_labels(spark, sf_dir):
    """Overall preference = line number − 4; 0 dropped, < 0 → A, > 0 → B."""
    li = table(spark, sf_dir, "lineitem")
    lab = ad.helpsteer3_label(F.col("l_linenumber") - 4)
    return li.select("l_orderkey", F.col("l_linenumber").cast("long"), "l_partkey", "l_suppkey", lab.alias("label")).filter(
        F.col("label").isNotNull())


TEMPLATE = "Decide the language of the text below.\nText: {text}\nFinal Answer:"


@query("problem_rows", "N13 N16 N21", """
SELECT p_partkey AS problem_id,
       'Decide the language of the text below.' || chr(10) || 'Text: ' || p_name || chr(10) || 'Final Answer:' AS prompt,
       CAST(p_size AS VARCHAR) AS answer, 'default' AS task
FROM part WHERE p_size % 5 <> 0 AND p_name <> ''
""")
def problem_rows(spark, sf_dir):
    """N13 drop rows with empty problem/answer; N16 optional columns with defaults; N21 template fill."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("problem_id"), F.col("p_name").alias("problem"),
        F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_size").cast("string")).alias("answer"),
    )
    p = p.filter(ad.non_empty("problem", "answer"))
    p = ad.optional_columns(p, {"answer": "", "task": "default"})
    return p.select("problem_id", ad.fill_template(TEMPLATE, F.col("problem")).alias("prompt"), "answer", "task")
