"""Supervised fine-tuning preparation queries (S, W1, R, D, A21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import render, split
from kiln.plans.registry import query
from kiln.sources.tables import messages, rich_messages, table

from kiln.plans.sqlgen import NL2, ntok

ROLE_COLON_SEGMENTS = f"""
m AS (
  SELECT conv_id, turn, role, text AS content,
         turn = min(turn) OVER (PARTITION BY conv_id) AS is_first,
         turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
  FROM conversations),
seg AS (
  SELECT conv_id, turn, 0 AS part, upper(substr(role, 1, 1)) || lower(substr(role, 2)) || ':' AS text, 0 AS weight FROM m
  UNION ALL
  SELECT conv_id, turn, 1 AS part,
         ' ' || content || {NL2} || CASE WHEN is_last THEN CASE WHEN role = 'assistant' THEN 'User:' ELSE '<UNUSED>' END ELSE '' END,
         CASE WHEN role = 'assistant' THEN 1 ELSE 0 END FROM m),
tok AS (SELECT *, {ntok('text')} AS n FROM seg WHERE length(text) > 0),
per AS (
  SELECT conv_id, sum(n) AS num_tokens, sum(n * weight) AS nw,
         arg_min(weight, (turn, part)) AS w0
  FROM tok WHERE n > 0 GROUP BY conv_id)
"""


def _sft_batches(spark, sf_dir, fmt="role_colon", train_on="all_assistant_messages", batch_size=8, seed=0):
    segs = render.render_segments(messages(spark, sf_dir), fmt, train_on)
    stats = render.datum_stats(segs)
    ranked = split.shuffle_rank(stats, seed, "conv_id", keep_total=True)
    batched = split.assign_batches(ranked, batch_size, drop_last=True)
    return batched.groupBy("batch_idx").agg(
        F.count(F.lit(1)).alias("num_sequences"),
        F.sum("num_input").cast("long").alias("num_tokens"),
        F.sum("num_loss").cast("long").alias("num_loss_tokens"),
    )


@query(
    "sft_batch_stats",
    "W1 R1 R3 R4 R6 R7 R8 D1 D7 A21",
    f"""
WITH {ROLE_COLON_SEGMENTS},
ranked AS (SELECT *, row_number() OVER (ORDER BY md5('0:' || conv_id), conv_id) AS r FROM per),
cnt AS (SELECT count(*) AS n FROM ranked)
SELECT CAST(floor((r - 1) / 8) AS BIGINT) AS batch_idx,
       count(*) AS num_sequences,
       CAST(sum(num_tokens - 1) AS BIGINT) AS num_tokens,
       CAST(sum(nw - w0) AS BIGINT) AS num_loss_tokens
FROM ranked, cnt
WHERE floor((r - 1) / 8) < cnt.n // 8
GROUP BY 1
""",
)
def sft_batch_stats(spark, sf_dir):
    """Per batch of 8 shuffled conversations: sequences, input tokens, loss tokens."""
    return _sft_batches(spark, sf_dir)


# ---------------------------------------------------------------------------
# Every chat format with a different loss-mask mode.

from kiln.plans.sqlgen import PIECE_RE, lit, messages_cte, pieces, segments_cte  # noqa: E402

RENDER_CASES = {
    "render_role_colon": ("role_colon", "all_tokens"),
    "render_llama3": ("llama3", "last_assistant_message"),
    "render_qwen3": ("qwen3", "all_messages"),
    "render_qwen3_instruct": ("qwen3_instruct", "all_user_and_system_messages"),
    "render_deepseekv3": ("deepseekv3_disable_thinking", "all_assistant_messages"),
    "render_gpt_oss": ("gpt_oss_medium_reasoning", "customized"),
    "render_qwen3_disable_thinking": ("qwen3_disable_thinking", "all_assistant_messages"),
    "render_deepseekv3_thinking": ("deepseekv3", "last_assistant_message"),
    "render_gpt_oss_no_sysprompt": ("gpt_oss_no_sysprompt", "all_assistant_messages"),
    "render_gpt_oss_low": ("gpt_oss_low_reasoning", "all_messages"),
    "render_gpt_oss_high": ("gpt_oss_high_reasoning", "last_assistant_message"),
}
#: Formats that render thinking, and those that render tool calls, get them here.
WITH_THINKING = ("render_gpt_oss_low", "render_gpt_oss_high")
WITH_TOOLS = ("render_qwen3", "render_qwen3_disable_thinking")


def rendered_text(segments, conv="conv_id", order="turn"):
    """Whole rendered sequence per conversation (segments in order)."""
    return segments.groupBy(conv).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(order, "part", "text"))), lambda s: s["text"]), ""
        ).alias("text"),
        F.sum("n_tokens").alias("num_tokens"),
        F.sum(F.col("n_tokens") * F.col("weight")).cast("long").alias("num_loss"),
        F.min(F.col("render_ok").cast("int")).cast("boolean").alias("render_ok"),
    )


def _render_plan(name, fmt, train_on):
    def plan(spark, sf_dir):
        msgs = rich_messages(spark, sf_dir)
        kw = {"thinking": "thinking"} if name in WITH_THINKING else {"tool_calls": "tool_calls"} if name in WITH_TOOLS else {}
        if train_on == "customized":
            msgs = msgs.withColumn("trainable", F.col("turn") % 2 == 0)
            kw["trainable"] = "trainable"
        segs = render.render_segments(msgs, fmt, train_on, **kw)
        return rendered_text(segs).select(
            "conv_id",
            F.md5("text").alias("text_md5"),
            F.length("text").cast("long").alias("n_chars"),
            "num_tokens",
            "num_loss",
            "render_ok",
        )

    return plan


def _render_sql(name, fmt, train_on):
    return f"""
WITH {segments_cte(fmt, train_on, thinking=name in WITH_THINKING, tools=name in WITH_TOOLS)}
SELECT conv_id, md5(string_agg(text, '' ORDER BY turn, part)) AS text_md5,
       CAST(sum(length(text)) AS BIGINT) AS n_chars,
       CAST(sum(n) AS BIGINT) AS num_tokens, CAST(sum(n * weight) AS BIGINT) AS num_loss,
       bool_and(ok) AS render_ok
FROM seg GROUP BY conv_id
"""


for _name, (_fmt, _mode) in RENDER_CASES.items():
    _ids = "R1 R3 R4 R5 R6 W1" + (" R14" if "reasoning" in _fmt else "") + (" R13" if _name in WITH_THINKING else "") + (" R12" if _name in WITH_TOOLS else "")
    query(_name, _ids, _render_sql(_name, _fmt, _mode))(_render_plan(_name, _fmt, _mode))


@query(
    "generation_prompt_tools",
    "R2 R12",
    f"""
WITH {messages_cte()},
p AS (
  SELECT conv_id, string_agg(CASE WHEN is_first THEN '' ELSE chr(10) END || '<|im_start|>' || role || chr(10)
      || CASE WHEN role = 'assistant' AND NOT contains(content, '<think>') THEN '<think>' || chr(10) ELSE '' END || content || tool_calls || '<|im_end|>', '' ORDER BY turn)
    || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) AS prompt
  FROM m GROUP BY conv_id)
SELECT conv_id, md5(prompt) AS prompt_md5, CAST(length(prompt) AS BIGINT) AS n_chars FROM p
""",
)
def generation_prompt_tools(spark, sf_dir):
    """R2 + R12: qwen3 generation prompts whose assistant messages hold tool calls."""
    p = render.generation_prompts(rich_messages(spark, sf_dir), "qwen3", tool_calls="tool_calls")
    return p.select("conv_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").cast("long").alias("n_chars"))


@query(
    "generation_prompt_llama3",
    "R2",
    f"""
WITH {messages_cte()}
SELECT conv_id,
       md5({lit('<|begin_of_text|>')} || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || content || '<|eot_id|>', '' ORDER BY turn)
           || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)) AS prompt_md5,
       CAST(length({lit('<|begin_of_text|>')} || string_agg('<|start_header_id|>' || role || '<|end_header_id|>' || chr(10) || chr(10) || content || '<|eot_id|>', '' ORDER BY turn)
           || '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10)) AS BIGINT) AS n_chars
FROM m GROUP BY conv_id
""",
)
def generation_prompt_llama3(spark, sf_dir):
    """R2: llama3 generation prompt per conversation."""
    p = render.generation_prompts(messages(spark, sf_dir), "llama3")
    return p.select("conv_id", F.md5("prompt").alias("prompt_md5"), F.length("prompt").cast("long").alias("n_chars"))


@query(
    "datum_arrays",
    "R3 R6 R7 R8 R20",
    f"""
WITH {segments_cte('qwen3_instruct', 'all_assistant_messages')},
p AS (SELECT conv_id, turn, part, {pieces('text')} AS p, weight FROM seg),
t AS (
  SELECT conv_id,
         list_slice(flatten(list(p ORDER BY turn, part)), 1, 64) AS toks,
         list_slice(string_split(string_agg(repeat(CAST(weight AS VARCHAR), len(p)), '' ORDER BY turn, part), ''), 1, 64) AS w
  FROM p GROUP BY conv_id)
SELECT conv_id,
       CAST(len(toks) - 1 AS BIGINT) AS n_input,
       md5(array_to_string(list_slice(toks, 1, len(toks) - 1), '|')) AS input_md5,
       md5(array_to_string(list_slice(toks, 2, len(toks)), '|')) AS target_md5,
       array_to_string(list_slice(w, 2, len(w)), '') AS weights,
       md5(array_to_string(toks, '|')) AS full_md5
FROM t
""",
)
def datum_arrays(spark, sf_dir):
    """Shifted token / weight arrays truncated to 64 tokens (qwen3_instruct)."""
    segs = render.render_segments(messages(spark, sf_dir), "qwen3_instruct", "all_assistant_messages")
    d = render.supervised_datums(segs, max_length=64)
    return d.select(
        "conv_id",
        (F.size("input_tokens")).cast("long").alias("n_input"),
        F.md5(F.array_join("input_tokens", "|")).alias("input_md5"),
        F.md5(F.array_join("target_tokens", "|")).alias("target_md5"),
        F.array_join(F.transform("weights", lambda x: x.cast("int").cast("string")), "").alias("weights"),
        F.md5(F.array_join(render.full_sequence(F.col("input_tokens"), F.col("target_tokens")), "|")).alias("full_md5"),
    )


@query(
    "prompt_truncation",
    "N3 R17",
    f"""
WITH first_user AS (
  SELECT conv_id, arg_min(text, turn) AS q FROM conversations WHERE role = 'user' AND text <> '' GROUP BY conv_id)
SELECT conv_id, array_to_string(list_slice({pieces('q')}, 1, 16), '') AS prompt
FROM first_user
""",
)
def prompt_truncation(spark, sf_dir):
    """N3 + R17: first user message of each conversation cut to 16 tokens."""
    from kiln.operators import adapters

    convs = adapters.conversation_arrays(messages(spark, sf_dir))
    firsts = adapters.first_user_message(convs)
    return firsts.select("conv_id", render.truncate_text(F.col("prompt"), 16).alias("prompt"))


@query(
    "weight_spans",
    "R21",
    """
WITH t AS (
  SELECT l_orderkey AS seq_id,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos,
         sign(l_tax - 0.04) AS s
  FROM lineitem),
f AS (SELECT *, CASE WHEN lag(s) OVER (PARTITION BY seq_id ORDER BY pos) IS NOT DISTINCT FROM s THEN 0 ELSE 1 END AS st FROM t),
g AS (SELECT *, sum(st) OVER (PARTITION BY seq_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS span FROM f)
SELECT seq_id, CAST(span AS BIGINT) AS span, CAST(min(s) AS DOUBLE) AS sign, CAST(min(pos) AS BIGINT) AS start_pos,
       CAST(max(pos) AS BIGINT) AS end_pos, count(*) AS n_tokens
FROM g GROUP BY seq_id, span
""",
)
def weight_spans(spark, sf_dir):
    """Runs of same-sign weights (tax − 0.04) per order."""
    from kiln.sources.tables import numbered_items

    li = numbered_items(spark, sf_dir, "seq_id", "pos").select(
        "seq_id", "pos", (F.col("l_tax") - 0.04).alias("w")
    )
    return render.weight_spans(li, "seq_id", "pos", "w").select(
        "seq_id", "span", F.col("sign").cast("double").alias("sign"), "start_pos", "end_pos", "n_tokens"
    )
