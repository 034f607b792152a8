"""Response-parsing queries on conversation and part text."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import parse
from kiln.functions.tokens import DEFAULT
from kiln.plans.registry import query
from kiln.plans.sqlgen import ntok
from kiln.sources.tables import messages, table

STOP = "<|im_end|>"


def _responses(spark, sf_dir):
    m = messages(spark, sf_dir).filter(F.col("role") == "assistant")
    suffix = F.when(F.col("conv_id") % 3 == 0, F.lit("")).when(F.col("conv_id") % 3 == 1, F.lit(STOP)).otherwise(F.lit(f"{STOP}x{STOP}"))
    return m.select("conv_id", "turn", F.concat("content", suffix).alias("response"))


@query("parse_responses", "R9 R10 R24", f"""
WITH r AS (
  SELECT conv_id, turn, text || CASE conv_id % 3 WHEN 0 THEN '' WHEN 1 THEN '<|im_end|>' ELSE '<|im_end|>x<|im_end|>' END AS response
  FROM conversations WHERE role = 'assistant'),
c AS (SELECT *, CAST((length(response) - length(replace(response, '<|im_end|>', ''))) / 10 AS BIGINT) AS n FROM r)
SELECT conv_id, CAST(turn AS BIGINT) AS turn,
       CASE WHEN n = 0 THEN 'invalid' WHEN n = 1 THEN 'ok' ELSE 'error' END AS status,
       md5(CASE WHEN n = 0 THEN response WHEN n = 1 THEN split_part(response, '<|im_end|>', 1) END) AS content_md5,
       CASE WHEN n = 1 THEN 'stop' ELSE 'length' END AS finish_reason,
       CASE WHEN length(response) - length(replace(response, chr(10) || chr(10) || 'User:', '')) = 0 THEN 'invalid' ELSE 'ok' END AS role_colon_status,
       CAST({ntok("text")} AS BIGINT) AS output_tokens
FROM c JOIN (SELECT conv_id AS cid, turn AS t, text FROM conversations) x ON c.conv_id = x.cid AND c.turn = x.t
""")
def parse_responses(spark, sf_dir):
    """Stop-token parse with status; R24 finish reason; R10 role-colon parse; R23 output tokens."""
    r = _responses(spark, sf_dir)
    content, status = parse.parse_stop(F.col("response"), STOP)
    _, rc_status = parse.parse_role_colon(F.col("response"))
    raw = messages(spark, sf_dir).select("conv_id", "turn", DEFAULT.count(F.col("content")).alias("output_tokens"))
    return r.select("conv_id", "turn", status.alias("status"), F.md5(content).alias("content_md5"),
                    parse.finish_reason(status == "ok").alias("finish_reason"),
                    rc_status.alias("role_colon_status")).join(raw, ["conv_id", "turn"])


@query("tool_calls", "R11", """
WITH t AS (
  SELECT p_partkey AS item_id,
         'I will search.' || chr(10) || '<tool_call>' || chr(10) ||
         CASE WHEN p_size % 4 = 0 THEN '{"name": "search", "args": ' ELSE '{"name": "search", "args": {"query_list": ["' || p_name || '"]}}' END
         || chr(10) || '</tool_call>' AS text
  FROM part),
j AS (SELECT item_id, trim(regexp_extract(text, '(?s)<tool_call>(.*?)</tool_call>', 1)) AS body FROM t)
SELECT item_id,
       CASE WHEN json_valid(body) THEN coalesce(json_type(body, '$.name') = 'VARCHAR' AND json_type(body, '$.args') = 'OBJECT', false) ELSE false END AS format_ok,
       CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.name') = 'VARCHAR' AND json_type(body, '$.args') = 'OBJECT' THEN json_extract_string(body, '$.name') END END AS name
FROM j
""")
def tool_calls(spark, sf_dir):
    """Tool-call extraction and JSON validation (every 4th call is truncated JSON)."""
    p = table(spark, sf_dir, "part")
    body = F.when(p.p_size % 4 == 0, F.lit('{"name": "search", "args": ')).otherwise(
        F.concat(F.lit('{"name": "search", "args": {"query_list": ["'), F.col("p_name"), F.lit('"]}}')))
    text = F.concat(F.lit("I will search.\n<tool_call>\n"), body, F.lit("\n</tool_call>"))
    call, ok = parse.extract_tool_call(text)
    return p.select(F.col("p_partkey").alias("item_id"), ok.alias("format_ok"), call["name"].alias("name"))
