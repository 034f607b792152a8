"""Response parsing (R9–R12, R23, R24) as Column expressions.

A parse never raises inside a task: the outcome is a ``status`` column
(``ok`` / ``invalid`` / ``error``) that the caller filters or counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions.tokens import DEFAULT


def count_occurrences(text: Column, marker: str) -> Column:
    """Literal (non-regex) occurrence count; stop markers contain regex metacharacters."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / F.lit(len(marker))).cast("long")


def parse_stop(text: Column, stop: str) -> tuple[Column, Column]:
    """0 stops → whole text, invalid; 1 → text before it, ok; more → error."""
    n = count_occurrences(text, stop)
    content = F.when(n == 0, text).when(n == 1, F.substring_index(text, stop, 1))
    status = F.when(n == 0, "invalid").when(n == 1, "ok").otherwise("error")
    return content, status


def parse_role_colon(text: Column, stop: str = "\n\nUser:") -> tuple[Column, Column]:
    """Split on the stop; 1 piece → invalid (whole text), 2 → first piece ok, more → error; stripped."""
    n = count_occurrences(text, stop) + 1
    strip = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    content = F.when(n == 1, strip(text)).when(n == 2, strip(F.substring_index(text, stop, 1)))
    status = F.when(n == 1, "invalid").when(n == 2, "ok").otherwise("error")
    return content, status


def extract_tool_call(text: Column) -> tuple[Column, Column]:
    """First ``<tool_call>…</tool_call>`` (dot-all); JSON with string ``name`` and object ``args``.

    Returns (call struct or null, format_ok). Bad JSON keeps the message and
    marks the format invalid; no tag → no call, format ok.
    """
    body = F.regexp_extract(text, r"(?s)<tool_call>(.*?)</tool_call>", 1)
    has = F.regexp_like(text, F.lit(r"(?s)<tool_call>.*?</tool_call>"))
    v = F.try_parse_json(F.regexp_replace(body, r"(?U)^\s+|\s+$", ""))
    name_ok = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.name", "variant")) == "STRING", F.lit(False))
    args_ok = F.coalesce(F.schema_of_variant(F.try_variant_get(v, "$.args", "variant")).startswith("OBJECT"), F.lit(False))
    good = has & v.isNotNull() & name_ok & args_ok
    call = F.when(good, F.struct(F.try_variant_get(v, "$.name", "string").alias("name"),
                                 F.to_json(F.try_variant_get(v, "$.args", "variant")).alias("args_json")))
    return call, F.when(has, good).otherwise(F.lit(True))


def usage(prompt: Column, responses: Column, tokenizer=DEFAULT) -> Column:
    """Input tokens, output tokens (sum over responses), total."""
    inp = tokenizer.count(prompt)
    out = F.aggregate(F.transform(responses, lambda r: tokenizer.count(r)), F.lit(0).cast("long"), lambda a, b: a + b)
    return F.struct(inp.alias("input_tokens"), out.alias("output_tokens"), (inp + out).alias("total_tokens"))


def finish_reason(parse_ok: Column) -> Column:
    """``stop`` when the parse succeeded, else ``length``."""
    return F.when(parse_ok, F.lit("stop")).otherwise(F.lit("length"))
