"""DuckDB SQL fragments mirroring the Spark expressions, for oracle queries."""

from __future__ import annotations

from kiln.functions import formats as fm

NL = "chr(10)"
NL2 = "(chr(10) || chr(10))"
RUN_RE = "'<\\|[a-z_]+\\|>|<｜[^｜]+｜>|[A-Za-z0-9]+'"
PIECE_RE = "'(<\\|[a-z_]+\\|>|<｜[^｜]+｜>|[A-Za-z0-9]+|[^A-Za-z0-9])'"


def lit(s: str) -> str:
    """A SQL string literal, newlines as chr(10)."""
    parts = s.split("\n")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return "(" + f" || {NL} || ".join(quoted) + ")"


def ntok(expr: str) -> str:
    return f"length(regexp_replace({expr}, {RUN_RE}, 'a', 'g'))"


def pieces(expr: str) -> str:
    return f"regexp_extract_all({expr}, {PIECE_RE}, 1)"


# Thinking and tool calls of the messages (kiln.sources.tables.rich_messages); the calls as they are rendered.
_ESCAPED = (
    "array_to_string(list_transform(string_split(left(text, 12), ''), lambda c: CASE WHEN c = chr(10) THEN '\\n' WHEN unicode(c) > 126 "
    "THEN '\\u' || printf('%04x', unicode(c)) ELSE c END), '')"
)
THINKING = "CASE WHEN role = 'assistant' AND turn % 4 <> 1 THEN 'step ' || turn END"
_CALL = (
    """'<tool_call>' || chr(10) || '{{"name": "search", "args": {{"query_list": ["' || """ + _ESCAPED + """ || '", "\\u00e9\\ud83d\\ude00"], "n": 2.5, "at": {{"turn": ' || turn
    || ', "b": true, "a": null}}}}}}' || chr(10) || '</tool_call>'"""
).replace("{{", "{").replace("}}", "}")
TOOL_CALLS = f"CASE WHEN role = 'assistant' AND turn % 3 <> 0 THEN {_CALL} || CASE WHEN turn % 3 = 2 THEN chr(10) || {_CALL} ELSE '' END ELSE '' END"


def messages_cte(source: str = "conversations") -> str:
    return f"""m AS (
  SELECT conv_id, turn, role, text AS content, (turn % 2 = 0) AS trainable, {THINKING} AS thinking, {TOOL_CALLS} AS tool_calls,
         turn = min(turn) OVER (PARTITION BY conv_id) AS is_first,
         turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
  FROM {source})"""


def weight_sql(train_on: str) -> str:
    return {
        "last_assistant_message": "CASE WHEN is_last AND role = 'assistant' THEN 1 ELSE 0 END",
        "all_assistant_messages": "CASE WHEN role = 'assistant' THEN 1 ELSE 0 END",
        "all_messages": "1",
        "all_tokens": "1",
        "all_user_and_system_messages": "CASE WHEN role IN ('user', 'system') THEN 1 ELSE 0 END",
        "customized": "CASE WHEN trainable THEN 1 ELSE 0 END",
    }[train_on]


def parts_sql(fmt: str) -> tuple[str, str, str, str]:
    """(ob, action, tail, ok) SQL over m(role, content, is_first, is_last)."""
    if fmt == "role_colon":
        return (
            "upper(substr(role, 1, 1)) || lower(substr(role, 2)) || ':'",
            f"' ' || content || {NL2}",
            f"CASE WHEN role = 'assistant' THEN 'User:' ELSE {lit(fm.ROLE_COLON_UNUSED)} END",
            "true",
        )
    if fmt == "llama3":
        return (
            f"{lit(fm.LLAMA3_HEADER_START)} || role || {lit(fm.LLAMA3_HEADER_END)}",
            f"content || {lit(fm.LLAMA3_EOT)}",
            "''",
            "true",
        )
    if fmt in ("qwen3", "qwen3_disable_thinking", "qwen3_instruct"):
        ob = f"CASE WHEN is_first THEN '' ELSE {NL} END || {lit(fm.QWEN_START)} || role || {NL}"
        if fmt != "qwen3_instruct":
            ob += f" || CASE WHEN role = 'assistant' AND NOT contains(content, '<think>') THEN {lit(fm.QWEN_THINK_OPEN)} ELSE '' END"
        return ob, f"content || {lit(fm.QWEN_END)}", "''", "true"
    if fmt in ("deepseekv3", "deepseekv3_disable_thinking"):
        body = "content"
        if fmt == "deepseekv3_disable_thinking":
            body = (
                "CASE WHEN role = 'assistant' AND NOT starts_with(content, '<think>') "
                f"AND NOT starts_with(content, '</think>') THEN '</think>' || content ELSE content END"
            )
        return (
            f"CASE WHEN role = 'user' THEN {lit(fm.DSV3_USER)} WHEN role = 'assistant' THEN {lit(fm.DSV3_ASSISTANT)} ELSE '' END",
            f"{body} || CASE WHEN role = 'assistant' THEN {lit(fm.DSV3_EOS)} ELSE '' END",
            "''",
            "role IN ('user', 'assistant')",
        )
    if fmt.startswith("gpt_oss_"):
        think = f"CASE WHEN is_last AND length(thinking) > 0 THEN {lit(fm.OSS_CHANNEL_ANALYSIS)} || thinking || {lit(fm.OSS_END)} || {lit(fm.OSS_START)} || 'assistant' ELSE '' END"
        return (
            f"{lit(fm.OSS_START)} || role",
            f"CASE WHEN role = 'assistant' THEN {think} || {lit(fm.OSS_CHANNEL_FINAL)} || content ELSE {lit(fm.OSS_MESSAGE)} || content END"
            f" || CASE WHEN is_last THEN {lit(fm.OSS_RETURN)} ELSE {lit(fm.OSS_END)} END",
            "''",
            "(role = 'assistant' OR thinking IS NULL)",
        )
    raise ValueError(fmt)


def segments_cte(fmt: str, train_on: str, date: str = "2025-01-01", thinking: bool = False, tools: bool = False) -> str:
    ob, ac, tail, ok = parts_sql(fmt)
    if tools:
        ac = ac.replace("content ||", "content || tool_calls ||", 1)
    if not thinking:
        ob, ac, ok = (x.replace("thinking IS NULL", "true").replace("length(thinking) > 0", "false") for x in (ob, ac, ok))
    start = fm.bos(fmt) + fm.system_preamble(fmt, date)
    w_ob = "1" if train_on == "all_tokens" else "0"
    return f"""{messages_cte()},
seg0 AS (
  SELECT conv_id, turn, -1 AS part, CASE WHEN is_first THEN {lit(start)} END AS text, 0 AS weight, {ok} AS ok FROM m
  UNION ALL
  SELECT conv_id, turn, 0, {ob}, {w_ob}, {ok} FROM m
  UNION ALL
  SELECT conv_id, turn, 1, {ac} || CASE WHEN is_last THEN {tail} ELSE '' END, {weight_sql(train_on)}, {ok} FROM m),
seg AS (SELECT *, {ntok('text')} AS n FROM seg0 WHERE text IS NOT NULL AND length(text) > 0)"""
