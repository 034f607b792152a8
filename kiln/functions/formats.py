"""Chat formats as Column expressions.

Each format returns, for one message row, the observation string, the action
string, the tail added after the action of the *last* message only, a BOS
string for the start of the sequence and a ``render_ok`` flag (a format that
cannot render a message reports it instead of raising, trap T18).

Inputs are columns of the long ``messages`` table: role, content, is_first,
is_last and optional thinking / tool-call columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions.json_text import python_json

# ---- fixed values: format markers that must equal the public chat templates ----
LLAMA3_BOS = "<|begin_of_text|>"
LLAMA3_HEADER_START = "<|start_header_id|>"
LLAMA3_HEADER_END = "<|end_header_id|>\n\n"
LLAMA3_EOT = "<|eot_id|>"
QWEN_START = "<|im_start|>"
QWEN_END = "<|im_end|>"
QWEN_THINK_OPEN = "<think>\n"
QWEN_NO_THINK_PREFILL = "\n</think>\n\n"
DSV3_BOS = "<｜begin▁of▁sentence｜>"
DSV3_EOS = "<｜end▁of▁sentence｜>"
DSV3_USER = "<｜User｜>"
DSV3_ASSISTANT = "<｜Assistant｜>"
DSV3_NO_THINK = "</think>"
OSS_START = "<|start|>"
OSS_MESSAGE = "<|message|>"
OSS_CHANNEL_FINAL = "<|channel|>final<|message|>"
OSS_CHANNEL_ANALYSIS = "<|channel|>analysis<|message|>"
OSS_END = "<|end|>"
OSS_RETURN = "<|return|>"
OSS_SYSTEM = (
    "<|start|>system<|message|>You are ChatGPT, a large language model trained by OpenAI.\n"
    "Knowledge cutoff: 2024-06\nCurrent date: {date}\n\nReasoning: {effort}\n\n"
    "# Valid channels: analysis, commentary, final. Channel must be included for every message.<|end|>"
)
ROLE_COLON_STOP = "\n\nUser:"
ROLE_COLON_UNUSED = "<UNUSED>"
# ---- end of fixed values ----

FORMATS = (
    "role_colon",
    "llama3",
    "qwen3",
    "qwen3_disable_thinking",
    "qwen3_instruct",
    "deepseekv3",
    "deepseekv3_disable_thinking",
    "gpt_oss_no_sysprompt",
    "gpt_oss_low_reasoning",
    "gpt_oss_medium_reasoning",
    "gpt_oss_high_reasoning",
)

STOP = {
    "role_colon": ROLE_COLON_STOP,
    "llama3": LLAMA3_EOT,
    "qwen3": QWEN_END,
    "qwen3_disable_thinking": QWEN_END,
    "qwen3_instruct": QWEN_END,
    "deepseekv3": DSV3_EOS,
    "deepseekv3_disable_thinking": DSV3_EOS,
}


@dataclass(frozen=True)
class Parts:
    ob: Column
    action: Column
    tail: Column
    ok: Column


def capitalize(c: Column) -> Column:
    """Python ``str.capitalize``: first character upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def tool_calls_text(tool_calls: Column) -> Column:
    """Each call as ``<tool_call>\\n{json}\\n</tool_call>``, joined by newline.

    ``tool_calls`` is ``array<string>``: the JSON text of each call, whose key order, depth and types are kept.
    """
    one = lambda call: F.concat(F.lit("<tool_call>\n"), python_json(call), F.lit("\n</tool_call>"))
    return F.coalesce(F.array_join(F.transform(tool_calls, one), "\n"), F.lit(""))


def bos(fmt: str) -> str:
    if fmt == "llama3":
        return LLAMA3_BOS
    if fmt.startswith("deepseekv3"):
        return DSV3_BOS
    return ""


def system_preamble(fmt: str, date: str) -> str:
    """Gpt-oss system preamble; used iff a reasoning effort is named."""
    if fmt.startswith("gpt_oss_") and fmt != "gpt_oss_no_sysprompt":
        effort = fmt[len("gpt_oss_"):].split("_")[0]
        return OSS_SYSTEM.replace("{date}", date).replace("{effort}", effort)
    return ""


def generation_prefill(fmt: str) -> str:
    if fmt == "qwen3_disable_thinking":
        return QWEN_NO_THINK_PREFILL
    if fmt == "deepseekv3_disable_thinking":
        return DSV3_NO_THINK
    return ""


def render_parts(
    fmt: str,
    role: Column,
    content: Column,
    is_first: Column,
    is_last: Column,
    thinking: Column | None = None,
    tool_calls: Column | None = None,
    strict_compat: bool = True,
) -> Parts:
    """Observation / action / tail strings of one message in format ``fmt``."""
    thinking = thinking if thinking is not None else F.lit(None).cast("string")
    no_thinking = thinking.isNull()
    content = F.coalesce(content, F.lit(""))
    is_assistant = role == "assistant"
    empty = F.lit("")
    if fmt == "role_colon":
        tail = F.when(is_assistant, F.lit("User:")).otherwise(F.lit(ROLE_COLON_UNUSED if strict_compat else ""))
        return Parts(
            F.concat(capitalize(role), F.lit(":")),
            F.concat(F.lit(" "), content, F.lit("\n\n")),
            tail,
            no_thinking,
        )
    if fmt == "llama3":
        return Parts(
            F.concat(F.lit(LLAMA3_HEADER_START), role, F.lit(LLAMA3_HEADER_END)),
            F.concat(content, F.lit(LLAMA3_EOT)),
            empty,
            no_thinking,
        )
    if fmt in ("qwen3", "qwen3_disable_thinking", "qwen3_instruct"):
        head = F.concat(F.when(is_first, empty).otherwise(F.lit("\n")), F.lit(QWEN_START), role, F.lit("\n"))
        if fmt != "qwen3_instruct":
            head = F.concat(
                head, F.when(is_assistant & ~content.contains("<think>"), F.lit(QWEN_THINK_OPEN)).otherwise(empty)
            )
            calls = tool_calls_text(tool_calls) if tool_calls is not None else empty
        else:
            calls = empty
        return Parts(head, F.concat(content, calls, F.lit(QWEN_END)), empty, no_thinking)
    if fmt in ("deepseekv3", "deepseekv3_disable_thinking"):
        body = content
        if fmt == "deepseekv3_disable_thinking":
            body = F.when(
                is_assistant & ~content.startswith("<think>") & ~content.startswith(DSV3_NO_THINK),
                F.concat(F.lit(DSV3_NO_THINK), content),
            ).otherwise(content)
        ob = F.when(role == "user", F.lit(DSV3_USER)).when(is_assistant, F.lit(DSV3_ASSISTANT)).otherwise(empty)
        action = F.concat(body, F.when(is_assistant, F.lit(DSV3_EOS)).otherwise(empty))
        return Parts(ob, action, empty, no_thinking & role.isin("user", "assistant"))
    if fmt.startswith("gpt_oss_"):
        analysis = F.when(
            is_last & F.coalesce(F.length(thinking) > 0, F.lit(False)),
            F.concat(F.lit(OSS_CHANNEL_ANALYSIS), thinking, F.lit(OSS_END), F.lit(OSS_START), F.lit("assistant")),
        ).otherwise(empty)
        action = F.when(is_assistant, F.concat(analysis, F.lit(OSS_CHANNEL_FINAL), content)).otherwise(
            F.concat(F.lit(OSS_MESSAGE), content)
        )
        action = F.concat(action, F.when(is_last, F.lit(OSS_RETURN)).otherwise(F.lit(OSS_END)))
        ok = is_assistant | no_thinking
        if tool_calls is not None:
            ok = ok & F.coalesce(F.size(tool_calls) <= 0, F.lit(True))
        return Parts(F.concat(F.lit(OSS_START), role), action, empty, ok)
    raise ValueError(f"unknown format {fmt!r}; known: {FORMATS}")
