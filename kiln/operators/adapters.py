"""Schema adapters and normalisers.

Conversations are ``array<struct<role, content, ...>>``; every adapter is a
projection or filter built from higher-order functions, so it stays inside
whole-stage codegen and needs no shuffle unless a group is formed (N12).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.operators.split import relative_test_size  # noqa: F401  (re-exported for N12 users)


def pystrip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing (Unicode) whitespace."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def msg(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def conversation_arrays(msgs: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """Long messages → one row per conversation with an ordered ``messages`` array."""
    agg = msgs.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(order, "role", "content"))).alias("_m"))
    return agg.select(conv, F.transform("_m", lambda m: msg(m["role"], m["content"])).alias("messages"))


def explode_conversations(convs: DataFrame, conv: str = "conv_id", col: str = "messages") -> DataFrame:
    """Array form → long form (conv, turn, role, content)."""
    return convs.select(conv, F.posexplode(col).alias("turn", "_m")).select(
        conv, F.col("turn").cast("long"), "_m.role", "_m.content"
    )


def sharegpt_to_messages(conversations: Column) -> Column:
    """``from == 'human'`` → user, anything else → assistant; missing list → empty."""
    return F.transform(
        F.coalesce(conversations, F.array()),
        lambda m: msg(F.when(m["from"] == "human", F.lit("user")).otherwise(F.lit("assistant")), m["value"]),
    )


def first_user_message(convs: DataFrame, col: str = "messages", out: str = "prompt") -> DataFrame:
    """Content of the first user message; rows without one or with empty text dropped."""
    first = F.try_element_at(F.filter(col, lambda m: m["role"] == "user"), F.lit(1))["content"]
    return convs.withColumn(out, first).filter(F.col(out).isNotNull() & (F.col(out) != ""))


def project_prompt(df: DataFrame, col: str = "question") -> DataFrame:
    """Single-column prompt projection."""
    return df.select(F.col(col).alias("prompt"))


_SOH, _STX = "\u0001", "\u0002"


def hh_parse(text: Column) -> Column:
    """``Human:`` / ``Assistant:`` transcript → messages.

    Each marker is wrapped in sentinels, the text split on the first sentinel;
    piece 1 is the text before the first marker. When it is blank the pieces
    are (marker, content) pairs; when it is not, the pairs are misaligned and
    the reference yields no messages (trap T19).
    """
    marked = F.regexp_replace(text, "(Human:|Assistant:)", f"{_SOH}$1{_STX}")
    parts = F.split(marked, _SOH)
    pre = F.element_at(parts, 1)
    rest = F.slice(parts, 2, F.size(parts))
    msgs = F.transform(
        rest,
        lambda e: msg(
            F.when(F.substring_index(e, _STX, 1) == "Human:", F.lit("user")).otherwise(F.lit("assistant")),
            pystrip(F.substring(e, F.locate(_STX, e) + 1, 1 << 30)),
        ),
    )
    return F.when(pystrip(pre) == "", msgs).otherwise(F.array().cast("array<struct<role:string,content:string>>"))


def hh_pair(chosen: Column, rejected: Column) -> Column:
    """struct(prompt, completion_a, completion_b) or null.

    Kept only when both parse to the same length n ≥ 1, the first n−1 messages
    are equal and the last ones differ; chosen = A.
    """
    n = F.size(chosen)
    ok = (n == F.size(rejected)) & (n >= 1) & (
        F.slice(chosen, 1, n - 1) == F.slice(rejected, 1, n - 1)
    ) & (F.element_at(chosen, -1) != F.element_at(rejected, -1))
    return F.when(
        ok,
        F.struct(
            F.slice(chosen, 1, n - 1).alias("prompt"),
            F.array(F.element_at(chosen, -1)).alias("completion_a"),
            F.array(F.element_at(rejected, -1)).alias("completion_b"),
            F.lit("A").alias("label"),
        ),
    )


def _comparison(prompt: Column, a: Column, b: Column, label: Column) -> list[Column]:
    said = lambda c: F.array(msg(F.lit("assistant"), c))
    return [F.struct(prompt.alias("prompt"), said(a).alias("completion_a"), said(b).alias("completion_b")).alias("comparison"), label.alias("label")]


def _user(c: str) -> Column:
    return F.array(msg(F.lit("user"), F.col(c)))


def tulu_preference(df: DataFrame) -> DataFrame:
    """Prompt + content of the second message of chosen / rejected as assistant replies, label A."""
    second = lambda c: F.element_at(c, 2)["content"]
    return df.select(*_comparison(_user("prompt"), second("chosen"), second("rejected"), F.lit("A")))


def helpsteer3_label(pref: Column) -> Column:
    """overall_preference < 0 → A, > 0 → B, 0 → dropped (null)."""
    return F.when(pref < 0, F.lit("A")).when(pref > 0, F.lit("B"))


def helpsteer3(df: DataFrame) -> DataFrame:
    """Context as the prompt, both responses, label by the sign of the preference; ties dropped."""
    context = F.transform("context", lambda m: msg(m["role"], m["content"]))
    rows = df.select(*_comparison(context, F.col("response1"), F.col("response2"), helpsteer3_label(F.col("overall_preference"))))
    return rows.filter(F.col("label").isNotNull())


def ultrafeedback(df: DataFrame) -> DataFrame:
    """Instruction + chosen / rejected responses, label A."""
    return df.select(*_comparison(_user("instruction"), F.col("chosen_response"), F.col("rejected_response"), F.lit("A")))


def hh(df: DataFrame) -> DataFrame:
    """N5 + N6: transcript pairs; malformed ones dropped."""
    pair = hh_pair(hh_parse(F.col("chosen")), hh_parse(F.col("rejected")))
    return df.select(pair.alias("comparison"), F.lit("A").alias("label")).filter(F.col("comparison").isNotNull())


def sharegpt(df: DataFrame) -> DataFrame:
    """N1."""
    return df.select(sharegpt_to_messages(F.col("conversations")).alias("messages"))


#: Named sources (S5) and the adapter of their rows.
ADAPTERS = {"tulu3": tulu_preference, "helpsteer3": helpsteer3, "ultrafeedback": ultrafeedback, "hh": hh, "sharegpt": sharegpt}


def chat_text(df: DataFrame, fmt: str, conv: str = "conv_id", col: str = "conversations") -> DataFrame:
    """ShareGPT rows → messages → the chat template's text, all other columns dropped."""
    from kiln.operators import render

    long = explode_conversations(df.select(conv, sharegpt_to_messages(F.col(col)).alias("messages")), conv)
    parts = render.render_segments(long, fmt, "all_messages", conv=conv).groupBy(conv)
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("turn", "part", "text"))).alias("_s"))
    return parts.select(F.array_join(F.transform("_s", lambda s: s["text"]), "").alias("text"))


def student_rows(queries: DataFrame, responses: DataFrame, extract: Callable[[Column], Column], key: str = "query_id") -> DataFrame:
    """Rows (messages) of query → extracted label for the student; the teacher's prompt is not in them. Responses
    without a label give no row."""
    labelled = responses.select(key, extract(F.col("response")).alias("_label")).filter(F.col("_label").isNotNull())
    joined = queries.join(labelled, key)
    return joined.select(F.array(msg(F.lit("user"), F.col("query")), msg(F.lit("assistant"), F.col("_label"))).alias("messages"))


def arena_flatten(conversation: Column, sep: str = " ") -> Column:
    """Any non-text part → null; text parts joined by ``sep``; user/assistant kept.

    Messages whose text list is empty are skipped.
    """
    has_other = F.exists(conversation, lambda m: F.exists(m["content"], lambda p: p["type"] != "text"))
    flat = F.transform(
        conversation,
        lambda m: F.struct(
            m["role"].alias("role"),
            F.array_join(F.transform(m["content"], lambda p: F.coalesce(p["text"], F.lit(""))), sep).alias("content"),
            (F.size(m["content"]) > 0).alias("_keep"),
        ),
    )
    kept = F.filter(flat, lambda m: m["_keep"] & m["role"].isin("user", "assistant"))
    return F.when(has_other, F.lit(None)).otherwise(F.transform(kept, lambda m: msg(m["role"], m["content"])))


def arena_comparison(winner: Column, a: Column, b: Column) -> Column:
    """Validity rules and prompt = first message of A only (trap T21)."""
    ok = (
        winner.isin("model_a", "model_b")
        & a.isNotNull() & b.isNotNull()
        & (F.size(a) >= 2) & (F.size(b) >= 2)
        & (F.element_at(a, -1)["role"] == "assistant")
        & (F.element_at(b, -1)["role"] == "assistant")
    )
    return F.when(
        ok,
        F.struct(
            F.slice(a, 1, 1).alias("prompt"),
            F.slice(a, 2, F.size(a)).alias("completion_a"),
            F.slice(b, 2, F.size(b)).alias("completion_b"),
            F.when(winner == "model_a", "A").otherwise("B").alias("label"),
        ),
    )


def best_vs_worst(df: DataFrame, prompt: str, response: str, score: str, row_id: list[str]) -> DataFrame:
    """Per prompt with ≥2 responses, highest vs lowest score when strictly greater.

    Ties: best = first seen, worst = last seen (stable descending sort), so
    ``row_id`` must give the input order. One partial aggregation, no sort.
    """
    rid = F.struct(*[F.col(c) for c in row_id])
    neg_rid = F.struct(*[-F.col(c) for c in row_id])
    g = df.groupBy(prompt).agg(
        F.count(F.lit(1)).alias("n_responses"),
        F.max_by(F.col(response), F.struct(F.col(score), neg_rid)).alias("chosen_response"),
        F.max_by(F.col(response), F.struct(-F.col(score), rid)).alias("rejected_response"),
        F.max(score).alias("_hi"),
        F.min(score).alias("_lo"),
    )
    return g.filter((F.col("n_responses") >= 2) & (F.col("_hi") > F.col("_lo"))).select(
        prompt, "chosen_response", "rejected_response", (F.col("_hi") - F.col("_lo")).alias("helpfulness_diff")
    )


def non_empty(*cols: str) -> Column:
    """Every named column present and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return cond


def mixed_golds(reward_model: Column, golden_answers: Column) -> Column:
    """N15 over JSON text of mixed type: an object's ground truth (its ``target`` list, or the list itself) if it has one,
    else the golden answers; what is no list of strings is an error."""
    v = F.try_parse_json(reward_model)
    truth = F.try_variant_get(v, "$.ground_truth", "variant")
    nested = F.try_variant_get(truth, "$.target", "variant")
    gold = F.coalesce(nested, truth, F.try_parse_json(golden_answers), F.parse_json(F.lit("[]")))
    kind = F.schema_of_variant(gold)
    listed = kind.isin("ARRAY<STRING>", "ARRAY<VOID>")
    wrong = F.raise_error(F.concat(F.lit("gold answers are no list of strings: "), kind)).cast("array<string>")
    return F.when(listed, F.variant_get(gold, "$", "array<string>")).otherwise(wrong)


def optional_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Project optional columns with defaults (answer '', task 'default', info {})."""
    out = df
    for c, v in defaults.items():
        default = F.lit(v) if not isinstance(v, dict) else F.create_map().cast("map<string,string>")
        out = out.withColumn(c, F.coalesce(F.col(c), default) if c in df.columns else default)
    return out


def multipart_text(messages: Column) -> Column:
    """Parts joined without separator, default role user (contrast N10)."""
    return F.transform(
        messages,
        lambda m: msg(
            F.coalesce(m["role"], F.lit("user")),
            F.array_join(F.transform(F.filter(m["content"], lambda p: p["text"].isNotNull()), lambda p: p["text"]), ""),
        ),
    )


def strip_messages(messages: Column) -> Column:
    """Trim message content."""
    return F.transform(messages, lambda m: msg(m["role"], pystrip(m["content"])))


def fewshot_prompt(question: Column, prefix: list[tuple[str, str]] = (), suffix: str = "") -> Column:
    """Few-shot prefix messages + {user, question + suffix}."""
    pre = [msg(F.lit(r), F.lit(c)) for r, c in prefix]
    return F.array(*pre, msg(F.lit("user"), F.concat(question, F.lit(suffix))))


def fill_template(template: str, text: Column, slot: str = "{text}") -> Column:
    """Literal template with the text placed in ``slot``."""
    head, _, tail = template.partition(slot)
    return F.concat(F.lit(head), text, F.lit(tail))


def role_remap(messages: Column, mapping: dict[str, str], system: str | None = None, last_only: bool = False) -> Column:
    """Remap roles by viewpoint; optional system message first; answerer sees last turn only."""
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    src = F.slice(messages, -1, 1) if last_only else messages
    out = F.transform(src, lambda m: msg(F.coalesce(F.element_at(lookup, m["role"]), m["role"]), m["content"]))
    if system is not None:
        out = F.concat(F.array(msg(F.lit("system"), F.lit(system))), out)
    return out


def truncate_history(messages: Column, keep: int = 10) -> Column:
    """When longer than ``keep``, first (system) message + last ``keep``−1."""
    return F.when(
        F.size(messages) > keep, F.concat(F.slice(messages, 1, 1), F.slice(messages, -(keep - 1), keep - 1))
    ).otherwise(messages)


def strip_thinking(content: Column) -> Column:
    """Drop ``<think>…</think>`` spans (content preprocessor hook)."""
    return F.regexp_replace(content, r"(?s)<think>.*?</think>", "")


def drop_incomplete_comparisons(df: DataFrame) -> DataFrame:
    """Rows without a comparison or a label are dropped."""
    return df.filter(F.col("comparison").isNotNull() & F.col("label").isNotNull())
