"""Rendering conversations into weighted token segments.

The unit of work is the *segment*: one row per (conversation, message, part)
with the rendered text and its loss weight. Segments are tokenised
independently (as the per-part encoding of a chat renderer does), so token
counts and weights can be summed with partial aggregation and never need the
whole conversation in one place. Token arrays are only built in
``supervised_datums`` where the datum itself is the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions import formats
from kiln.functions.tokens import DEFAULT

TRAIN_ON = (
    "last_assistant_message",
    "all_assistant_messages",
    "all_messages",
    "all_tokens",
    "all_user_and_system_messages",
    "customized",
)


def message_index(msgs: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """0-based message index and last-message flag by window."""
    w = Window.partitionBy(conv).orderBy(order)
    return msgs.withColumn("msg_idx", (F.row_number().over(w) - 1).cast("long")).withColumn(
        "is_last", F.lead(order).over(w).isNull()
    )


def with_position(msgs: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """First / last flags from a per-conversation min/max joined back.

    Same flags as ``message_index`` without sorting whole conversations in
    one task: the bounds are a partial aggregate and the join is split by AQE
    when a conversation is hot.
    """
    bounds = msgs.groupBy(conv).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    return (
        msgs.join(bounds, conv)
        .withColumn("is_first", F.col(order) == F.col("_first"))
        .withColumn("is_last", F.col(order) == F.col("_last"))
        .drop("_first", "_last")
    )


def action_weight(train_on: str, role: Column, is_last: Column, trainable: Column | None) -> Column:
    """R4 + R5: weight of the action part of a message for each loss-mask mode.

    ``customized`` needs ``trainable`` on every message, the other modes forbid it: a message that breaks this fails
    the job that renders it.
    """
    if train_on == "customized":
        if trainable is None:
            raise ValueError("customized loss mask needs a trainable column")
        missing = F.raise_error(F.lit("customized loss mask needs trainable on every message")).cast("int")
        return F.when(trainable.isNull(), missing).otherwise(trainable.cast("int"))
    if train_on == "last_assistant_message":
        w = is_last & (role == "assistant")
    elif train_on == "all_assistant_messages":
        w = role == "assistant"
    elif train_on in ("all_messages", "all_tokens"):
        w = F.lit(True)
    elif train_on == "all_user_and_system_messages":
        w = role.isin("user", "system")
    else:
        raise ValueError(f"unknown train_on {train_on!r}; known: {TRAIN_ON}")
    if trainable is None:
        return w.cast("int")
    given = F.raise_error(F.lit(f"messages carry trainable, which mode {train_on} forbids")).cast("int")
    return F.when(trainable.isNotNull(), given).otherwise(w.cast("int"))


def render_segments(
    msgs: DataFrame,
    fmt: str,
    train_on: str = "all_assistant_messages",
    *,
    conv: str = "conv_id",
    order: str = "turn",
    thinking: str | None = None,
    tool_calls: str | None = None,
    trainable: str | None = None,
    strict_compat: bool = True,
    date: str = "2025-01-01",
    tokenizer=DEFAULT,
) -> DataFrame:
    """One row per (conv, turn, part) with text, weight and token count.

    part -1 = sequence start (BOS, system preamble; weight 0) on the first
    message, 0 = observation (weight 1 only for ``all_tokens``), 1 = action,
    plus the tail on the last message.
    """
    if train_on not in TRAIN_ON:
        raise ValueError(f"unknown train_on {train_on!r}")
    m = with_position(msgs, conv, order)
    th = F.col(thinking) if thinking else None
    tc = F.col(tool_calls) if tool_calls else None
    tr = F.col(trainable) if trainable else None
    p = formats.render_parts(
        fmt, F.col("role"), F.col("content"), F.col("is_first"), F.col("is_last"), th, tc, strict_compat
    )
    start = formats.bos(fmt) + formats.system_preamble(fmt, date)
    w_ob = F.lit(1 if train_on == "all_tokens" else 0)
    w_ac = action_weight(train_on, F.col("role"), F.col("is_last"), tr)
    action = F.concat(p.action, F.when(F.col("is_last"), p.tail).otherwise(F.lit("")))
    segs = F.array(
        F.struct(F.lit(-1).alias("part"), F.when(F.col("is_first"), F.lit(start)).alias("text"), F.lit(0).alias("weight")),
        F.struct(F.lit(0).alias("part"), p.ob.alias("text"), w_ob.alias("weight")),
        F.struct(F.lit(1).alias("part"), action.alias("text"), w_ac.alias("weight")),
    )
    out = m.select(conv, order, "role", p.ok.alias("render_ok"), F.inline(segs))
    out = out.filter(F.col("text").isNotNull() & (F.length("text") > 0))
    return out.withColumn("n_tokens", tokenizer.count(F.col("text")))


def datum_stats(segments: DataFrame, conv: str = "conv_id", order: str = "turn") -> DataFrame:
    """Per conversation: tokens, loss tokens and the shifted datum sizes (R7 without arrays).

    ``num_input`` = tokens − 1; ``num_loss`` drops the weight of the first
    token, as the target/weights arrays start at position 2.
    """
    seg = segments.filter(F.col("n_tokens") > 0)
    return seg.groupBy(conv).agg(
        F.sum("n_tokens").alias("num_tokens"),
        F.sum(F.col("n_tokens") * F.col("weight")).cast("long").alias("num_weighted"),
        F.min_by("weight", F.struct(order, "part")).alias("_w0"),
        F.min(F.col("render_ok").cast("int")).cast("boolean").alias("render_ok"),
    ).select(
        conv,
        "num_tokens",
        (F.col("num_tokens") - 1).alias("num_input"),
        (F.col("num_weighted") - F.col("_w0")).alias("num_loss"),
        "render_ok",
    )


def supervised_datums(
    segments: DataFrame,
    max_length: int | None = None,
    conv: str = "conv_id",
    order: str = "turn",
    tokenizer=DEFAULT,
) -> DataFrame:
    """R3 + R6 + R7: token and weight arrays, truncated to ``max_length``, shifted by one.

    Output: conv, tokens (full, before the shift), input_tokens =
    tokens[:-1], target_tokens = tokens[1:], weights = w[1:].
    """
    seg = segments.select(conv, order, "part", tokenizer.pieces(F.col("text")).alias("p"), "weight")
    agg = seg.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(order, "part", "p", "weight"))).alias("_s"))
    toks = F.flatten(F.transform("_s", lambda s: s["p"]))
    wts = F.flatten(F.transform("_s", lambda s: F.array_repeat(s["weight"].cast("float"), F.size(s["p"]))))
    out = agg.select(conv, toks.alias("tokens"), wts.alias("w"))
    if max_length is not None:
        out = out.select(conv, F.slice("tokens", 1, max_length).alias("tokens"), F.slice("w", 1, max_length).alias("w"))
    n = F.size("tokens")
    return out.select(
        conv,
        "tokens",
        F.slice("tokens", 1, n - 1).alias("input_tokens"),
        F.slice("tokens", 2, n - 1).alias("target_tokens"),
        F.slice("w", 2, n - 1).alias("weights"),
    )


def full_sequence(input_tokens: Column, target_tokens: Column) -> Column:
    """Input + last target token (empty target → input)."""
    return F.when(F.size(target_tokens) > 0, F.concat(input_tokens, F.slice(target_tokens, -1, 1))).otherwise(
        input_tokens
    )


def generation_prompts(
    msgs: DataFrame,
    fmt: str,
    role: str = "assistant",
    prefill: str | None = None,
    *,
    conv: str = "conv_id",
    order: str = "turn",
    thinking: str | None = None,
    tool_calls: str | None = None,
    date: str = "2025-01-01",
) -> DataFrame:
    """R2: BOS + every (ob + action) + ob of an empty ``role`` message + prefill.

    Message strings are aggregated in turn order; the reference renders all
    messages as non-last here (gpt-oss ends each with ``<|end|>``). Tool calls and thinking of the messages are part
    of them, as in ``render_segments``.
    """
    m = with_position(msgs, conv, order)
    th, tc = (F.col(c) if c else None for c in (thinking, tool_calls))
    p = formats.render_parts(fmt, F.col("role"), F.col("content"), F.col("is_first"), F.lit(False), th, tc)
    body = m.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(order, F.concat(p.ob, p.action).alias("s")))).alias("_s"),
        F.min(p.ok.cast("int")).cast("boolean").alias("render_ok"),
    )
    tail = formats.render_parts(fmt, F.lit(role), F.lit(""), F.lit(False), F.lit(False))
    prefix = formats.bos(fmt) + formats.system_preamble(fmt, date)
    suffix_prefill = formats.generation_prefill(fmt) + (prefill or "")
    return body.select(
        conv,
        F.concat(
            F.lit(prefix), F.array_join(F.transform("_s", lambda s: s["s"]), ""), tail.ob, F.lit(suffix_prefill)
        ).alias("prompt"),
        "render_ok",
    )


def truncate_text(text: Column, n: int | None, tokenizer=DEFAULT) -> Column:
    """Keep the first ``n`` tokens of a text (lossless pieces); None = no cut."""
    if n is None:
        return text
    return F.array_join(F.slice(tokenizer.pieces(text), 1, n), "")


def weight_spans(tokens: DataFrame, datum: str, pos: str, weight: str) -> DataFrame:
    """Maximal runs of the same weight sign per datum (gaps and islands).

    A span starts where ``sign(weight)`` differs from the previous token; a
    running sum of starts numbers the spans.
    """
    w = Window.partitionBy(datum).orderBy(pos)
    sgn = F.signum(F.col(weight))
    staged = tokens.withColumn("_sgn", sgn).withColumn(
        "_start", F.when(F.lag("_sgn").over(w).eqNullSafe(F.col("_sgn")), 0).otherwise(1)
    )
    staged = staged.withColumn("span", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    return staged.groupBy(datum, "span").agg(
        F.first("_sgn").alias("sign"),
        F.min(pos).alias("start_pos"),
        F.max(pos).alias("end_pos"),
        F.count(F.lit(1)).alias("n_tokens"),
    )
