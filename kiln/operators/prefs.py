"""Comparisons, pair rows and tournaments.

Tournament pairs are an equi-join on (group, chunk) with a residual ``i < j``
or ``i <> j``: the chunk key bounds the pairs per task to chunk_size², never
all pairs of a group and never a Cartesian product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators import split
from kiln.operators.ranking import md5_unit

PATTERNS = ("all_pairs_both_ways", "all_pairs_one_way")

# ---- fixed values: comparison rendering markers ----
MARK_A = "==== Completion A ===="
MARK_B = "==== Completion B ===="
MARK_PREF = "==== Preference ===="
# ---- end of fixed values ----


def tournament_pairs(players: DataFrame, group: str, idx: str, pattern: str, chunk_size: int) -> DataFrame:
    """Matchups (i, j) inside consecutive chunks of ≤ chunk_size players."""
    if pattern not in PATTERNS:
        raise ValueError(f"unknown pattern {pattern!r}")
    p = players.withColumn("_chunk", F.floor(F.col(idx) / chunk_size).cast("long"))
    a = p.select(group, "_chunk", *[F.col(c).alias(f"{c}_i") for c in p.columns if c not in (group, "_chunk")])
    b = p.select(group, "_chunk", *[F.col(c).alias(f"{c}_j") for c in p.columns if c not in (group, "_chunk")])
    cond = F.col(f"{idx}_i") < F.col(f"{idx}_j") if pattern == "all_pairs_one_way" else F.col(f"{idx}_i") != F.col(f"{idx}_j")
    return a.join(b, [group, "_chunk"]).filter(cond).drop("_chunk")


def prompt_groups(ranked: DataFrame, batch_size: int, group_size: int, prompt: str = "prompt") -> DataFrame:
    """Shuffled prompts (with ranks) → batches (drop last) → a group of players each; null prompts go after batching (T4)."""
    batched = split.assign_batches(ranked, batch_size, drop_last=True)
    return split.replicate(batched.filter(F.col(prompt).isNotNull()), group_size, "idx")


def comparison_rows(players: DataFrame, pattern: str, chunk_size: int, group: str = "group_id", idx: str = "idx", prompt: str = "prompt",
                    completion: str = "completion") -> DataFrame:
    """A comparison row for every matchup of a group: the shared prompt, A = player i, B = player j."""
    same = [c for c in players.columns if c not in (group, idx, completion)]
    m = tournament_pairs(players, group, idx, pattern, chunk_size)
    cmp = F.struct(F.col(f"{prompt}_i").alias("prompt"), F.col(f"{completion}_i").alias("completion_a"), F.col(f"{completion}_j").alias("completion_b"))
    return m.select(group, *[F.col(f"{c}_i").alias(c) for c in same if c != prompt], f"{idx}_i", f"{idx}_j", cmp.alias("cmp"))


def win_minus_loss(matches: DataFrame, group: str, idx: str, reward: str, valid: DataFrame | None = None,
                   format_coef: float = 1.0) -> DataFrame:
    """P5: r adds to j and subtracts from i, divided by the player's match count.

    A player without matches (a chunk of one) gets null (``try_divide``, T9).
    ``valid`` (group, idx, is_valid) adds ``format_coef·(valid − 1)``.
    """
    credit = matches.select(group, F.col(f"{idx}_j").alias(idx), F.col(reward).alias("_r")).unionByName(
        matches.select(group, F.col(f"{idx}_i").alias(idx), (-F.col(reward)).alias("_r"))
    )
    agg = credit.groupBy(group, idx).agg(F.sum("_r").alias("_s"), F.count(F.lit(1)).alias("n_matches"))
    out = agg.select(group, idx, "n_matches", F.try_divide(F.col("_s"), F.col("n_matches").cast("double")).alias("win_minus_loss"))
    if valid is not None:
        out = valid.join(out, [group, idx], "left").withColumn(
            "reward", F.col("win_minus_loss") + F.lit(format_coef) * (F.col("is_valid").cast("double") - 1.0)
        )
    return out


def swap(cmp: Column) -> Column:
    """A↔B and label A↔B (Tie stays)."""
    lab = cmp["label"]
    return F.struct(
        cmp["prompt"].alias("prompt"),
        cmp["completion_b"].alias("completion_a"),
        cmp["completion_a"].alias("completion_b"),
        F.when(lab == "A", "B").when(lab == "B", "A").otherwise(lab).alias("label"),
    )


def swap_augment(df: DataFrame, cmp: str, both: bool, seed: int = 0, id_col: str = "pair_id", swapped: str = "swapped") -> DataFrame:
    """Emit both orders (column ``swapped``: 0 as given, 1 swapped), or swap each row with probability ½ by a per-row hash (T5)."""
    if both:
        rest = [c for c in df.columns if c != cmp]
        return df.select(*rest, F.posexplode(F.array(F.col(cmp), swap(F.col(cmp)))).alias(swapped, cmp)).withColumn(swapped, F.col(swapped).cast("long"))
    return df.withColumn(cmp, F.when(md5_unit(seed, id_col) < 0.5, swap(F.col(cmp))).otherwise(F.col(cmp)))


def chosen_rejected(df: DataFrame, cmp: str, strict_compat: bool = True) -> DataFrame:
    """Two rows per comparison, chosen first; label A → A chosen, anything else → B.

    ``strict_compat=False`` drops ties instead of training B as chosen.
    """
    src = df if strict_compat else df.filter(F.col(f"{cmp}.label") != "Tie")
    a_chosen = F.col(f"{cmp}.label") == "A"
    chosen = F.when(a_chosen, F.col(f"{cmp}.completion_a")).otherwise(F.col(f"{cmp}.completion_b"))
    rejected = F.when(a_chosen, F.col(f"{cmp}.completion_b")).otherwise(F.col(f"{cmp}.completion_a"))
    pairs = src.select(*[c for c in df.columns if c != cmp], F.col(f"{cmp}.prompt").alias("prompt"),
                       F.col(f"{cmp}.label").alias("label"), F.posexplode(F.array(chosen, rejected)).alias("side_idx", "completion"))
    return pairs.withColumn("side", F.when(F.col("side_idx") == 0, "chosen").otherwise("rejected"))


def comparison_to_conversation(cmp: Column) -> Column:
    """Prompt + marker A + completion A + marker B + completion B + preference marker."""

    def sysmsg(text: str) -> Column:
        return F.array(F.struct(F.lit("system").alias("role"), F.lit(text).alias("content")))

    return F.concat(cmp["prompt"], sysmsg(MARK_A), cmp["completion_a"], sysmsg(MARK_B), cmp["completion_b"], sysmsg(MARK_PREF))


def preference_row(tokens: Column, weights: Column) -> tuple[Column, Column]:
    """Cut at the first weight-1 token so exactly one token is trained."""
    k = F.array_position(weights, 1)
    return F.slice(tokens, 1, k.cast("int")), F.slice(weights, 1, k.cast("int"))
