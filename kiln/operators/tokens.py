"""Token-level numerics on logged log-probabilities.

Long form ``token_rows(seq_id, pos, logp_sample, logp_train, mask, weight,
dataset_idx, ...)`` is the scalable shape: every metric is a partial
aggregation. Array forms (one row per datum) are supported with
higher-order functions for data that arrives that way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.joins import lookup, strict_zip, unique
from kiln.operators.ranking import range_rank


def mean_nll(df: DataFrame, logp: str, weight: str, by: list[str] = ()) -> DataFrame:
    """L1: −Σ(logp·w) / Σw; Σw = 0 → NaN."""
    num = F.sum(F.col(logp) * F.col(weight))
    den = F.sum(weight)
    return df.groupBy(*by).agg(
        F.when(den == 0, F.lit(float("nan"))).otherwise(-num / den).alias("mean_nll"),
        den.cast("double").alias("sum_weights"),
    )


def dot(a: Column, b: Column) -> Column:
    """Σ a·b of two equal-length arrays (higher-order functions, no UDF)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def kl_sample_train(df: DataFrame, sample: str, train: str, mask: str) -> DataFrame:
    """L2: on action tokens (mask > 0): v1 = mean(diff), v2 = ½·mean(diff²), entropy = −mean(sample)."""
    a = df.filter(F.col(mask) > 0)
    d = F.col(sample) - F.col(train)
    return a.agg(
        F.avg(d).alias("kl_sample_train_v1"),
        (F.lit(0.5) * F.avg(d * d)).alias("kl_sample_train_v2"),
        (-F.avg(sample)).alias("entropy"),
        F.count(F.lit(1)).alias("n_action_tokens"),
    )


def kl_pre_post(datums: DataFrame, post: DataFrame, seq: str = "seq_id", at: str = "at", prev: str = "logprob", mask: str = "mask",
                position: str = "position", new: str = "logprob") -> DataFrame:
    """L3: pre/post-update KL on action tokens (mask > 0).

    ``datums`` has the shifted targets (target ``at`` is token ``at + 1`` of the sequence); ``post`` the new logprobs of
    the whole sequence by position. Each target meets the logprob one position on; one that has none is an error.
    """
    after = post.select(F.col(seq), (F.col(position) - 1).alias(at), F.col(new).alias("_new"))
    a = lookup(datums.filter(F.col(mask) > 0), after, [seq, at], "post-update logprobs")
    d = F.col(prev) - F.col("_new")
    return a.agg(F.avg(d).alias("kl_pre_post_v1"), (F.lit(0.5) * F.avg(d * d)).alias("kl_pre_post_v2"))


def kl_penalty(df: DataFrame, sample: str, base: str, mask: str, coef: float, advantage: str = "advantage",
               discount: float = 0.0, seq: str = "seq_id", pos: str = "pos") -> DataFrame:
    """L4: ``adv += coef·mask·(avg_diff − diff)``, diff = (sample − base)·mask.

    avg_diff = Σ diff / Σ mask over the whole batch: one scalar subquery, NaN without unmasked tokens. With a ``discount``
    above 0 each token gets the discounted sum of the penalties from it on in its sequence (L6).
    """
    diff = (F.col(sample) - F.col(base)) * F.col(mask)
    avg = df.agg(F.coalesce(F.try_divide(F.sum(diff), F.sum(mask)), F.lit(float("nan")))).scalar()
    base_adv = F.coalesce(F.col(advantage), F.lit(0.0)) if advantage in df.columns else F.lit(0.0)
    out = df.withColumn("kl_policy_base", avg).withColumn("_kl", F.lit(coef) * F.col(mask) * (avg - diff))
    if discount > 0:
        out = discounted_rows(out, [seq], pos, "_kl", discount, "_kl")
    return out.withColumn(advantage, base_adv + F.col("_kl")).drop("_kl")


def teacher_kl(df: DataFrame, student: str, teacher: str, mask: str, coef: float, dataset: str = "dataset_idx",
               advantage: str = "advantage") -> tuple[DataFrame, DataFrame]:
    """Reverse KL vs a teacher, not centred (T23): ``adv += −coef·mask·(s − t)``.

    Returns (adjusted rows, metrics per dataset + batch); datasets with
    Σmask = 0 are omitted from the metrics.
    """
    rkl = (F.col(student) - F.col(teacher)) * F.col(mask)
    base = F.coalesce(F.col(advantage), F.lit(0.0)) if advantage in df.columns else F.lit(0.0)
    rows = df.withColumn(advantage, base - F.lit(coef) * rkl)
    per = df.groupBy(dataset).agg(F.try_divide(F.sum(rkl), F.sum(mask)).alias("teacher_kl"), F.sum(mask).alias("_m"))
    per = per.filter(F.col("_m") > 0).select(F.col(dataset).cast("string").alias("scope"), "teacher_kl")
    tot = df.agg(F.try_divide(F.sum(rkl), F.sum(mask)).alias("teacher_kl")).select(F.lit("all").alias("scope"), "teacher_kl")
    return rows, per.unionByName(tot)


#: Rows of one block of a discounted sum: what one fold holds.
BLOCK = 64


def discounted_rows(df: DataFrame, keys: list[str], pos: str, value: str, gamma: float, out: str, block: int = BLOCK, levels: int = 5) -> DataFrame:
    """``out[t] = value[t] + gamma·out[t+1]`` along each sequence, in time linear in its length.

    ``pos`` counts from 1 without gaps within ``keys``. A sequence is cut into blocks, each folded on its own; the sums at
    the heads of the blocks are a sequence of their own, with gamma to the block length, and are solved the same way
    (``levels`` deep at most: block**levels positions before one fold holds more than a block); each row then adds
    what its next block carries. A long sequence spreads over as many tasks as it has blocks; one of a single block
    never reaches the second level.
    """
    if not 0.0 <= gamma <= 1.0:
        raise ValueError("gamma must be from 0 to 1")
    rest = [c for c in df.columns if c not in keys and c != out]
    row = F.struct(F.col(pos).alias("p"), F.col(value).cast("double").alias("v"), F.struct(*rest).alias("row"))
    where = F.floor((F.col(pos) - 1) / block) if levels > 0 else F.lit(0)
    b = df.select(*keys, where.cast("long").alias("_block"), row.alias("_s"))
    b = b.groupBy(*keys, "_block").agg(F.array_sort(F.collect_list("_s"), lambda x, y: (x["p"] - y["p"]).cast("int")).alias("_s"))
    folded = F.aggregate(
        F.reverse(F.transform("_s", lambda s: s["v"])),
        F.array().cast("array<double>"),
        lambda acc, v: F.array_append(acc, v + F.lit(gamma) * F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0))),
    )
    b = b.withColumn("_y", F.reverse(folded))
    across = gamma**block
    if levels > 0 and across > 0.0:
        heads = b.where(F.col("_block") > 0).select(*keys, F.col("_block").alias("_pos"), F.col("_y")[0].alias("_head"))
        solved = discounted_rows(heads, keys, "_pos", "_head", across, "_sum", block, levels - 1)
        b = b.join(solved.select(*keys, (F.col("_pos") - 1).alias("_block"), F.col("_sum").alias("_carry")), [*keys, "_block"], "left")
    else:
        b = b.withColumn("_carry", F.lit(None).cast("double"))
    every = b.select(*keys, "_carry", F.posexplode(F.arrays_zip("_s", "_y")).alias("_i", "_z"))
    carried = F.when(F.col("_carry").isNotNull(), F.col("_carry") * F.pow(F.lit(gamma), F.lit(block) - F.col("_i"))).otherwise(0.0)
    return every.select(*keys, "_z._s.row.*", (F.col("_z._y") + carried).alias(out))


def dpo_metrics(sides: DataFrame, beta: float, pair: str = "pair_id") -> DataFrame:
    """DPO loss and metrics from per-side weighted log-ratios.

    ``sides(pair_id, side ∈ {chosen, rejected}, log_ratio)``; loss =
    mean(softplus(−β(c − r))) (stable form of −log σ), accuracy = mean(c > r),
    rewards = β·mean, ``margin`` = β·(chosen_reward − rejected_reward) as the
    reference reports it (T6), ``reward_margin`` with one β.
    """
    p = sides.groupBy(pair).agg(
        F.sum(F.when(F.col("side") == "chosen", F.col("log_ratio"))).alias("c"),
        F.sum(F.when(F.col("side") == "rejected", F.col("log_ratio"))).alias("r"),
    ).filter(F.col("c").isNotNull() & F.col("r").isNotNull())
    z = F.lit(beta) * (F.col("c") - F.col("r"))
    softplus_neg = F.when(z > 0, F.log1p(F.exp(-z))).otherwise(-z + F.log1p(F.exp(z)))
    m = p.agg(
        F.avg(softplus_neg).alias("dpo_loss"),
        F.avg((F.col("c") > F.col("r")).cast("double")).alias("accuracy"),
        (F.lit(beta) * F.avg("c")).alias("chosen_reward"),
        (F.lit(beta) * F.avg("r")).alias("rejected_reward"),
        F.count(F.lit(1)).alias("num_pairs"),
    )
    return m.withColumn("margin", F.lit(beta) * (F.col("chosen_reward") - F.col("rejected_reward"))).withColumn(
        "reward_margin", F.col("chosen_reward") - F.col("rejected_reward")
    )


def first_seen(df: DataFrame, token: str, trial: str, lp: str) -> DataFrame:
    """Logprob of each token from its first trial (ties by logprob)."""
    return df.groupBy(token).agg(F.min_by(F.col(lp), F.struct(trial, lp)).alias(lp))


def pairwise_ratio_metrics(base: DataFrame, temp: DataFrame, tau: float, token: str = "token") -> DataFrame:
    """Over all token pairs i<j common to both tables, |(lt_i − lt_j) − (lb_i − lb_j)/τ|.

    With a_i = lt_i − lb_i/τ each pair error is |a_i − a_j|, so no pairs are
    built: mean = Σ_k a_(k)·(2k − n − 1) / (n(n−1)/2) over the sorted a
    (distributed rank), max = max(a) − min(a). Fewer than 2 tokens → NaN.
    """
    j = base.select(token, F.col("lp").alias("lb")).join(temp.select(token, F.col("lp").alias("lt")), token)
    a = j.select(token, (F.col("lt") - F.col("lb") / F.lit(tau)).alias("a"))
    return _pair_stats(range_rank(a, [F.col("a"), F.col(token)], "k"))


def _pair_stats(ranked: DataFrame) -> DataFrame:
    n = ranked.agg(F.count(F.lit(1)).cast("double")).scalar()
    pairs = n * (n - 1) / 2
    return ranked.agg(
        F.sum(F.col("a") * (2 * F.col("k") - n - 1)).alias("_s"),
        (F.max("a") - F.min("a")).alias("_mx"),
        F.count(F.lit(1)).alias("n_tokens"),
    ).select(
        F.when(F.col("n_tokens") >= 2, F.col("_s") / pairs).otherwise(F.lit(float("nan"))).alias("mean_abs_err"),
        F.when(F.col("n_tokens") >= 2, F.col("_mx")).otherwise(F.lit(float("nan"))).alias("max_abs_err"),
        "n_tokens",
        F.when(F.col("n_tokens") >= 2, pairs).otherwise(F.lit(0.0)).cast("long").alias("n_pairs"),
    )


def compare_logprob_arrays(a: Column, b: Column) -> tuple[Column, Column]:
    """Mean / max |a − b| over the common length; empty → NaN."""
    n = F.least(F.size(a), F.size(b))
    d = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: F.abs(x - y))
    mean = F.when(n > 0, F.aggregate(d, F.lit(0.0).cast("double"), lambda acc, v: acc + v) / n).otherwise(F.lit(float("nan")))
    mx = F.when(n > 0, F.array_max(d)).otherwise(F.lit(float("nan")))
    return mean, mx


def mse_by_model(df: DataFrame, model: str, a: str, b: str) -> DataFrame:
    """Mean squared difference of sampling vs training logprobs per model."""
    return df.groupBy(model).agg(F.avg(F.pow(F.col(a) - F.col(b), 2)).alias("mse_sample_train"), F.count(F.lit(1)).alias("n_tokens"))


def prefix_merge(steps: DataFrame, traj: list[str], step: str = "step", ob: str = "ob_tokens", ac: str = "ac_tokens",
                 logp: str = "ac_logprobs", advantage: str = "advantage") -> DataFrame:
    """Merge the steps of each trajectory into training datums.

    A step continues the current datum when its observation starts with the previous full sequence (previous ob +
    previous ac); otherwise a new datum starts. What a step passes on to the next is its length and a digest (two
    independent hashes, 96 bits) of its full sequence, never the sequence; what goes on to the datum is what the step
    adds. New observation tokens get logprob 0 / advantage 0 / mask 0, action tokens the sampled logprob / trajectory
    advantage / mask 1. The datum is then shifted by one (input = tokens[:-1], targets = tokens[1:]).
    """
    w = Window.partitionBy(*traj).orderBy(step)
    digest = lambda c: F.struct(F.size(c).alias("n"), F.xxhash64(c).alias("h"), F.hash(c).alias("g"))
    s = steps.withColumn("_prev", F.lag(digest(F.concat(ob, ac))).over(w))
    n = F.col("_prev.n")
    # a prefix cut short by a shorter observation has another length
    goes_on = F.col("_prev").isNotNull() & (digest(F.slice(ob, 1, F.greatest(n, F.lit(0)))) == F.col("_prev"))
    s = s.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    s = s.withColumn("datum_idx", (F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).cast("long"))
    zero = F.transform(F.col(ac), lambda _: F.lit(0.0))
    lp = F.coalesce(F.col(logp).cast("array<double>"), zero) if logp in steps.columns else zero
    pair = strict_zip("action tokens and logprobs", t=F.col(ac), lp=lp)
    s = s.select(
        *traj, step, "datum_idx", F.when(F.col("_new") == 1, F.col(ob)).otherwise(F.slice(ob, n + 1, 1 << 30)).alias("_ob"), pair.alias("_ac"),
        (F.col(advantage) if advantage in steps.columns else F.lit(0.0)).cast("double").alias("_adv"),
    )
    g = s.groupBy(*traj, "datum_idx").agg(F.array_sort(F.collect_list(F.struct(step, "_ob", "_ac", "_adv"))).alias("_s"))
    cat = lambda f: F.flatten(F.transform("_s", f))
    per_token = lambda v: lambda x: F.concat(F.array_repeat(F.lit(0.0), F.size(x["_ob"])), F.transform(x["_ac"], lambda a: v(x, a)))
    g = g.select(
        *traj, "datum_idx", cat(lambda x: F.concat(x["_ob"], x["_ac"]["t"])).alias("tokens"), cat(per_token(lambda x, a: a["lp"])).alias("logprobs"),
        cat(per_token(lambda x, a: x["_adv"])).alias("advantages"), cat(per_token(lambda x, a: F.lit(1.0))).alias("mask"),
    )
    n = F.greatest(F.size("tokens") - 1, F.lit(0))
    return g.select(
        *traj, "datum_idx", "tokens", "mask",
        F.slice("tokens", 1, n).alias("input_tokens"),
        F.slice("tokens", 2, n).alias("target_tokens"),
        F.slice("logprobs", 2, n).alias("logprobs"),
        F.slice("advantages", 2, n).alias("advantages"),
        F.slice("mask", 2, n).alias("target_mask"),
    )


def group_places(trajs: DataFrame, group: str, traj: str) -> DataFrame:
    """(group, traj, group_idx, traj_idx): dense numbers of the groups and of the trajectories within each, by id.

    One range rank over (group, traj) and one over the groups: a hot group is spread over many ranges."""
    ranked = range_rank(trajs.select(group, traj), [group, traj], "_rank")
    first = range_rank(ranked.groupBy(group).agg(F.min("_rank").alias("_first")), [group], "_g")
    return ranked.join(first, group).select(group, traj, (F.col("_g") - 1).alias("group_idx"), (F.col("_rank") - F.col("_first")).alias("traj_idx"))


def training_rows(steps: DataFrame, advantages: DataFrame, group: str = "group_id", traj: str = "traj_id", step: str = "step") -> DataFrame:
    """A10: the datums of all trajectories with their advantage and (group_idx, traj_idx).

    ``steps`` (traj, step, ob_tokens, ac_tokens, ac_logprobs), ``advantages`` (group, traj, advantage), one row a trajectory.
    A trajectory of the steps without an advantage is an error; one without steps has no datum.
    """
    known = unique(advantages.select(group, traj, "advantage"), [traj], "advantages")
    data = lookup(steps, known.drop(group), [traj], "advantages")
    places = group_places(known, group, traj)
    # every key is known here; an inner join would let a filter on the advantages reach the steps before they are checked
    return prefix_merge(data, [traj], step).join(places, traj, "left")


def single_turn_rows(samples: DataFrame, prompt: str = "prompt_tokens", tokens: str = "tokens", logprobs: str = "logprobs",
                     advantage: str = "advantage") -> DataFrame:
    """One datum a sample: prompt + sampled tokens shifted by one, logprobs and advantages 0 over the prompt's targets."""
    pair = strict_zip("sampled tokens and logprobs", t=F.col(tokens), lp=F.col(logprobs))
    whole = F.concat(prompt, tokens)
    n, ob = F.size(whole) - 1, F.size(prompt) - 1
    zeros = F.array_repeat(F.lit(0.0), ob)
    return samples.withColumn("_pair", pair).select(
        *[c for c in samples.columns if c not in (prompt, tokens, logprobs, advantage)],
        F.slice(whole, 1, n).alias("input_tokens"), F.slice(whole, 2, n).alias("target_tokens"),
        F.concat(zeros, F.transform("_pair", lambda p: p["lp"].cast("double"))).alias("logprobs"),
        F.concat(zeros, F.array_repeat(F.col(advantage).cast("double"), n - ob)).alias("advantages"),
    )
