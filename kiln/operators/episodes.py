"""Rules over logged episodes (G19, G22, G23, U9) and hooks that users plug in.

A log has one row a turn. The rules are windows over the turns of one episode, which the environment bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from kiln.session import shuffle_partitions


def cut_at_first(turns: DataFrame, ends: Column, episode: str = "traj_id", turn: str = "turn", max_turns: int | None = None) -> DataFrame:
    """The turns up to and with the first for which ``ends`` holds, and no more than ``max_turns``."""
    first = F.min(F.when(ends, F.col(turn))).over(Window.partitionBy(episode))
    out = turns.withColumn("_end", first).where(F.col("_end").isNull() | (F.col(turn) <= F.col("_end"))).drop("_end")
    return out if max_turns is None else out.where(F.col(turn) <= max_turns)


def tool_episode(turns: DataFrame, tools: list[str], max_calls: int, max_tokens: int, episode: str = "traj_id", turn: str = "turn") -> DataFrame:
    """Turns of tool episodes up to the one that ends them, with ``failure`` (null: none).

    ``turns``: ``tool`` (the tool a turn calls, null for a plain answer), ``tool_error``, ``prompt_tokens`` (of the next prompt)
    and ``reward`` (what an answer earns). A call fails, with reward 0, when the tool is unknown, when it is one more
    than ``max_calls`` calls of known tools, when the tool raised, or when the prompt grew beyond ``max_tokens``, in this
    order; other calls earn 0 and go on; an answer ends the episode.
    """
    w = Window.partitionBy(episode).orderBy(turn).rowsBetween(Window.unboundedPreceding, 0)
    called = F.col("tool").isNotNull()
    known = F.coalesce(F.col("tool").isin(tools), F.lit(False))
    out = turns.withColumn("n_calls", F.sum(known.cast("long")).over(w))
    failure = (
        F.when(called & ~known, "unknown_tool").when(called & (F.col("n_calls") > max_calls), "too_many_calls")
        .when(called & F.coalesce("tool_error", F.lit(False)), "tool_error").when(called & (F.col("prompt_tokens") > max_tokens), "prompt_too_long")
    )
    out = out.withColumn("failure", failure).withColumn("reward", F.when(called, F.lit(0.0)).otherwise(F.col("reward")))
    out = out.withColumn("episode_done", ~called | F.col("failure").isNotNull())
    return cut_at_first(out, F.col("episode_done"), episode, turn)


def two_player_rewards(turns: DataFrame, game_rewards: DataFrame, episode: str = "traj_id", turn: str = "turn", player: str = "player",
                       penalty: float = -2.0) -> DataFrame:
    """One reward a player and game: ``penalty`` for who moved illegally, else what the game gave, else 0.

    A move is illegal when the same player is on turn again afterwards. ``game_rewards``: (episode, player, reward) of finished games.
    """
    after = F.lead(player).over(Window.partitionBy(episode).orderBy(turn))
    moves = turns.withColumn("_bad", F.coalesce(after == F.col(player), F.lit(False)))
    players = moves.groupBy(episode, player).agg(F.max("_bad").alias("illegal"), F.count(F.lit(1)).alias("n_moves"))
    joined = players.join(game_rewards.select(episode, player, F.col("reward").alias("_game")), [episode, player], "left")
    reward = F.when(F.col("illegal"), F.lit(penalty)).otherwise(F.coalesce("_game", F.lit(0.0)))
    return joined.select(episode, player, "n_moves", "illegal", reward.alias("reward"))


def calls_to_transitions(calls: DataFrame, scores: DataFrame, episode: str = "traj_id", at: str = "at") -> DataFrame:
    """Recorded model calls as transitions: the last call of an episode is ``done`` and earns its rubric score, others 0."""
    w = Window.partitionBy(episode).orderBy(at)
    t = calls.withColumn("step", F.row_number().over(w).cast("long")).withColumn("done", F.lead(at).over(w).isNull())
    t = t.join(scores.select(episode, F.col("score").alias("_score")), episode, "left")
    return t.withColumn("reward", F.when(F.col("done"), F.coalesce("_score", F.lit(0.0))).otherwise(F.lit(0.0))).drop("_score")


# ---- hooks: what a user passes in ----------------------------------------------------------------------------------
def map_rows(df: DataFrame, map_fn: Callable[[DataFrame], DataFrame] | None = None, flatmap_fn: Callable[[DataFrame], Column] | None = None,
             out: str = "datum") -> DataFrame:
    """Exactly one of ``map_fn`` (a row for a row) and ``flatmap_fn`` (an array column, a row for each element)."""
    if (map_fn is None) == (flatmap_fn is None):
        raise ValueError("exactly one of map_fn and flatmap_fn")
    if map_fn is not None:
        return df.transform(map_fn)
    return df.select(*df.columns, F.explode(flatmap_fn(df)).alias(out))


def graded(df: DataFrame, grader: Callable[[Column, Column], Column], response: str, target: str, out: str = "correct") -> DataFrame:
    """A grader of response and target; null counts as wrong."""
    return df.withColumn(out, F.coalesce(grader(F.col(response), F.col(target)), F.lit(False)))


def preferred(df: DataFrame, model: Callable[[Column], Column], cmp: str = "cmp", preprocess: Callable[[Column], Column] | None = None,
              out: str = "score") -> DataFrame:
    """U3 + U4: a preference model in [-1, 1] over comparisons whose completions pass ``preprocess`` first; values beyond are an error."""
    c = F.col(cmp)
    if preprocess is not None:
        clean = lambda side: F.transform(c[side], lambda m: m.withField("content", preprocess(m["content"])))
        c = c.withField("completion_a", clean("completion_a")).withField("completion_b", clean("completion_b"))
    score = model(c)
    bounded = F.when(score.between(-1.0, 1.0), score).otherwise(F.raise_error(F.concat(F.lit("preference outside [-1, 1]: "), score.cast("string"))).cast("double"))
    return df.withColumn(out, bounded)


def keep_groups(rows: DataFrame, predicate: Callable[[DataFrame], Column], group: str = "group_id") -> DataFrame:
    """Rows of the groups for which a predicate over aggregates of the group holds (partial aggregates, then a semi-join)."""
    kept = rows.groupBy(group).agg(predicate(rows).alias("_keep")).where("_keep").select(group)
    return rows.join(kept, group, "left_semi")


def _starts(keys: pd.Series) -> np.ndarray:
    """Places where a run of equal keys starts; nulls are equal."""
    changes = keys.ne(keys.shift()).to_numpy(dtype=bool, na_value=True) & ~(keys.isna() & keys.shift().isna()).to_numpy()
    changes[:1] = True
    return np.flatnonzero(changes)


def _whole_groups(frames: Iterable[pd.DataFrame], group: str) -> Iterator[pd.DataFrame]:
    """Frames sorted by ``group`` cut anew, so that none ends within a group."""
    held: list[pd.DataFrame] = []
    for f in frames:
        if held and len(_starts(pd.concat([held[-1][group].iloc[-1:], f[group].iloc[:1]]))) == 2:
            yield pd.concat(held)
            held = []
        last = _starts(f[group])[-1]
        if last:
            yield pd.concat([*held, f.iloc[:last]])
            held = []
        held.append(f.iloc[last:])
    if held:
        yield pd.concat(held)


def group_rewards(rows: DataFrame, fn: Callable, schema: str, group: str = "group_id", many: bool = False) -> DataFrame:
    """A user's function over one whole group as a pandas frame: groups are those of one problem, which the sampler bounds.

    With ``many`` the function takes a frame of many whole groups and tells them apart by ``group``: a call a group costs
    about a millisecond, whatever its rows. Arrow frames carry many groups in both cases. Groups are dealt to a set number
    of tasks, at least three a core, as tasks cut by bytes would leave all calls to a few."""
    spark = rows.sparkSession
    # one more than a join shuffles to: the shuffle of a join by the group would be used again, and merged by bytes
    tasks = 1 + max(shuffle_partitions(spark), 3 * spark.sparkContext.defaultParallelism)
    whole = [f.name for f in rows.schema if isinstance(f.dataType, IntegralType)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in _whole_groups((f for f in frames if len(f)), group):
            if many:
                yield fn(f.reset_index(drop=True))
                continue
            starts = _starts(f[group])
            # a null makes the whole numbers of a frame floats; groups without one get theirs back
            floats = [c for c in whole if f[c].dtype.kind == "f"]
            done = []
            for a, b in zip(starts, [*starts[1:], len(f)], strict=True):
                one = f.iloc[a:b].reset_index(drop=True)
                done.append(fn(one.astype({c: "int64" for c in floats if one[c].notna().all()}) if floats else one))
            yield pd.concat(done)

    return rows.repartition(tasks, group).sortWithinPartitions(group).mapInPandas(run, schema)
