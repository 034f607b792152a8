"""Driver tables and the logical inputs bound to them (FIXTURES.md part B).

Every reader is a lazy ``spark.read.parquet``; Catalyst prunes columns and
pushes filters into the scan, so callers select only what they use.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.session import shuffle_partitions

#: Rows of ``lineitem`` that one task sorts.
ROWS_PER_TASK = 250_000

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long form of chat messages: (conv_id, turn, role, content)."""
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.col("text").alias("content")
    )


def rich_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``messages`` with thinking and tool calls (JSON text, written without spaces) on some assistant messages."""
    m = messages(spark, sf_dir)
    reply = F.col("role") == "assistant"
    said = F.regexp_replace(F.substring("content", 1, 12), "\n", "\\\\n")
    call = F.concat(
        F.lit('{"name":"search","args":{"query_list":["'), said, F.lit('","é😀"],"n":2.50,"at":{"turn":'), F.col("turn").cast("string"),
        F.lit(',"b":true,"a":null}}}'))
    calls = F.when(F.col("turn") % 3 == 1, F.array(call)).when(F.col("turn") % 3 == 2, F.array(call, call))
    return m.withColumn("thinking", F.when(reply & (F.col("turn") % 4 != 1), F.concat(F.lit("step "), F.col("turn").cast("string")))).withColumn(
        "tool_calls", F.when(reply, calls))


def step_index(partition: str = "l_orderkey") -> Column:
    """Step number of a line item inside its order (unique order of the row)."""
    w = Window.partitionBy(partition).orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return F.row_number().over(w).cast("long")


def numbered_items(spark: SparkSession, sf_dir: str, key: str = "traj_id", step: str = "step") -> DataFrame:
    """``lineitem`` with its order as ``key`` and the step of each row, dealt by order to tasks of a bounded number of rows.

    A task holds its rows in one sort for each order that later windows ask for, so the number of tasks follows the rows
    (a count that the files' footers tell). The key is named before the rows are dealt: windows, joins and groups by
    it need no further shuffle.
    """
    li = table(spark, sf_dir, "lineitem")
    tasks = max(shuffle_partitions(spark), math.ceil(li.count() / ROWS_PER_TASK))
    return li.withColumnRenamed("l_orderkey", key).repartition(tasks, key).withColumn(step, step_index(key))


def steps(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Steps of the trajectories bound to ``lineitem`` alone: (traj_id, step, reward, ob_len, ac_len, metrics).

    trajectory = order, step = line position, reward = discount, observation length = quantity, action length = line
    number, metrics = {format, correct} with ``correct`` missing for flag ``N``. ``numbered``: for those who use the
    step; sums that don't need no rows dealt.
    """
    if numbered:
        li = numbered_items(spark, sf_dir)
    else:
        li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "traj_id").withColumn("step", step_index("traj_id"))
    return li.select(
        "traj_id",
        "step",
        (F.col("l_discount") + F.lit(0.0)).alias("reward"),
        F.col("l_quantity").cast("long").alias("ob_len"),
        F.col("l_linenumber").cast("long").alias("ac_len"),
        F.when(
            F.col("l_returnflag") == "N",
            F.create_map(F.lit("format"), (F.col("l_returnflag") == "R").cast("double")),
        )
        .otherwise(
            F.create_map(
                F.lit("format"), (F.col("l_returnflag") == "R").cast("double"),
                F.lit("correct"), (F.col("l_linestatus") == "O").cast("double"),
            )
        )
        .alias("metrics"),
    )


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RL transitions bound to ``orders ⋈ lineitem``: ``steps`` with their group (customer)."""
    od = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("traj_id"), F.col("o_custkey").alias("group_id"))
    return steps(spark, sf_dir, numbered=True).join(od, "traj_id").select("group_id", "traj_id", "step", "reward", "ob_len", "ac_len", "metrics")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: final reward = 1.0 for status F; all orders kept."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("group_id"),
        F.col("o_orderkey").alias("traj_id"),
        F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0).alias("final_reward"),
        F.month("o_orderdate").cast("long").alias("sampler_step"),
        "o_orderpriority",
    )


def token_rows(spark: SparkSession, sf_dir: str, numbered: bool = False) -> DataFrame:
    """Token-level rows bound to ``lineitem``.

    seq = order, pos = step, logp_sample = -10·discount, logp_train =
    -10·tax, mask = flag R, weight = status O, dataset = supplier mod 3. ``numbered``: see ``steps``.
    """
    if numbered:
        li = numbered_items(spark, sf_dir, "seq_id", "pos")
    else:
        li = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "seq_id").withColumn("pos", step_index("seq_id"))
    return li.select(
        "seq_id",
        "pos",
        (F.lit(-10.0) * F.col("l_discount") + F.lit(0.0)).alias("logp_sample"),
        (F.lit(-10.0) * F.col("l_tax") + F.lit(0.0)).alias("logp_train"),
        (F.col("l_returnflag") == "R").cast("double").alias("mask"),
        (F.col("l_linestatus") == "O").cast("double").alias("weight"),
        F.pmod(F.col("l_suppkey"), F.lit(3)).alias("dataset_idx"),
        F.col("l_partkey").alias("token"),
    )
