"""Distributed ranking helpers.

``row_number()`` without ``PARTITION BY`` moves every row into one task. The
helpers here give the same dense 1..n rank with the work spread over the
cluster:

* ``hash_rank`` orders by an md5 hex key (the deterministic shuffle key of
  D1). md5 is uniform, so its leading hex digits cut the key space into equal
  buckets without sampling: rank = rows in earlier buckets + local row number.
  The per-bucket count table has a fixed size (16**prefix rows) and is the only
  thing broadcast.
* ``range_rank`` handles arbitrary sort keys: range-partition, freeze the
  partition id with a reliable checkpoint (sampling of range bounds is not
  repeatable), then the same offset trick per partition.
* ``top_k_per_group`` keeps the k first rows of every group in two rounds
  (salted partial top-k, then a final top-k over at most k·salts candidates),
  so one hot group never sorts in a single task.
* ``group_places`` gives every row its place in its group and the group's size: slices of
  (group, order) are ranked by themselves, so a hot group spreads over many of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir, shuffle_partitions


def md5_key(seed: int | str, id_col: str | Column) -> Column:
    """Deterministic, engine-independent shuffle key: md5('<seed>:<id>')."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))


def md5_unit(seed: int | str, id_col: str | Column) -> Column:
    """Uniform double in [0,1) from the first 8 hex digits of ``md5_key``."""
    return F.conv(F.substring(md5_key(seed, id_col), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _offsets(counts: DataFrame, bucket: str) -> DataFrame:
    """Exclusive prefix sums of per-bucket counts (tiny, bounded table)."""
    w = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))


def hash_rank(
    df: DataFrame,
    key: Column,
    tie: Sequence[str],
    rank_col: str = "global_rank",
    prefix_digits: int = 3,
) -> DataFrame:
    """Dense 1-based rank by (md5 hex ``key``, ``tie``) without a single-task sort.

    ``prefix_digits`` hex digits give 16**d buckets; the offset table has at
    most that many rows (4 096 by default), a proven bound for the broadcast.
    """
    staged = df.withColumn("_key", key).withColumn(
        "_bucket", F.conv(F.substring("_key", 1, prefix_digits), 16, 10).cast("int")
    )
    counts = staged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = F.broadcast(_offsets(counts, "_bucket"))
    w = Window.partitionBy("_bucket").orderBy("_key", *tie)
    ranked = staged.withColumn("_local", F.row_number().over(w))
    return ranked.join(offsets, "_bucket").withColumn(
        rank_col, (F.col("_offset") + F.col("_local")).cast("long")
    ).drop("_key", "_bucket", "_local", "_offset")


def range_slices(df: DataFrame, order: Sequence[str], slice_col: str, n: int | None = None) -> DataFrame:
    """``df`` with the number of its slice: consecutive ranges of ``order``, about equal in rows.

    Range bounds come from a sample, which is not repeatable: the slices are frozen by a reliable checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    cut = df.repartitionByRange(n or shuffle_partitions(df.sparkSession), *order)
    return cut.withColumn(slice_col, F.spark_partition_id()).checkpoint(eager=True)


def range_rank(df: DataFrame, order: Sequence[str | Column], rank_col: str = "global_rank") -> DataFrame:
    """Dense 1-based rank by arbitrary unique ``order`` columns, spread over range partitions."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = shuffle_partitions(spark)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    frozen = df.repartitionByRange(n, *cols).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = F.broadcast(_offsets(counts, "_pid"))  # one row per partition
    w = Window.partitionBy("_pid").orderBy(*cols)
    return (
        frozen.withColumn("_local", F.row_number().over(w))
        .join(offsets, "_pid")
        .withColumn(rank_col, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_pid", "_local", "_offset")
    )


def group_places(df: DataFrame, group: str, order: Sequence[str], pos_col: str = "_pos", n_col: str = "_n") -> DataFrame:
    """0-based place of each row in its ``group`` by unique ``order`` columns, and the group's size.

    What meets in one task of a group is one row a slice; null groups are one group.
    """
    cut = range_slices(df, [group, *order], "_slice")
    counts = cut.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    earlier = F.sum("_rows").over(whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col(group).alias("_group"),
        F.col("_slice").alias("_of"),
        F.coalesce(earlier, F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias(n_col),
    )
    local = F.row_number().over(Window.partitionBy(group, "_slice").orderBy(*order))
    placed = cut.withColumn("_local", local).join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of")))
    place = (F.col("_before") + F.col("_local") - 1).cast("long")
    return placed.withColumn(pos_col, place).drop("_slice", "_group", "_of", "_before", "_local")


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    salt: Column | None = None,
    salts: int = 16,
    rank_col: str = "rank_in_group",
) -> DataFrame:
    """The first ``k`` rows of each group by ``order`` (exact, skew-safe).

    Round 1 ranks inside (group, salt) sub-groups and keeps ≤k rows of each;
    round 2 ranks the ≤k·salts survivors per group. ``order`` must be unique
    inside a group so the result is deterministic.
    """
    if salt is None:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    partial = df.withColumn("_salt", salt).withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (
        partial.withColumn(rank_col, F.row_number().over(w2).cast("long"))
        .filter(F.col(rank_col) <= k)
        .drop("_salt", "_r1")
    )
