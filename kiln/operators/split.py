"""Shuffle, split, batch and mix.

All orders are deterministic: the shuffle key is md5('<seed>:<id>') with the
id as tie-break, never ``rand()`` or file order, so the same rows get the same
positions on any cluster size and in any engine.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.ranking import group_places, md5_key, md5_unit, top_k_per_group


#: Hex digits of the shuffle key that make a bucket, and of those the ones that make a range of buckets.
BUCKET_DIGITS, RANGE_DIGITS = 5, 2


def bucket_digits(rows: int | None, per_bucket: int = 100_000) -> int:
    """Digits for about ``per_bucket`` rows a bucket, from an estimate of the rows (None: 16^5 buckets)."""
    if rows is None:
        return BUCKET_DIGITS
    digits = RANGE_DIGITS
    while rows > per_bucket * 16**digits and digits < 8:
        digits += 1
    return digits


def shuffle_rank(
    df: DataFrame,
    seed: int | str | Column,
    id_col: str,
    rank_col: str = "global_rank",
    group: Sequence[str] = (),
    rows: int | None = None,
    keep_total: bool = False,
) -> DataFrame:
    """D1 (+D10 with ``group``): 1-based position after a seeded shuffle.

    md5 keys are uniform, so their first hex digits split the key space into equal buckets: position = rows in earlier
    buckets of the same group + row number inside the bucket. The rows before a bucket come from a prefix sum of two
    levels (ranges of buckets, buckets of a range), each a window over a bounded number of counts, and
    meet the rows in a join on (group, bucket), by which these are partitioned already: nothing is broadcast, no step
    sorts a whole group in one task, and a hot group is spread over all its buckets. ``rows``: an estimate of the rows.
    """
    seed_col = seed if isinstance(seed, Column) else F.lit(str(seed))
    key = F.md5(F.concat(seed_col.cast("string"), F.lit(":"), F.col(id_col).cast("string")))
    staged = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, bucket_digits(rows)))
    g = list(group)
    counts = staged.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_range", F.substring("_bucket", 1, RANGE_DIGITS))
    ranges = counts.groupBy(*g, "_range").agg(F.sum("_n").alias("_n"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    all_rows = F.sum("_n").over(Window.partitionBy(*(g or [F.lit(0)])))
    ranges = ranges.select(*g, "_range", before(Window.partitionBy(*(g or [F.lit(0)])).orderBy("_range")).alias("_start"), all_rows.alias("_group_rows"))
    inside = counts.select(*g, "_range", "_bucket", before(Window.partitionBy(*g, "_range").orderBy("_bucket")).alias("_offset"))
    offsets = inside.join(ranges, [*g, "_range"]).select(*g, "_bucket", (F.col("_offset") + F.col("_start")).alias("_offset"), "_group_rows")
    local = Window.partitionBy(*g, "_bucket").orderBy("_key", id_col)
    out = (
        staged.withColumn("_local", F.row_number().over(local))
        .join(offsets, [*g, "_bucket"])
        .withColumn(rank_col, (F.col("_offset") + F.col("_local")).cast("long"))
        .drop("_key", "_bucket", "_local", "_offset")
    )
    # keep_total: the group's row count rides along (used by drop-last batching, no extra pass)
    return out if keep_total else out.drop("_group_rows")


def _rows_of(ranked: DataFrame) -> Column:
    """The number of rows: what rides along with the ranks, else a scalar subquery."""
    return F.col("_group_rows") if "_group_rows" in ranked.columns else ranked.agg(F.count(F.lit(1))).scalar()


def head_split(ranked: DataFrame, test_size: int | Column, rank_col: str = "global_rank") -> DataFrame:
    """First ``test_size`` shuffled rows are test, the rest train.

    Split only if ``0 < test_size < n``; otherwise everything is train. n rides along with the ranks
    (``keep_total``) or is a scalar subquery.
    """
    size = F.lit(test_size) if isinstance(test_size, int) else test_size
    split = (size > 0) & (size < _rows_of(ranked)) & (F.col(rank_col) <= size)
    return ranked.withColumn("split", F.when(split, F.lit("test")).otherwise(F.lit("train"))).drop("_group_rows")


def relative_test_size(n: int | Column, cap: int = 1024, denom: int = 10) -> int | Column:
    """``min(cap, n // denom)``."""
    return min(cap, n // denom) if isinstance(n, int) else F.least(F.lit(cap), F.floor(n / denom))


def tail_split(ranked: DataFrame, test_size: int | Column, rank_col: str = "global_rank") -> DataFrame:
    """D4 tail variant: the last ``test_size`` rows are the test split."""
    return ranked.withColumn(
        "split", F.when(F.col(rank_col) > _rows_of(ranked) - test_size, F.lit("test")).otherwise(F.lit("train"))
    ).drop("_group_rows")


def ratio_split(df: DataFrame, test_ratio: float, seed: int, id_col: str) -> DataFrame:
    """Stable hash split; a row is test when md5('<seed>:<id>')/2^32 < ratio."""
    return df.withColumn(
        "split", F.when(md5_unit(seed, id_col) < F.lit(test_ratio), F.lit("test")).otherwise(F.lit("train"))
    )


def assign_batches(
    ranked: DataFrame,
    batch_size: int,
    drop_last: bool,
    n: int | None = None,
    rank_col: str = "global_rank",
    batch_col: str = "batch_idx",
) -> DataFrame:
    """D7 (drop last, ``n // b`` batches) and D8 (keep last, ``ceil(n / b)``)."""
    out = ranked.withColumn(batch_col, F.floor((F.col(rank_col) - 1) / F.lit(batch_size)).cast("long"))
    if drop_last:
        # n // b full batches; n as a scalar subquery unless already known
        if n is not None:
            n_col = F.lit(n)
        elif "_group_rows" in ranked.columns:
            n_col = F.col("_group_rows")
        else:
            n_col = ranked.agg(F.count(F.lit(1))).scalar()
        out = out.filter(F.col(batch_col) < F.floor(n_col / F.lit(batch_size)))
    return out.drop("_group_rows")


def single_batch(df: DataFrame, batch_col: str = "batch_idx") -> DataFrame:
    """The whole (test) set is batch 0."""
    return df.withColumn(batch_col, F.lit(0).cast("long"))


def epochs(df: DataFrame, n_epochs: int, epoch_col: str = "epoch") -> DataFrame:
    """Repeat every row for ``n_epochs`` epochs."""
    return df.withColumn(epoch_col, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_epochs - 1).cast("long"))))


def epoch_shuffle(df: DataFrame, n_epochs: int, id_col: str, rank_col: str = "global_rank") -> DataFrame:
    """Reshuffle per epoch with seed = epoch; one table for all epochs."""
    return shuffle_rank(epochs(df, n_epochs), F.col("epoch"), id_col, rank_col, group=["epoch"])


def per_group_sample(df: DataFrame, group: str, k: int, seed: int, id_col: str) -> DataFrame:
    """Up to ``k`` rows per group in seeded order; small groups kept whole.

    Two-round salted top-k, so a hot group is not sorted in one task.
    """
    key = md5_key(seed, id_col)
    salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(16))
    return top_k_per_group(df, [group], [key, F.col(id_col)], k, salt=salt)


def row_cap(df: DataFrame, n: int | None, seed: int, id_col: str) -> DataFrame:
    """The first ``n`` rows of the seeded order (None = all), by a top-n that keeps n rows a task, not a rank of all."""
    return df if n is None else df.orderBy(md5_key(seed, id_col), F.col(id_col)).limit(n)


def composite_batches(datasets: Sequence[DataFrame], sizes: Sequence[int], rank_col: str = "global_rank") -> DataFrame:
    """Batch i = batch i of every dataset, each with its own batch size.

    Batches are counted with drop-last per dataset; only batch indices below
    the minimum batch count are kept. ``dataset_idx`` records the source. As many sizes as datasets, or an error.
    """
    if len(datasets) != len(sizes):
        raise ValueError(f"{len(datasets)} datasets, {len(sizes)} batch sizes")
    if not datasets:
        raise ValueError("no datasets")
    counts = [F.floor(r.agg(F.count(F.lit(1))).scalar() / b) for r, b in zip(datasets, sizes, strict=True)]
    least = F.least(*counts) if len(counts) > 1 else counts[0]
    outs = [
        assign_batches(r, b, drop_last=False, rank_col=rank_col).withColumn("dataset_idx", F.lit(k).cast("long")).filter(F.col("batch_idx") < least)
        for k, (r, b) in enumerate(zip(datasets, sizes, strict=True))
    ]
    return reduce(lambda a, c: a.unionByName(c, allowMissingColumns=True), outs)


def replicate(df: DataFrame, group_size: int | Column, col: str = "sample_idx") -> DataFrame:
    """Each row becomes ``group_size`` rows (e.g. rollouts per problem)."""
    g = group_size if isinstance(group_size, Column) else F.lit(group_size)
    return df.withColumn(col, F.explode(F.sequence(F.lit(0).cast("long"), (g - 1).cast("long"))))


def even_chunk(i: Column, n: Column, k: Column) -> Column:
    """Chunk of 0-based row ``i`` when ``n`` rows are cut into ``k`` chunks.

    Edges are ``floor(j * (n / k))`` in double arithmetic (= numpy linspace
    cast to int); the chunk is the number of inner edges ≤ i. Fewer than one chunk, or more chunks than rows, is an error.
    """
    kk = F.when((k >= 1) & (k <= n), k).otherwise(F.raise_error(F.concat(F.lit("cannot cut "), n.cast("string"), F.lit(" rows into "), k.cast("string"))).cast("int"))
    return F.size(
        F.filter(F.sequence(F.lit(1), F.greatest(kk - 1, F.lit(1))), lambda j: (j < kk) & (F.floor(j * (n.cast("double") / kk)) <= i))
    ).cast("long")


def minibatch_geometry(
    ranked_in_batch: Column, groups_per_batch: int, num_substeps: int, num_minibatches: int
) -> tuple[Column, Column]:
    """(substep, minibatch) of a 1-based position inside a batch; sizes must divide."""
    if groups_per_batch % num_substeps or (groups_per_batch // num_substeps) % num_minibatches:
        raise ValueError("groups_per_batch must split evenly into substeps and minibatches")
    per_sub = groups_per_batch // num_substeps
    per_mini = per_sub // num_minibatches
    i = ranked_in_batch - 1
    return (F.floor(i / per_sub).cast("long"), F.floor(F.pmod(i, F.lit(per_sub)) / per_mini).cast("long"))


def arithmetic_problems(index: DataFrame, id_col: str, batch_size: int, seed: int = 0) -> DataFrame:
    """X, y uniform in 0..100 per row, derived from md5 of (seed, batch, row)."""
    batch = F.floor(F.col(id_col) / batch_size).cast("long")
    h = F.md5(F.concat(F.lit(f"{seed}:"), batch.cast("string"), F.lit(":"), F.col(id_col).cast("string")))
    x = F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(101))
    y = F.pmod(F.conv(F.substring(h, 9, 8), 16, 10).cast("long"), F.lit(101))
    return index.select(F.col(id_col).alias("problem_id"), batch.alias("batch_idx"), x.alias("x"), y.alias("y"))


def representatives(df: DataFrame, group: str, score: str, id_col: str, k: int) -> DataFrame:
    """Per group, sort by score and keep k evenly spaced positions.

    Positions are ``floor(linspace(0, n-1, k))``; groups of at most k rows are kept whole.
    """
    staged = group_places(df, group, [score, id_col])
    step = (F.col("_n") - 1).cast("double") / F.lit(max(k - 1, 1))
    targets = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda j: F.when(j == k - 1, F.col("_n") - 1).otherwise(F.floor(j * step)).cast("long"),
    )
    pick = F.array_contains(targets, F.col("_pos")) if k > 1 else F.col("_pos") == 0
    return staged.filter((F.col("_n") <= k) | pick).drop("_n")
