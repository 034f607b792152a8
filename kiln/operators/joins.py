"""Joins that check what they are given (J3, J4): a missing key, a doubled key or lists of unequal length are errors.

The checks are part of the plan: a violation fails the job that meets it, with the key in the message. They cost the
join itself and, for doubled keys, one partial aggregate a side; hot keys are aggregated before they are shuffled.
The check guards every column that the join adds, besides the rows: a filter on such a column later in the plan
would else turn the outer join into an inner one and lose the rows before they are checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _named(on: Sequence[str]) -> Column:
    return F.to_json(F.struct(*on))


def _guarded(df: DataFrame, on: Sequence[str], cols: Sequence[str], there: Column, message: str) -> DataFrame:
    """Rows where ``there`` holds, all else an error, which the values of ``cols`` carry too."""
    error = F.raise_error(F.concat(F.lit(message), _named(on)))
    df = df.withColumns({c: F.when(there, F.col(c)).otherwise(error) for c in cols})
    return df.where(F.when(there, True).otherwise(error.cast("boolean")))


def unique(df: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """``df`` with one row a key; a doubled key is an error."""
    rest = [c for c in df.columns if c not in on]
    one = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_in"), *rest)).alias("_row"))
    fine = F.when(F.col("_n") == 1, True).otherwise(F.raise_error(F.concat(F.lit(f"{what}: doubled key "), _named(on))).cast("boolean"))
    return one.where(fine).select(*on, *[F.col("_row")[c].alias(c) for c in rest])


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """Each row with its one row of ``table``; rows without one, and doubled keys of the table, are errors."""
    there = unique(table, on, what).withColumn("_there", F.lit(True))
    joined = df.join(there, list(on), "left")
    return _guarded(joined, on, [c for c in table.columns if c not in on], F.col("_there"), f"{what}: no row for ").drop("_there")


def strict_join(left: DataFrame, right: DataFrame, on: Sequence[str], what: str) -> DataFrame:
    """One to one; a key that only one side has, or that a side has twice, is an error."""
    a = unique(left, on, f"{what} (left)").withColumn("_left", F.lit(True))
    b = unique(right, on, f"{what} (right)").withColumn("_right", F.lit(True))
    joined = a.join(b, list(on), "full")
    both = F.coalesce("_left", F.lit(False)) & F.coalesce("_right", F.lit(False))
    cols = [c for c in (*left.columns, *right.columns) if c not in on]
    return _guarded(joined, on, cols, both, f"{what}: key on one side only ").drop("_left", "_right")


def strict_zip(what: str, **arrays: Column | str) -> Column:
    """J3 within a row: array of structs of arrays that must be equally long."""
    cols = {k: F.col(c) if isinstance(c, str) else c for k, c in arrays.items()}
    first, *rest = (F.size(c) for c in cols.values())
    equal = F.lit(True)
    for n in rest:
        equal = equal & (n == first)
    sizes = F.to_json(F.struct(*[F.size(c).alias(k) for k, c in cols.items()]))
    # the error is null in type, so it takes that of the lists
    return F.when(equal, F.arrays_zip(*[c.alias(k) for k, c in cols.items()])).otherwise(F.raise_error(F.concat(F.lit(f"{what}: lists of unequal length "), sizes)))
