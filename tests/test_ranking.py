"""Places in groups against a plain sort, with a hot group, ties, null groups and an empty table."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kiln.operators.ranking import group_places, range_slices
from kiln.operators.split import representatives

ROWS = [(7 if i % 3 == 0 else None if i % 50 == 1 else i % 11 + 20, i * 37 % 13, i) for i in range(1200)]


def places(rows):
    groups = defaultdict(list)
    for g, s, i in rows:
        groups[g].append((s, i))
    return {(g, i): (pos, len(m)) for g, m in groups.items() for pos, (_, i) in enumerate(sorted(m))}


@pytest.mark.parametrize("parts", ["1", "8"])
def test_group_places(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(ROWS, "g int, s int, id int").repartition(5)
        got = {(r.g, r.id): (r._pos, r._n) for r in group_places(df, "g", ["s", "id"]).collect()}
        assert got == places(ROWS)
        assert group_places(df.limit(0), "g", ["s", "id"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_hot_group_is_cut(spark):
    df = spark.createDataFrame(ROWS, "g int, s int, id int")
    slices = range_slices(df.where("g = 7"), ["g", "s", "id"], "slice").groupBy("slice").count().collect()
    assert len(slices) > 2 and max(r["count"] for r in slices) < 400 / 2


@pytest.mark.parametrize("k", [1, 2, 5])
def test_representatives_of_hot_and_small_groups(spark, k):
    df = spark.createDataFrame(ROWS + [(99, 1, 5000), (99, 0, 5001)], "g int, s int, id int")
    got = sorted((r.g or -1, r.id) for r in representatives(df, "g", "s", "id", k).select(F.col("g"), "id").collect())
    want = []
    for (g, i), (pos, n) in places(ROWS + [(99, 1, 5000), (99, 0, 5001)]).items():
        targets = {0} if k == 1 else {n - 1 if j == k - 1 else int(j * ((n - 1) / (k - 1))) for j in range(k)}
        if n <= k or pos in targets:
            want.append((g or -1, i))
    assert got == sorted(want)
