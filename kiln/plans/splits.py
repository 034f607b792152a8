"""Shuffle / split / batch / mix queries on ``documents``, ``orders`` and ``part`` (D*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import split
from kiln.operators.ranking import group_places
from kiln.plans.registry import query
from kiln.sources.tables import table

RANK_SQL = "row_number() OVER (ORDER BY md5('{seed}:' || {id}), {id})"


def _docs(spark, sf_dir, *cols):
    return table(spark, sf_dir, "documents").select("doc_id", *cols)


@query(
    "shuffle_documents",
    "D1 W9",
    f"SELECT doc_id, {RANK_SQL.format(seed=0, id='doc_id')} AS global_rank FROM documents",
)
def shuffle_documents(spark, sf_dir):
    """Seeded full shuffle of all documents (distributed rank)."""
    return split.shuffle_rank(_docs(spark, sf_dir), 0, "doc_id")


@query(
    "head_split_documents",
    "D2 D3 D4",
    f"""
WITH r AS (SELECT doc_id, {RANK_SQL.format(seed=0, id='doc_id')} AS global_rank FROM documents),
n AS (SELECT least(1024, count(*) // 10) AS t, count(*) AS n FROM documents)
SELECT doc_id, global_rank, CASE WHEN t > 0 AND t < n AND global_rank <= t THEN 'test' ELSE 'train' END AS split
FROM r, n
""",
)
def head_split_documents(spark, sf_dir):
    """test = first min(1024, n // 10) rows after the shuffle."""
    ranked = split.shuffle_rank(_docs(spark, sf_dir), 0, "doc_id", keep_total=True)
    return split.head_split(ranked, split.relative_test_size(F.col("_group_rows")))


@query(
    "tail_split_orders",
    "D3 D4",
    f"""
WITH r AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('5:' || o_orderkey), o_orderkey) AS r,
                  count(*) OVER (PARTITION BY o_custkey) AS n FROM orders),
t AS (SELECT o_orderkey, {RANK_SQL.format(seed=5, id="o_orderkey")} AS g, count(*) OVER () AS n FROM orders)
SELECT r.o_orderkey, CASE WHEN 3 < r.n AND r.r <= 3 THEN 'test' ELSE 'train' END AS head_split,
       CASE WHEN g > t.n - least(1024, t.n // 10) THEN 'test' ELSE 'train' END AS tail_split
FROM r JOIN t ON r.o_orderkey = t.o_orderkey
""",
)
def tail_split_orders(spark, sf_dir):
    """D4 tail variant over all orders; D3 per customer: 3 test orders, none where a customer has no more than that."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    head = split.head_split(split.shuffle_rank(o, 5, "o_orderkey", group=["o_custkey"], keep_total=True), 3)
    ranked = split.shuffle_rank(o, 5, "o_orderkey", keep_total=True)
    tail = split.tail_split(ranked, split.relative_test_size(F.col("_group_rows")))
    return head.select("o_orderkey", F.col("split").alias("head_split")).join(tail.select("o_orderkey", F.col("split").alias("tail_split")), "o_orderkey")


@query(
    "test_cut_documents",
    "D6",
    """
SELECT doc_id, rank FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) AS rank FROM documents WHERE source IN (SELECT max(source) FROM documents))
WHERE rank <= 25
""",
)
def test_cut_documents(spark, sf_dir):
    """The named test split (one source) shuffled with seed 0, its first 25 rows taken (the cut is the feature)."""
    docs = _docs(spark, sf_dir, "source")
    test = docs.filter(F.col("source") == docs.agg(F.max("source")).scalar())
    return split.shuffle_rank(split.row_cap(test, 25, 0, "doc_id"), 0, "doc_id", "rank").select("doc_id", "rank")


@query(
    "ratio_split_documents",
    "D5",
    """
SELECT doc_id, CASE WHEN CAST(('0x' || substr(md5('7:' || doc_id), 1, 8)) AS BIGINT) / 4294967296.0 < 0.1
                    THEN 'test' ELSE 'train' END AS split
FROM documents
""",
)
def ratio_split_documents(spark, sf_dir):
    """Stable 90/10 hash split with seed 7."""
    return split.ratio_split(_docs(spark, sf_dir), 0.1, 7, "doc_id")


@query(
    "batches_documents",
    "D7 D8 D9",
    f"""
WITH r AS (SELECT doc_id, {RANK_SQL.format(seed=3, id='doc_id')} AS global_rank FROM documents),
n AS (SELECT count(*) AS n FROM documents),
b AS (
  SELECT 'drop_last' AS mode, CAST(floor((global_rank - 1) / 64) AS BIGINT) AS batch_idx, global_rank FROM r, n
  WHERE floor((global_rank - 1) / 64) < n.n // 64
  UNION ALL
  SELECT 'keep_last', CAST(floor((global_rank - 1) / 64) AS BIGINT), global_rank FROM r
  UNION ALL
  SELECT 'single', 0, global_rank FROM r)
SELECT mode, batch_idx, count(*) AS n_rows, min(global_rank) AS first_rank, max(global_rank) AS last_rank
FROM b GROUP BY mode, batch_idx
""",
)
def batches_documents(spark, sf_dir):
    """D7 drop-last / D8 keep-last batches of 64 and D9 single batch."""
    ranked = split.shuffle_rank(_docs(spark, sf_dir), 3, "doc_id", keep_total=True)
    parts = [
        split.assign_batches(ranked, 64, drop_last=True).withColumn("mode", F.lit("drop_last")),
        split.assign_batches(ranked, 64, drop_last=False).withColumn("mode", F.lit("keep_last")),
        split.single_batch(ranked.drop("_group_rows")).withColumn("mode", F.lit("single")),
    ]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("mode", "batch_idx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("global_rank").alias("first_rank"), F.max("global_rank").alias("last_rank")
    )


@query(
    "epoch_shuffle_documents",
    "D10 D11",
    """
WITH e AS (SELECT doc_id, epoch FROM documents, range(0, 3) t(epoch))
SELECT epoch, doc_id,
       row_number() OVER (PARTITION BY epoch ORDER BY md5(CAST(epoch AS VARCHAR) || ':' || doc_id), doc_id) AS global_rank
FROM e
""",
)
def epoch_shuffle_documents(spark, sf_dir):
    """Three epochs, reshuffled with seed = epoch (D11 repeats the rows)."""
    return split.epoch_shuffle(_docs(spark, sf_dir), 3, "doc_id").select("epoch", "doc_id", "global_rank")


@query(
    "per_source_sample",
    "D14 W8",
    """
SELECT source, doc_id, rank_in_group FROM (
  SELECT source, doc_id,
         row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS rank_in_group
  FROM documents) WHERE rank_in_group <= 7
""",
)
def per_source_sample(spark, sf_dir):
    """Up to 7 documents per source in seeded order (salted two-round top-k)."""
    s = split.per_group_sample(_docs(spark, sf_dir, "source"), "source", 7, 42, "doc_id")
    return s.select("source", "doc_id", "rank_in_group")


@query(
    "row_cap_documents",
    "D15",
    f"SELECT doc_id, global_rank FROM (SELECT doc_id, {RANK_SQL.format(seed=1, id='doc_id')} AS global_rank FROM documents) WHERE global_rank <= 100",
)
def row_cap_documents(spark, sf_dir):
    """Cap at the first 100 rows of the seed-1 order (the cap is the feature)."""
    return split.shuffle_rank(split.row_cap(_docs(spark, sf_dir), 100, 1, "doc_id"), 1, "doc_id")


@query(
    "composite_mix",
    "D16",
    """
WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) AS r FROM documents WHERE lang = 'en'),
b AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:' || doc_id), doc_id) AS r FROM documents WHERE lang <> 'en'),
nb AS (SELECT least((SELECT count(*) FROM a) // 16, (SELECT count(*) FROM b) // 8) AS m),
u AS (
  SELECT 0 AS dataset_idx, CAST(floor((r - 1) / 16) AS BIGINT) AS batch_idx, doc_id FROM a
  UNION ALL
  SELECT 1, CAST(floor((r - 1) / 8) AS BIGINT), doc_id FROM b)
SELECT CAST(dataset_idx AS BIGINT) AS dataset_idx, batch_idx, count(*) AS n_rows, CAST(sum(doc_id) AS BIGINT) AS id_sum
FROM u, nb WHERE batch_idx < nb.m GROUP BY dataset_idx, batch_idx
""",
)
def composite_mix(spark, sf_dir):
    """English docs in batches of 16 + other languages in batches of 8, min batch count."""
    docs = _docs(spark, sf_dir, "lang")
    en = split.shuffle_rank(docs.filter(F.col("lang") == "en"), 0, "doc_id")
    other = split.shuffle_rank(docs.filter(F.col("lang") != "en"), 0, "doc_id")
    mixed = split.composite_batches([en, other], [16, 8])
    return mixed.groupBy("dataset_idx", "batch_idx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("doc_id").cast("long").alias("id_sum")
    )


@query(
    "rollout_replication",
    "D17",
    """
SELECT p_partkey AS problem_id, CAST(s AS BIGINT) AS sample_idx
FROM part, LATERAL (SELECT unnest(range(0, CASE WHEN p_size % 5 = 0 THEN 1 ELSE 4 END)) AS s)
""",
)
def rollout_replication(spark, sf_dir):
    """Every problem → 4 rollouts (train) or 1 (test split: p_size % 5 = 0)."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("problem_id"), "p_size")
    g = F.when(F.col("p_size") % 5 == 0, F.lit(1)).otherwise(F.lit(4))
    return split.replicate(p, g).select("problem_id", "sample_idx")


@query(
    "even_split_orders",
    "D22",
    """
WITH o AS (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders)
SELECT o_custkey, o_orderkey,
       CAST(len(list_filter(range(1, least(3, n)), lambda j: floor(j * (n / least(3, n))) <= i)) AS BIGINT) AS chunk
FROM o
""",
)
def even_split_orders(spark, sf_dir):
    """Each customer's orders cut into min(3, n) near-equal chunks (linspace edges)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    o = group_places(o, "o_custkey", ["o_orderkey"], "i", "n")
    return o.select("o_custkey", "o_orderkey", split.even_chunk(F.col("i"), F.col("n"), F.least(F.lit(3), F.col("n"))).alias("chunk"))


@query(
    "minibatch_geometry",
    "D24",
    f"""
WITH r AS (SELECT p_partkey, {RANK_SQL.format(seed=0, id='p_partkey')} AS global_rank FROM part),
b AS (SELECT p_partkey, CAST(floor((global_rank - 1) / 32) AS BIGINT) AS batch_idx,
             CAST(((global_rank - 1) % 32) + 1 AS BIGINT) AS pos FROM r)
SELECT p_partkey, batch_idx, CAST(floor((pos - 1) / 16) AS BIGINT) AS substep,
       CAST(floor(((pos - 1) % 16) / 4) AS BIGINT) AS minibatch
FROM b
""",
)
def minibatch_geometry(spark, sf_dir):
    """32 groups per batch → 2 substeps → 4 minibatches each."""
    ranked = split.shuffle_rank(table(spark, sf_dir, "part").select("p_partkey"), 0, "p_partkey")
    b = split.assign_batches(ranked, 32, drop_last=False)
    pos = F.pmod(F.col("global_rank") - 1, F.lit(32)) + 1
    sub, mini = split.minibatch_geometry(pos, 32, 2, 4)
    return b.select("p_partkey", "batch_idx", sub.alias("substep"), mini.alias("minibatch"))


@query(
    "arithmetic_problems",
    "D27 G15",
    """
WITH h AS (
  SELECT p_partkey AS problem_id, CAST(floor(p_partkey / 64) AS BIGINT) AS batch_idx,
         md5('0:' || CAST(floor(p_partkey / 64) AS BIGINT) || ':' || p_partkey) AS h FROM part),
xy AS (
  SELECT problem_id, batch_idx,
         CAST(('0x' || substr(h, 1, 8)) AS BIGINT) % 101 AS x,
         CAST(('0x' || substr(h, 9, 8)) AS BIGINT) % 101 AS y FROM h)
SELECT problem_id, batch_idx, x, y,
       CAST((x + y) || ' is the sum' AS VARCHAR) AS response,
       TRY_CAST(string_split(trim(CAST((x + y) || ' is the sum' AS VARCHAR)), ' ')[1] AS BIGINT) = x + y AS correct
FROM xy
""",
)
def arithmetic_problems(spark, sf_dir):
    """D27 + G15: seeded x + y problems indexed by part key, graded on a derived answer."""
    from kiln.functions import graders

    p = split.arithmetic_problems(table(spark, sf_dir, "part"), "p_partkey", 64)
    resp = F.concat((F.col("x") + F.col("y")).cast("string"), F.lit(" is the sum"))
    return p.withColumn("response", resp).withColumn("correct", graders.sum_check(F.col("response"), F.col("x"), F.col("y")))


@query(
    "representatives",
    "D29",
    """
WITH o AS (
  SELECT o_custkey, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) - 1 AS pos,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, CAST(pos AS BIGINT) AS pos FROM o
WHERE n <= 3 OR pos = 0 OR pos = n - 1 OR pos = floor(1 * ((n - 1) / 2.0))
""",
)
def representatives(spark, sf_dir):
    """3 evenly spaced orders by total price per customer (all of customers with fewer)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    r = split.representatives(o, "o_custkey", "o_totalprice", "o_orderkey", 3)
    return r.select("o_custkey", "o_orderkey", F.col("_pos").alias("pos"))
