"""Retrieval queries on ``embeddings`` (V1–V4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import retrieve
from kiln.plans.registry import query
from kiln.sources.tables import table

NN_SQL = """
q AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT query_id, e.vec_id, list_dot_product(CAST(qe AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score
      FROM q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
"""


def _hits(spark, sf_dir, k=3):
    e = table(spark, sf_dir, "embeddings")
    return retrieve.nearest_neighbours(e.filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), "embedding"), e, k)


@query("nearest_neighbours", "V1 J9", f"""
WITH {NN_SQL}
SELECT query_id, CAST(rank AS BIGINT) AS rank, vec_id, round(score, 6) AS score FROM r WHERE rank <= 3
""")
def nearest_neighbours(spark, sf_dir):
    """V1: exact top-3 by dot product; queries are the rows whose id is divisible by 50."""
    return _hits(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("search_results", "V2 V3 V4 J4 J9", """
WITH c AS (
  SELECT vec_id AS call_id, CASE WHEN vec_id % 350 = 200 THEN 'lookup' ELSE 'search' END AS name,
         CASE vec_id % 250 WHEN 0 THEN ['v' || vec_id, 'v' || (vec_id + 1), 'v' || (vec_id + 2)] WHEN 50 THEN ['v' || vec_id] WHEN 100 THEN ['v' || vec_id, ' ']
           WHEN 150 THEN NULL ELSE ['v' || (vec_id + 1), 'v' || vec_id] END AS query_list
  FROM embeddings WHERE vec_id % 50 = 0),
e AS (SELECT *, CASE WHEN name <> 'search' THEN 'Invalid tool name' WHEN query_list IS NULL THEN 'Error invoking search tool: query_list is required'
                     WHEN list_contains(query_list, ' ') THEN 'Error invoking search tool: query_list must be a list of non-empty strings' END AS error FROM c),
a AS (SELECT call_id, unnest(query_list) AS text, unnest(range(len(query_list))) AS pos FROM e WHERE error IS NULL),
t AS (SELECT DISTINCT text FROM a),
s AS (SELECT text, d.vec_id, 'vec ' || d.vec_id || ' label ' || d.label AS doc, list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])) AS score
      FROM t JOIN embeddings q ON text = 'v' || q.vec_id, embeddings d),
h AS (SELECT text, doc, row_number() OVER (PARTITION BY text ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 3),
p AS (SELECT text, 'Query: ' || text || chr(10) || string_agg('Document ' || rank || ':' || chr(10) || doc || chr(10), '' ORDER BY rank) AS part FROM h GROUP BY text),
m AS (SELECT call_id, string_agg(part, '' ORDER BY pos) AS content FROM a JOIN p USING (text) GROUP BY call_id)
SELECT call_id, error IS NULL AS valid, md5(coalesce(error, content)) AS content_md5 FROM e LEFT JOIN m USING (call_id)
""")
def search_results(spark, sf_dir):
    """V2–V4: tool calls of one to three queries, or invalid ones → top-3 documents of every query → one message a call."""
    e = table(spark, sf_dir, "embeddings")
    text = lambda k: F.concat(F.lit("v"), (F.col("vec_id") + k).cast("string"))
    kind = F.col("vec_id") % 250
    asked = (
        F.when(kind == 0, F.array(text(0), text(1), text(2))).when(kind == 50, F.array(text(0))).when(kind == 100, F.array(text(0), F.lit(" ")))
        .when(kind == 150, F.lit(None).cast("array<string>")).otherwise(F.array(text(1), text(0)))
    )
    calls = e.filter(F.col("vec_id") % 50 == 0).select(
        F.col("vec_id").alias("call_id"), F.when(F.col("vec_id") % 350 == 200, "lookup").otherwise("search").alias("name"), asked.alias("query_list"))
    doc = F.concat(F.lit("vec "), F.col("vec_id").cast("string"), F.lit(" label "), F.col("label").cast("string")).alias("doc")
    res = retrieve.search_calls(calls, e.select(text(0).alias("text"), "embedding"), e.select("vec_id", "embedding", doc))
    return res.select("call_id", "valid", F.md5("content").alias("content_md5"))
