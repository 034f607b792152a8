"""Exact nearest-neighbour retrieval and search-tool result assembly.

Queries and documents are both tables of blocks: a row holds some vectors as one matrix, within a bound of bytes.
Documents are dealt to shards, every query block goes to every shard, and blocks meet in a join on the shard: no
vector passes the driver, and no row of a single query and document is ever made. A pair of blocks is one matrix
product; a task keeps the k best documents of a query block while its document blocks pass, and a skew-safe
top-k merges the candidates of the shards (k a query and shard).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators.joins import lookup
from kiln.operators.ranking import top_k_per_group
from kiln.session import shuffle_partitions

BLOCK_BYTES = 1 << 20  # vectors of one block
BATCH_BYTES = 32 << 20  # block pairs of one Arrow batch

# ---- fixed values: search tool messages ----
ERR_REQUIRED = "Error invoking search tool: query_list is required"
ERR_NON_EMPTY = "Error invoking search tool: query_list must be a list of non-empty strings"
# ---- end of fixed values ----


def _blocks(df: DataFrame, id_col: str, vec_col: str, size: int, prefix: str) -> DataFrame:
    """Rows (shard, prefix_ids, prefix_dim, prefix_mat) of at most ``size`` bytes of doubles, vectors of one length each."""
    kind = df.schema[id_col].dataType
    shape = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField(f"{prefix}_ids", T.ArrayType(kind)), T.StructField(f"{prefix}_dim", T.IntegerType()),
        T.StructField(f"{prefix}_mat", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}

        def row(key: tuple[int, int]) -> pa.RecordBatch:
            ids, vecs = held.pop(key)
            cols = [pa.array([key[0]], pa.int32()), pa.array([ids], pa.list_(id_kind)), pa.array([key[1]], pa.int32()), pa.array([b"".join(vecs)], pa.binary())]
            return pa.RecordBatch.from_arrays(cols, shape.names)

        for b in batches:
            id_kind = b.schema.field(0).type
            for shard, i, v in zip(b.column(2).to_pylist(), b.column(0).to_pylist(), b.column(1), strict=True):
                vec = v.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
                key = (shard, len(vec))
                ids, vecs = held.setdefault(key, ([], []))
                ids.append(i)
                vecs.append(vec.tobytes())
                if len(ids) * len(vec) * 8 >= size:
                    yield row(key)
        for key in list(held):
            yield row(key)

    return df.where(F.col(vec_col).isNotNull()).select(id_col, vec_col, "shard").mapInArrow(cut, shape)


def _best(k: int, id_kind: T.DataType, q_kind: T.DataType):
    """Candidates of a partition of block pairs: the k best documents of a query block over its run of document blocks."""
    shape = T.StructType([T.StructField("query_id", q_kind), T.StructField("doc_id", id_kind), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, ids, scores = None, None, None

        def flush() -> pa.RecordBatch:
            n = ids.shape[1]
            cols = [queries.take(pa.array(np.repeat(np.arange(len(queries)), n))), pa.array(ids.ravel()), pa.array(scores.ravel())]
            return pa.RecordBatch.from_arrays(cols, shape.names)

        for b in batches:
            for r in range(b.num_rows):
                at = lambda c: b.column(c)[r]  # noqa: B023, E731
                q, dim = at("q_ids").values, at("q_dim").as_py()
                doc_ids = at("d_ids").values.to_numpy(zero_copy_only=False)
                mats = [np.frombuffer(at(c).as_py()).reshape(-1, dim) for c in ("q_mat", "d_mat")]
                found = mats[0] @ mats[1].T
                if queries is not None and not q.equals(queries):
                    yield flush()
                    queries = None
                new = np.broadcast_to(doc_ids, found.shape)
                ids, scores = (new, found) if queries is None else (np.hstack([ids, new]), np.hstack([scores, found]))
                queries = q
                order = np.lexsort((ids, -scores), axis=1)[:, :k]  # score falling, then id
                ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        if queries is not None:
            yield flush()

    return run, shape


def nearest_neighbours(queries: DataFrame, docs: DataFrame, k: int = 3, qid: str = "query_id", qvec: str = "embedding",
                       id_col: str = "vec_id", vec_col: str = "embedding", block_bytes: int = BLOCK_BYTES, shards: int | None = None) -> DataFrame:
    """V1: exact top-k documents by dot product for every query (ties by id): (query_id, rank, id, score).

    Null vectors and vectors of other lengths than the query's are never found; query ids are unique."""
    spark = docs.sparkSession
    shards = shards or shuffle_partitions(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    d = docs.withColumn("shard", F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int")).repartition(shards, "shard")
    d = _blocks(d, id_col, vec_col, block_bytes, "d")
    q = queries.withColumn("shard", F.lit(0))
    q = _blocks(q, qid, qvec, block_bytes, "q").drop("shard")
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    pairs = q.join(d, "shard").where(F.col("q_dim") == F.col("d_dim")).select("q_ids", "q_dim", "q_mat", "d_ids", "d_mat")
    run, shape = _best(k, docs.schema[id_col].dataType, queries.schema[qid].dataType)
    found = pairs.mapInArrow(run, shape)
    top = top_k_per_group(found, ["query_id"], [F.col("score").desc(), F.col("doc_id")], k, rank_col="rank")
    return top.select("query_id", "rank", F.col("doc_id").alias(id_col), "score")


def validate_query_list(name, query_list):
    """V2: (is_valid, error message) for a search tool call.

    ``query_list`` is ``array<string>`` (null = missing argument).
    """
    bad = (F.size(query_list) == 0) | F.exists(query_list, lambda x: x.isNull() | ~x.rlike(r"\S"))
    err = (
        F.when(name != "search", F.lit("Invalid tool name"))
        .when(query_list.isNull(), F.lit(ERR_REQUIRED))
        .when(bad, F.lit(ERR_NON_EMPTY))
    )
    return err.isNull(), err


def embedding_inputs_ok(texts):
    """V4: non-empty list of non-blank strings."""
    return (F.size(texts) > 0) & F.forall(texts, lambda t: t.isNotNull() & t.rlike(r"\S"))


def search_calls(calls: DataFrame, vectors: DataFrame, docs: DataFrame, k: int = 3, id_col: str = "vec_id") -> DataFrame:
    """V2–V4: one message a call: (call_id, valid, content).

    ``calls`` (call_id, name, query_list), ``vectors`` (text, embedding) of the embedding service, ``docs`` (id, embedding, doc).
    Every query of a valid call is answered, in the order of its list: ``Query: q``, then ``Document i:`` blocks by rank;
    an invalid call gets its error. A query that the service gave no vector, or two, is an error.
    """
    ok, err = validate_query_list(F.col("name"), F.col("query_list"))
    checked = calls.select("call_id", "query_list", ok.alias("valid"), err.alias("error"))
    asked = checked.where("valid").select("call_id", F.posexplode("query_list").alias("pos", "text"))
    asked = asked.where(embedding_inputs_ok(F.array("text")))
    texts = lookup(asked.select("text").distinct(), vectors, ["text"], "query vectors")
    hits = nearest_neighbours(texts, docs, k, qid="text", id_col=id_col).join(docs.select(id_col, "doc"), id_col)
    found = hits.groupBy(F.col("query_id").alias("text")).agg(F.array_sort(F.collect_list(F.struct("rank", "doc"))).alias("_d"))
    block = F.transform("_d", lambda x: F.concat(F.lit("Document "), x["rank"].cast("string"), F.lit(":\n"), x["doc"], F.lit("\n")))
    found = found.select("text", F.concat(F.lit("Query: "), "text", F.lit("\n"), F.array_join(block, "")).alias("_part"))
    told = asked.join(found, "text").groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("pos", "_part"))).alias("_p"))
    told = told.select("call_id", F.array_join(F.transform("_p", lambda x: x["_part"]), "").alias("_content"))
    return checked.join(told, "call_id", "left").select("call_id", "valid", F.coalesce("error", "_content").alias("content"))
