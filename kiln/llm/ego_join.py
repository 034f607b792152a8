"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label are compared by cosine. On unit vectors a cosine of at least t is a distance of at most
eps = sqrt(2 - 2t), and a projection on orthonormal directions never lengthens a distance. The leading
principal directions (of a bounded sample; any directions give the same result) span a grid of cells eps
wide. Vectors are sorted by label and cells, and cut into blocks of consecutive vectors with their bounding
boxes. Blocks whose boxes are more than eps apart are never paired; a pair of blocks is joined recursively
in halves, again skipping halves that are provably distant, down to small intervals that are multiplied out
in double precision.

Equal vectors of a label are one weighted node from the start, so a group of exact copies costs nothing. A task
holds one pair of blocks. Links are counted per vector in the task and leave it as sums and spanning edges,
never as pairs.

Cases: rows with a null label, a null, empty or zero vector, or null or non-finite components link with
nothing (0 links, component: themselves); vectors of different lengths don't link; rows repeated as a whole are
one vector and all get its result; rows sharing only the vec_id are separate vectors; null vec_ids take part,
a component's id is its smallest non-null vec_id; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import components, local_components

DIMS = 6
BLOCK = 512
LEAF = 128
SAMPLE = 4096


def unit(v: list | None) -> np.ndarray | None:
    """The unit vector in double precision, None for vectors that link with nothing."""
    if not v or any(x is None for x in v):
        return None
    a = np.array(v, np.float64)
    if not np.isfinite(a).all():
        return None
    top = np.abs(a).max()
    if top == 0:
        return None
    a = a / top
    return a / math.sqrt(float(a @ a))


def principal_directions(nodes: DataFrame, dims: int, sample: int) -> dict[int, np.ndarray]:
    """Leading directions for each vector length, from at most ``sample`` vectors; for lengths that the sample
    doesn't have the first coordinates serve."""
    rows = nodes.select("node", "embedding").orderBy(F.xxhash64("node"), "node").limit(sample).collect()
    by: dict[int, list] = {}
    for r in rows:
        u = unit(r.embedding)
        if u is not None:
            by.setdefault(len(u), []).append(u)
    out = {}
    for n, us in by.items():
        a = np.array(us)
        _, v = np.linalg.eigh(np.cov(a.T).reshape(n, n)) if len(us) > 1 else (None, np.eye(n)[:, ::-1])
        out[n] = v[:, ::-1][:, :dims]
    return out


def _project(directions: dict[int, np.ndarray], dims: int, eps: float):
    shape = pa.schema([("label", pa.int64()), ("size", pa.int32()), ("cell", pa.list_(pa.int32())), ("at", pa.list_(pa.float64())), ("node", pa.int64()), ("w", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                u = unit(r["embedding"])
                if u is None:
                    continue
                d = directions.get(len(u))
                at = u[:dims] if d is None else u @ d
                at = np.append(at, np.zeros(dims - len(at)))
                cell = np.floor(at / eps).astype(int).tolist()
                rows.append({"label": r["label"], "size": len(u), "cell": cell, "at": at.tolist(), "node": r["node"], "w": r["w"], "vec": u.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=shape)

    return run, "label long, size int, cell array<int>, at array<double>, node long, w long, vec binary"


_BLOCK = pa.schema([("block", pa.string()), ("label", pa.int64()), ("size", pa.int32()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())), ("nodes", pa.binary()), ("ws", pa.binary()), ("ats", pa.binary()), ("vecs", pa.binary())])


def _blocks(block: int):
    """Cuts a sorted partition into blocks of at most ``block`` consecutive vectors of one label and length."""

    def pack(rows: list[dict]) -> dict:
        at = np.array([r["at"] for r in rows])
        first = rows[0]
        return {
            "block": f"{first['node']}:{len(rows)}", "label": first["label"], "size": first["size"],
            "low": at.min(0).tolist(), "high": at.max(0).tolist(),
            "nodes": np.array([r["node"] for r in rows], np.int64).tobytes(), "ws": np.array([r["w"] for r in rows], np.int64).tobytes(),
            "ats": at.tobytes(), "vecs": b"".join(r["vec"] for r in rows),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            out = []
            for r in b.to_pylist():
                if held and (len(held) == block or (held[0]["label"], held[0]["size"]) != (r["label"], r["size"])):
                    out.append(pack(held))
                    held = []
                held.append(r)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_BLOCK)
        if held:
            yield pa.RecordBatch.from_pylist([pack(held)], schema=_BLOCK)

    return run, "block string, label long, size int, low array<double>, high array<double>, nodes binary, ws binary, ats binary, vecs binary"


class Interval:
    """Consecutive vectors of a block, with their bounding box."""

    def __init__(self, vecs: np.ndarray, ats: np.ndarray, start: int = 0):
        self.vecs, self.ats, self.start = vecs, ats, start
        self.low, self.high = ats.min(0), ats.max(0)

    def halves(self) -> list[Interval]:
        m = len(self.vecs) // 2
        return [Interval(self.vecs[:m], self.ats[:m], self.start), Interval(self.vecs[m:], self.ats[m:], self.start + m)]

    def apart(self, other: Interval) -> float:
        gap = np.maximum(0, np.maximum(self.low - other.high, other.low - self.high))
        return math.sqrt(float(gap @ gap))


def join_intervals(a: Interval, b: Interval, cosine: float, eps: float, out: list[tuple[np.ndarray, np.ndarray]], same: bool) -> None:
    """Appends index arrays (i, j) of the links between two intervals; ``same``: of one interval with itself."""
    if a.apart(b) > eps * (1 + 1e-9):
        return
    if max(len(a.vecs), len(b.vecs)) <= LEAF:
        i, j = np.nonzero(a.vecs @ b.vecs.T >= cosine)
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        if len(i):
            out.append((i + a.start, j + b.start))
        return
    if same:
        x, y = a.halves()
        join_intervals(x, x, cosine, eps, out, True)
        join_intervals(y, y, cosine, eps, out, True)
        join_intervals(x, y, cosine, eps, out, False)
        return
    for x in a.halves() if len(a.vecs) > LEAF else [a]:
        for y in b.halves() if len(b.vecs) > LEAF else [b]:
            join_intervals(x, y, cosine, eps, out, False)


def _join(cosine: float, eps: float):
    shape = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = {c: b.column(c)[k].as_py() for c in b.schema.names}
                side = []
                for p in ("a_", "b_"):
                    node, w = np.frombuffer(r[p + "nodes"], np.int64), np.frombuffer(r[p + "ws"], np.int64)
                    ats = np.frombuffer(r[p + "ats"]).reshape(len(node), -1)
                    side.append((node, w, Interval(np.frombuffer(r[p + "vecs"]).reshape(len(node), -1), ats)))
                (na, wa, ia), (nb, wb, ib) = side
                same = r["a_block"] == r["b_block"]
                found: list[tuple[np.ndarray, np.ndarray]] = []
                join_intervals(ia, ia if same else ib, cosine, eps, found, same)
                if not found:
                    continue
                i, j = (np.concatenate(x) for x in zip(*found, strict=True))
                links_a = np.bincount(i, weights=wb[j], minlength=len(na)).astype(np.int64)
                links_b = np.bincount(j, weights=wa[i], minlength=len(nb)).astype(np.int64)
                shift = 0 if same else len(na)
                nodes = na if same else np.concatenate([na, nb])
                root = local_components(i, j + shift, len(nodes))
                links = links_a + links_b if same else np.concatenate([links_a, links_b])
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(nodes[hit]), pa.array(nodes[root[hit]]), pa.array(links[hit])], schema=shape)

    return run, "u long, v long, links long"


def near_duplicates(
    vectors: DataFrame, cosine: float, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    dims: int = DIMS, block: int = BLOCK, sample: int = SAMPLE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row: links of cosine at least ``cosine`` within a label."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("embedding"))
    rows = rows.withColumn("key", F.xxhash64("vec_id", "label", "embedding")).withColumn("node", F.xxhash64("label", "embedding"))
    # a hash skips nulls within an array: only valid vectors are hashed to nodes
    number = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < math.inf)
    fine = F.col("label").isNotNull() & F.forall("embedding", number) & F.exists("embedding", lambda c: c != 0)
    rows = rows.withColumn("node", F.when(fine, F.col("node")))
    alive = rows.where("node is not null").dropDuplicates(["key"])
    nodes = alive.groupBy("node").agg(
        F.count("*").alias("w"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    nodes = nodes.checkpoint()
    directions = principal_directions(nodes, dims, sample)
    run, kind = _project(directions, dims, eps)
    placed = nodes.select("label", "embedding", "node", "w").mapInArrow(run, kind)
    run, kind = _blocks(block)
    # the borders of a range sort come from a sample of the rows: frozen by a reliable checkpoint
    cut = placed.orderBy("label", "size", "cell", "node").mapInArrow(run, kind).checkpoint()
    box = cut.select("block", "label", "size", "low", "high")
    cell = lambda c: F.floor(F.col(c)[0] / max(eps, 1e-9))
    left = box.withColumn("c", F.explode(F.sequence(cell("low"), cell("high"))))
    right = box.withColumn("c", F.explode(F.sequence(cell("low") - 1, cell("high") + 1)))
    named = lambda d, p: d.select("label", "size", "c", *[F.col(c).alias(p + c) for c in ("block", "low", "high")])
    gap = F.aggregate(
        F.zip_with(
            F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y),
            lambda x, y: F.greatest(x, y, F.lit(0.0)),
        ), F.lit(0.0), lambda s, g: s + g * g)
    pairs = named(left, "a_").join(named(right, "b_"), ["label", "size", "c"]).where("a_block <= b_block")
    pairs = pairs.where(gap <= eps * eps * (1 + 1e-9)).select("a_block", "b_block").distinct()
    load = lambda p: cut.select(*[F.col(c).alias(p + c) for c in ("block", "nodes", "ws", "ats", "vecs")])
    joined = pairs.join(load("a_"), "a_block").join(load("b_"), "b_block")
    run, kind = _join(cosine, eps)
    found = joined.mapInArrow(run, kind).checkpoint()
    links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.select("u", "v")).withColumnRenamed("component", "class")
    marked = nodes.select("node", "w", "least").join(links, "node", "left").join(groups, "node", "left").withColumn("class", F.coalesce("class", "node"))
    ids = marked.groupBy("class").agg(F.min("least").alias("component_id"))
    marked = marked.join(ids, "class").select("node", (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "node").join(marked, "node", "left")
    own = F.coalesce("component_id", F.col("vec_id").cast("long"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"),
    )
