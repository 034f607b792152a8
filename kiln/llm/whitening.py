"""Embedding whitening through a bidiagonal qd solver.

Components become whole numbers x = floor(256 c). The fit list holds each different x vector once; counts and
sums over it are exact. Its centred rows are reduced to one triangle R by blockwise QR: every task folds its
rows into a triangle batch by batch, and the triangles are folded in a tree of bounded fan. The driver, which
holds only d by d numbers, bidiagonalises R by Householder reflections, finds the squared singular values by
dqds (differential quotient-difference steps with shifts, accurate for small values, too) and recovers each
direction from the twisted factorisation of the bidiagonal's qd form at its value. One more pass projects
every row.

Cases: rows with a null vector, or null or non-finite components, are dropped; empty vectors give no
rows; each vector length has a model of its own (n, sums and directions of that length); repeated rows and rows that
share a vec_id each get their own result rows; components beyond 2^31 count as that. Where a direction has no
variance (constant vectors, fewer different vectors than components) ``whitened`` is null and the direction does
not count in ``identity_error``; where no direction has any, ``explained`` is null and ``identity_error`` 0. ``deviation`` is null where it does not
fit a long (from some 10^7 different vectors on). An empty table gives an empty result. Columns besides vec_id and embedding are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import stored
from kiln.llm.vectors import quantised, unpack

EPS = np.finfo(np.float64).eps
#: Triangles that one task of the reduction tree folds, and the driver reads in the end.
FAN = 32
#: Neighbouring values closer than this (relative) are one cluster, whose directions are made orthogonal.
CLUSTER = 1e-6


# ---- the solver: d by d numbers -------------------------------------------------------------------------------------
def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and value a such that (I - 2 v v') x = a e1."""
    norm = float(np.linalg.norm(x))
    if norm == 0:
        return np.zeros_like(x), 0.0
    v = x.copy()
    a = -np.copysign(norm, x[0])
    v[0] -= a
    return v / np.linalg.norm(v), float(a)


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor W of a square matrix: r = U B W'."""
    m = np.array(r, np.float64)
    n = len(m)
    w = np.eye(n)
    for j in range(n):
        v, _ = _reflector(m[j:, j])
        m[j:, j:] -= 2 * np.outer(v, v @ m[j:, j:])
        if j < n - 1:
            v, _ = _reflector(m[j, j + 1 :])
            m[j:, j + 1 :] -= 2 * np.outer(m[j:, j + 1 :] @ v, v)
            w[:, j + 1 :] -= 2 * np.outer(w[:, j + 1 :] @ v, v)
    return m.diagonal().copy(), m.diagonal(1).copy(), w


def _step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, or None if the shift was beyond the smallest value. Also the smallest d seen."""
    d = q[0] - shift
    least, qq, ee = d, [], []
    for j in range(len(e)):
        if d < 0:
            return None
        top = d + e[j]
        if top <= 0:
            return None
        t = q[j + 1] / top
        qq.append(top)
        ee.append(e[j] * t)
        d = d * t - shift
        least = min(least, d)
    if d < 0 or d != d:
        return None
    return [*qq, d], ee, least


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix with diagonal a (nowhere zero) and superdiagonal b."""
    out: list[float] = []
    work = [((a * a).tolist(), (b * b).tolist(), 0.0)]
    tiny = (EPS / 4) ** 2
    while work:
        q, e, base = work.pop()
        least = 0.0
        while q:
            if len(q) == 1:
                out.append(q[0] + base)
                break
            if e[-1] <= tiny * (base + q[-1]):
                out.append(q.pop() + base)
                e.pop()
                continue
            cut = next((i for i in range(len(e) - 1) if e[i] <= tiny * max(base, min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], base))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            # the smaller value of the last two rows, no more than the bound of the last transform
            x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (x - y) / 2
            low = y - z / (abs(half) + np.sqrt(half * half + z)) if half >= 0 else (x * y - z) / ((x + y) / 2 + np.sqrt(half * half + z))
            shift = max(0.0, min(low, least)) * (1 - 1e-9)
            for s in (shift, shift / 4, 0.0):
                done = _step(q, e, float(s))
                if done:
                    q, e, least = done
                    base += float(s)
                    break
            else:  # a value of zero within rounding
                q[-1], e[-1] = max(q[-1], 0.0), 0.0
    return np.sort(np.array(out))[::-1]


class _Twisted(NamedTuple):
    lower: np.ndarray  # of the factorisation from the top
    pivots: np.ndarray
    upper: np.ndarray  # of the one from the bottom
    gamma: np.ndarray  # for each place where the two may meet


def _factor(d: np.ndarray, low: np.ndarray, value: float) -> _Twisted:
    """Both factorisations of L D L' - value I, by the differential stationary and progressive qd transforms."""
    n = len(d)
    tiny = EPS * EPS * max(value, float(d.max()))
    lower, upper, pivots = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivots[i] = d[i] + s[i] or tiny
        lower[i] = d[i] * low[i] / pivots[i]
        s[i + 1] = lower[i] * low[i] * s[i] - value
    pivots[-1] = d[-1] + s[-1] or tiny
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        if not low[i]:
            p[i] = d[i] - value
            continue
        pivot = d[i] * low[i] * low[i] + p[i + 1] or tiny
        t = d[i] / pivot
        upper[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    return _Twisted(lower, pivots, upper, s + p + value)


def _twisted(f: _Twisted, r: int) -> np.ndarray:
    z = np.zeros(len(f.gamma))
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -f.lower[i] * z[i + 1]
    for i in range(r, len(z) - 1):
        z[i + 1] = -f.upper[i] * z[i]
    return z / np.linalg.norm(z)


def _solve(f: _Twisted, b: np.ndarray) -> np.ndarray:
    y = b.copy()
    for i in range(len(y) - 1):
        y[i + 1] -= f.lower[i] * y[i]
    y /= f.pivots
    for i in range(len(y) - 2, -1, -1):
        y[i] -= f.lower[i] * y[i + 1]
    return y / np.linalg.norm(y)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            z = z - (o @ z) * o
    return z


def leading_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of r'r, falling, and unit eigenvectors as columns."""
    n = r.shape[1]
    square = np.zeros((n, n))
    square[: len(r)] = r
    scale = float(np.abs(square).max()) or 1.0
    a, b, w = bidiagonalise(square / scale)
    # a singular R: a diagonal entry of zero counts as one far below the rounding of the largest
    floor = EPS * EPS * max(float(np.abs(a).max()), float(np.abs(b).max(initial=0.0)), EPS)
    a = np.where(np.abs(a) < floor, floor, a)
    values = dqds(a, b)
    d, low = a * a, b / a[:-1]
    found: list[np.ndarray] = []
    group: list[np.ndarray] = []
    for i in range(min(k, n)):
        if n == 1:
            found.append(np.ones(1))
            continue
        f = _factor(d, low, float(values[i]))
        order = np.argsort(np.abs(f.gamma), kind="stable")
        z = _twisted(f, int(order[0]))
        if i and values[i - 1] - values[i] < CLUSTER * values[i - 1]:
            group.append(found[-1])
            starts = [z, *np.eye(n)[order]]
            z = next(y / np.linalg.norm(y) for y in (_apart(s, group) for s in starts) if np.linalg.norm(y) > 0.5 / np.sqrt(n))
            for _ in range(3):
                z = _apart(_solve(f, z), group)
                z /= np.linalg.norm(z)
        else:
            group = []
        found.append(z)
    return values[: len(found)] * scale * scale, w @ np.array(found).T.reshape(n, -1)


# ---- the passes over the rows ---------------------------------------------------------------------------------------
class Model(NamedTuple):
    n: int
    sums: list[int]  # exact
    values: np.ndarray  # eigenvalues of the covariance, falling
    directions: np.ndarray  # columns
    trace: float
    identity_error: float

    def scaled(self) -> np.ndarray:
        """Directions over the roots of their values; NaN where there is no variance."""
        bad = self.values <= max(len(self.sums) * 8 * EPS * self.trace, 1e-30)  # whole numbers: a variance is no smaller
        return self.directions / np.sqrt(np.where(bad, np.nan, self.values))


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact sums for each length, from partial sums of the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in unpack(b.column("d").to_numpy(), b.column("x")):
                one = np.concatenate([[len(x)], x.sum(0)])
                held[d] = held[d] + one if d in held else one
        for d, s in held.items():
            k = len(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, d, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(s)], ["d", "at", "s"])

    parts = fit.mapInArrow(run, "d int, at int, s long").groupBy("d", "at").agg(F.sum("s").alias("s"))
    out: dict[int, dict[int, int]] = {}
    for r in parts.collect():  # one number for each component
        out.setdefault(r.d, {})[r["at"]] = r.s
    return {d: (s[0], [s[i] for i in range(1, d + 1)]) for d, s in out.items()}


def _fold(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


_TRIANGLE = "d int, slot int, r binary"


def _triangles(fit: DataFrame, means: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """R of the centred rows for each length: one triangle a task, folded in a tree of fan FAN."""

    def row(d: int, slot: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([slot], pa.int32()), pa.array([r.tobytes()], pa.binary())], ["d", "slot", "r"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in unpack(b.column("d").to_numpy(), b.column("x")):
                if d:
                    held[d] = _fold(held.get(d), x - means[d])
        for d, r in held.items():
            yield row(d, TaskContext.get().partitionId(), r)

    def merge(t: pa.Table) -> pa.Table:
        r, d = None, t.column("d")[0].as_py()
        for x in t.sort_by("slot").column("r").to_pylist():
            r = _fold(r, np.frombuffer(x).reshape(-1, d))
        return pa.Table.from_batches([row(d, t.column("slot")[0].as_py() // FAN, r)])

    parts = stored(fit.mapInArrow(run, _TRIANGLE))
    while parts.groupBy("d").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0] > FAN:
        parts = stored(parts.groupBy("d", F.floor(F.col("slot") / FAN).alias("g")).applyInArrow(merge, _TRIANGLE))
    out: dict[int, np.ndarray] = {}
    for r in parts.orderBy("d", "slot").collect():  # FAN triangles at most for each length
        out[r.d] = _fold(out.get(r.d), np.frombuffer(r.r).reshape(-1, r.d))
    return out


def _identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    plan = {d: (np.array(m.sums) / m.n, m.scaled()) for d, m in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in unpack(b.column("d").to_numpy(), b.column("x")):
                if d:
                    y = np.hstack([np.ones((len(x), 1)), (x - plan[d][0]) @ plan[d][1]])
                    held[d] = held.get(d, 0) + y.T @ y
        for d, g in held.items():
            k = g.size
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, d, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(g.ravel())], ["d", "at", "s"])

    sums: dict[int, dict[int, float]] = {}
    for r in fit.mapInArrow(run, "d int, at int, s double").groupBy("d", "at").agg(F.sum("s").alias("s")).collect():
        sums.setdefault(r.d, {})[r["at"]] = r.s
    out = {}
    for d, s in sums.items():
        k = len(models[d].values) + 1
        g = np.array([s[i] for i in range(k * k)]).reshape(k, k) / models[d].n
        off = np.abs(g[1:, 1:] - np.outer(g[0, 1:], g[0, 1:]) - np.eye(k - 1))
        out[d] = float(np.nanmax(off)) if np.isfinite(off).any() else 0.0
    return out


def fit_models(rows: DataFrame, components: int) -> dict[int, Model]:
    """Whitening models of quantised rows (d, x), one for each vector length."""
    fit = stored(rows.select("d", "x").distinct())
    sums = _sums(fit)
    means = {d: np.array(s) / n for d, (n, s) in sums.items()}
    models = {}
    for d, r in _triangles(fit, means).items():
        values, directions = leading_directions(r, components)
        n, s = sums[d]
        models[d] = Model(n, s, values / n, directions, float((r * r).sum()) / n, 0.0)
    errors = _identity_errors(fit, models)
    return {d: m._replace(identity_error=errors[d]) for d, m in models.items()}


def deviations(x: np.ndarray, m: Model) -> pa.Array:
    """Sum of (n x - S)^2 of each row: exact, as wrapping sums are where the result fits; null where it does not."""
    near = ((m.n * x.astype(np.float64) - np.array(m.sums, np.float64)) ** 2).sum(1)
    y = np.uint64(m.n % 2**64) * x.view(np.uint64) - np.array([s % 2**64 for s in m.sums], np.uint64)
    exact = (y * y).sum(1, dtype=np.uint64).view(np.int64)
    return pa.array(exact, mask=near > 2.0**63 * (1 - 1e-9))


def whiten(vectors: DataFrame, components: int = 4, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """For each row with a valid vector and each of the leading components: (vec_id, component, n, deviation, whitened,
    explained, identity_error)."""
    rows = quantised(vectors, embedding, scale, {"vec_id": vec_id})
    models = fit_models(rows, components)
    plan = {d: (np.array(m.sums) / m.n, m.scaled()) for d, m in models.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, pick, x in unpack(b.column("d").to_numpy(), b.column("x")):
                if not d:
                    continue
                m, (mean, scaled) = models[d], plan[d]
                k = len(m.values)
                again = pa.array(np.repeat(np.arange(len(x)), k))
                white = ((x - mean) @ scaled).ravel()
                share = np.tile(m.values / m.trace if m.trace > 0 else np.full(k, np.nan), len(x))
                cols = [
                    b.column("vec_id").take(pa.array(pick)).take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(again), m.n, np.int64)), deviations(x, m).take(again),
                    pa.array(white, mask=np.isnan(white)), pa.array(share, mask=np.isnan(share)), pa.array(np.full(len(again), m.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(cols, [f.name for f in shape.fields])

    shape = T.StructType(
        [T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType())]
        + [T.StructField("deviation", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]
    )
    return rows.mapInArrow(run, shape)
