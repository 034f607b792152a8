"""Whitening and vector codes against plain numpy versions, with the awkward rows."""

import hashlib
import math

import numpy as np
import pytest

import __spark_entry__ as E
from kiln.llm import vector_codes, whitening
from kiln.llm.vectors import quantised
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, d int, x string, component int, n string, codes string, error string, of string"


def vectors(seed=0, n=300, d=8, hot=60):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, d)) * np.linspace(0.05, 0.4, d)
    rows = [(i, base[i].tolist(), int(r.integers(4)) if i % 7 else None) for i in range(n)]
    rows += [(1000 + i, base[0].tolist(), 9) for i in range(hot)]  # copies under many ids
    rows += [rows[3], rows[3]]  # a row repeated as a whole
    rows += [(2000, None, 1), (2001, [math.nan] * d, 1), (2002, [math.inf] + [0.0] * (d - 1), 1), (2003, [None] + [0.5] * (d - 1), 1)]
    rows += [(None, base[1].tolist(), 2), (2004, [], 1), (2005, [-0.0] * d, 3)]
    return [(*row, 5, "x", 1, "n", "c", "e", "o") for row in rows]


def matrix(rows, d=8):
    ok = [r for r in rows if r[1] is not None and len(r[1]) == d and all(c is not None and math.isfinite(c) for c in r[1])]
    return ok, np.floor(256 * np.array([r[1] for r in ok])).astype(int)


@pytest.mark.parametrize("n", [1, 2, 5, 64])
@pytest.mark.parametrize("kind", ["plain", "graded", "low rank", "equal", "zero"])
def test_solver_matches_numpy(n, kind):
    r = np.random.default_rng(n)
    m = r.normal(size=(n, n))
    if kind == "graded":
        m = m * 10.0 ** np.linspace(0, -6, n)
    elif kind == "low rank":
        m[:, n // 2 :] = m[:, : n - n // 2]
    elif kind == "equal":
        m = np.linalg.qr(m)[0] * 3
    elif kind == "zero":
        m = m * 0
    values, z = whitening.leading_directions(np.linalg.qr(m, mode="r"), 4)
    want = np.sort(np.linalg.svd(m, compute_uv=False))[::-1][:4] ** 2
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top + 1e-50
    assert np.abs(z.T @ z - np.eye(len(values))).max() < 1e-12
    assert np.abs(m.T @ m @ z - z * values).max() <= 1e-12 * top + 1e-50


def test_dqds_keeps_small_values_accurate():
    """Singular values over 30 orders of magnitude, each to some digits of its own."""
    a = 10.0 ** -np.arange(0, 16, dtype=float)
    b = a[:-1] * 1e-9
    got = np.sqrt(whitening.dqds(a, b))
    assert np.allclose(got, a, rtol=1e-12, atol=0)


def test_whitening(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    ok, x = matrix(rows)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, z = np.linalg.eigh(centred.T @ centred / n)
    values, z = values[::-1][:4], z[:, ::-1][:, :4]
    white = (x - s / n) @ z / np.sqrt(values)
    dev = ((n * x - s) ** 2).sum(1)
    assert len(got) == 4 * len(ok)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, r)
        assert r.n == n and r.identity_error < 1e-9
    sign = None
    for (vec, *_), w, e in zip(ok, white, dev.tolist(), strict=True):
        mine = [by[vec, e][k] for k in range(1, 5)]
        y = np.array([r.whitened for r in mine])
        sign = np.sign(y * w) if sign is None else sign
        assert np.abs(y * sign - w).max() < 1e-9
        assert np.allclose([r.explained for r in mine], values / np.trace(centred.T @ centred / n), rtol=1e-10)


def test_whitening_tree_and_partitions(spark, monkeypatch):
    """More triangles than the fan: folded in several levels, with the same result."""
    df = spark.createDataFrame(vectors(n=200), SCHEMA)
    spread = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        monkeypatch.setattr(whitening, "FAN", 2)
        tree = whitening.fit_models(quantised(df.repartition(7), "embedding", 256.0, {}), 4)[8]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", spread)
    monkeypatch.undo()
    flat = whitening.fit_models(quantised(df.repartition(1), "embedding", 256.0, {}), 4)[8]
    assert tree.n == flat.n and tree.sums == flat.sums
    assert np.allclose(tree.values, flat.values, rtol=1e-13)
    assert np.allclose(np.abs((tree.directions * flat.directions).sum(0)), 1, atol=1e-12)


def test_whitening_without_variance_and_empty(spark):
    kind = "vec_id string, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], kind)).count() == 0
    one = whitening.whiten(spark.createDataFrame([("a", [0.5, 0.25, 1.0])] * 3, kind)).collect()
    assert len(one) == 9 and all((r.whitened, r.explained, r.identity_error, r.deviation, r.n) == (None, None, 0.0, 0, 1) for r in one)
    flat = [("a", [0.5, 0.25]), ("b", [0.75, 0.25]), ("c", [0.5])]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(flat, kind)).collect()}
    assert len(got) == 5  # two lengths, two models
    assert abs(got["a", 1].whitened) == pytest.approx(1) and got["a", 2].whitened is None and got["a", 1].explained == pytest.approx(1)
    assert got["a", 2].identity_error < 1e-9 and got["c", 1].n == 1


def test_deviation_beyond_a_long_is_null():
    m = whitening.Model(1 << 40, [0, 0], np.ones(2), np.eye(2), 1.0, 0.0)
    assert whitening.deviations(np.array([[100, -100], [0, 0]], np.int64), m).to_pylist() == [None, 0]
    small = whitening.Model(3, [7, -5], np.ones(2), np.eye(2), 1.0, 0.0)
    assert whitening.deviations(np.array([[4, 9]], np.int64), small).to_pylist() == [25 + 32**2]


def plain_codes(x, parts, entries, rounds):
    p = x.reshape(len(x), parts, -1).transpose(1, 0, 2)
    books = p[:, :entries].copy()

    def assign():
        far = [((p[k][:, None] - books[k][None]) ** 2).sum(2) for k in range(parts)]
        return np.array([f.argmin(1) for f in far]), sum(f.min(1) for f in far)

    for _ in range(rounds):
        code, _ = assign()
        for k in range(parts):
            for e in range(books.shape[1]):
                m = p[k][code[k] == e]
                if len(m):
                    books[k, e] = m.sum(0) // len(m)
    return *assign(), books


@pytest.mark.parametrize("memo", [vector_codes.MEMO_CELLS, 3])
def test_vector_codes(spark, memo, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMO_CELLS", memo)
    rows = vectors(hot=90)
    got = vector_codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(4), parts=4, entries=16)
    ok, _ = matrix(rows)
    ok.sort(key=lambda r: (r[0] is None, r[0]))
    _, x = matrix(ok)
    code, error, books = plain_codes(x, 4, 16, 2)
    sha = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    by_label = {}
    for r, e in zip(ok, error.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    want = sorted(((str(r[0]), str(r[2]), bytes(c.tolist()), e, by_label[r[2]], sha) for r, c, e in zip(ok, code.T, error.tolist(), strict=True)))
    rest = [r for r in got.collect() if r.vec_id != 2004]
    assert sorted((str(r.vec_id), str(r.label), bytes(r.codes), r.error, r.label_error, r.codebooks_sha256) for r in rest) == want
    assert [(bytes(r.codes), r.error) for r in got.where("vec_id = 2004").collect()] == [(b"\0" * 4, 0)]  # the empty vector


def test_cells_prune_and_stay_exact():
    r = np.random.default_rng(3)
    entries = r.integers(-100, 100, size=(64, 4))
    entries[10] = entries[4]  # a tie: the lower index
    x = r.integers(-150, 150, size=(5000, 4))
    cells = vector_codes.Cells(entries)
    code, error = cells.nearest(x)
    far = ((x[:, None] - entries[None]) ** 2).sum(2)
    assert (code == far.argmin(1)).all() and (error == far.min(1)).all()
    assert cells.evaluated < 0.6 * far.size  # dominated entries are not evaluated
    known = len(cells.memo)
    cells.nearest(x)
    assert len(cells.memo) == known


def test_vector_codes_small_tables(spark):
    kind = "vec_id long, embedding array<float>, label string"
    assert vector_codes.compress(spark.createDataFrame([], kind)).count() == 0
    few = [(1, [1.0, 2.0, 3.0], "a"), (2, [1.0, 2.0, 4.0], "a"), (3, [5.0], None)]  # lengths that 2 doesn't divide
    got = {r.vec_id: r for r in vector_codes.compress(spark.createDataFrame(few, kind), parts=2, entries=4).collect()}
    assert [bytes(got[k].codes) for k in (1, 2, 3)] == [b"\0\0", b"\0\1", b"\0\0"]
    assert {r.error for r in got.values()} == {0}
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame(few, kind), entries=300)


def test_contract_columns(spark):
    types = {
        "op11_embedding_whitening": [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")],
        "op12_vector_codes": [("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")],
        "op13_url_filter": [("page_id", "bigint"), ("host", "string"), ("path", "string"), ("rule", "string"), ("verdict", "string")],
    }
    for name, kinds in types.items():
        assert E.queries()[name](spark, SF_SMALL).dtypes == kinds
