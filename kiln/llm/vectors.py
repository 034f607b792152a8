"""Vector columns in tasks: valid vectors of a batch as matrices, and whole numbers in place of their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Whole-number components stay within this magnitude, so that sums over billions of rows fit a long.
LIMIT = 1 << 31


def matrices(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each vector length of the column; vectors that are null or hold null or non-finite
    components are left out."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = pc.list_value_length(col)
    rows = np.flatnonzero(size.is_valid().to_numpy(zero_copy_only=False))
    size = size.drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
    values = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    fine = bad[end] == bad[end - size]
    for d in np.unique(size[fine]).tolist():
        pick = np.flatnonzero(fine & (size == d))
        at = (end[pick] - d)[:, None] + np.arange(d)
        yield rows[pick], values[at]


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * value) as long, within LIMIT."""
    return np.clip(np.floor(scale * values), -LIMIT, LIMIT).astype(np.int64)


def pack(x: np.ndarray) -> list[bytes]:
    """The rows of a matrix of longs as bytes, two a component where all of the row fit, else eight."""
    if not x.shape[1]:
        return [b""] * len(x)
    narrow = (np.abs(x).max(1) < 1 << 15).tolist()
    small = x.astype("<i2")
    return [small[i].tobytes() if n else x[i].astype("<i8").tobytes() for i, n in enumerate(narrow)]


def unpack(d: np.ndarray, x: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix of longs) for each vector length and byte width of packed rows."""
    n = pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64)
    off = np.frombuffer(x.buffers()[1], np.int32)[x.offset : x.offset + len(x) + 1].astype(np.int64)
    data = np.frombuffer(x.buffers()[2] or b"", np.uint8)
    for size, length in sorted({*zip(d.tolist(), n.tolist(), strict=True)}):
        rows = np.flatnonzero((d == size) & (n == length))
        if not size:
            yield 0, rows, np.zeros((len(rows), 0), np.int64)
            continue
        raw = data[off[rows][:, None] + np.arange(length)]
        yield size, rows, raw.view("<i2" if length == 2 * size else "<i8").astype(np.int64)


def quantised(vectors: DataFrame, embedding: str, scale: float, carry: dict[str, str]) -> DataFrame:
    """Columns of ``carry`` (new name: column) with d (length) and x (packed whole numbers), valid vectors only."""
    rows = vectors.select(F.col(embedding).alias("v"), *[F.col(c).alias(n) for n, c in carry.items()])
    shape = T.StructType([*rows.schema.fields[1:], T.StructField("d", T.IntegerType()), T.StructField("x", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pick, m in matrices(b.column(0)):
                kept = b.select(b.schema.names[1:]).take(pa.array(pick))
                d, x = pa.array(np.full(len(m), m.shape[1], np.int32)), pa.array(pack(whole(m, scale)), pa.binary())
                yield pa.RecordBatch.from_arrays([*kept.columns, d, x], [*kept.schema.names, "d", "x"])

    return rows.mapInArrow(run, shape)
