"""Vector code compression: product codes whose nearest codebook entries come from memoised grid cells.

Components become whole numbers floor(256 c); a vector is cut into equal consecutive parts (a length that the number
of parts does not divide is filled up with zeros). Each part position has a codebook, trained by rounds of
assignment and of componentwise floor(sum / count), summed exactly over all rows.

Nearest entries: a part's coarse grid cell is the key of a memo. For a new cell the least and the greatest distance
of every entry to the cell's box are computed, and the entries that are not dominated (their least distance is not
above the smallest greatest distance of any entry) are kept in the memo; only those are evaluated exactly for the
parts in that cell. The width of the cells follows the spread of the codebook and decides only the cost. A memo
holds a bounded number of cells and starts anew when it is full.

Sums of a task leave it as one row for each codebook component; the driver holds codebooks only.

Cases: rows with a null vector, or null or non-finite components, are dropped; empty vectors have entry 0 in every
part and error 0; each vector length has codebooks of its own, from the smallest vec_ids of that length (null
vec_ids last, ties by the vector); fewer rows than entries give fewer entries; entries that no part is assigned to
stay; ties go to the lower index; repeated rows all take part and all come back; components beyond 2^31 / 256 count
as 2^31 in whole numbers (and errors then may wrap); null labels form one group; an empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import stored
from kiln.llm.vectors import quantised, unpack

#: Cells that one memo (a part position in a task) holds.
MEMO_CELLS = 1 << 14
#: Numbers in the temporary arrays of one exact evaluation.
WORK = 1 << 21

Books = np.ndarray  # (parts, entries, width) of longs


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """(parts, rows, width) from rows of whole numbers."""
    n, d = x.shape
    width = -(-d // parts)
    full = np.zeros((n, parts * width), np.int64)
    full[:, :d] = x
    return full.reshape(n, parts, width).transpose(1, 0, 2)


class Cells:
    """The memo of one part position: candidate entries by grid cell."""

    def __init__(self, entries: np.ndarray, limit: int = MEMO_CELLS):
        self.entries, self.limit = entries, limit
        spread = float(entries.std(0).mean()) if entries.size else 0.0
        self.width = 1 << max(0, round(np.log2(max(1.0, spread))))
        self.memo: dict[bytes, np.ndarray] = {}
        self.evaluated = 0

    def _learn(self, cells: np.ndarray) -> None:
        for i in range(0, len(cells), max(1, WORK // max(1, self.entries.size))):
            some = cells[i : i + max(1, WORK // max(1, self.entries.size))]
            low = (some * self.width)[:, None, :]
            high = low + (self.width - 1)
            out = np.maximum(np.maximum(low - self.entries, self.entries - high), 0)
            far = np.maximum(np.abs(self.entries - low), np.abs(self.entries - high))
            least, most = (out * out).sum(2), (far * far).sum(2)
            alive = least <= most.min(1, keepdims=True)
            for cell, row in zip(some, alive, strict=True):
                self.memo[cell.tobytes()] = np.flatnonzero(row)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry (ties: the lower) and the squared distance, for every row of x."""
        code, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        if not x.shape[1]:
            return code, error
        cell, at = np.unique(x // self.width, axis=0, return_inverse=True)
        cell, at = np.ascontiguousarray(cell), at.ravel()
        keys = [c.tobytes() for c in cell]
        if len(self.memo) + len(cell) > self.limit:
            self.memo.clear()
        new = [i for i, k in enumerate(keys) if k not in self.memo]
        self._learn(cell[new])
        some = [self.memo[k] for k in keys]
        count = np.array([len(s) for s in some])
        first = np.concatenate([[0], np.cumsum(count)])
        flat = np.concatenate(some)
        step = max(1, WORK // (x.shape[1] * int(count.max())))
        for i in range(0, len(x), step):
            mine = at[i : i + step]
            n = count[mine]
            start = np.concatenate([[0], np.cumsum(n)])
            entry = flat[np.repeat(first[mine] - start[:-1], n) + np.arange(start[-1])]
            who = np.repeat(np.arange(len(mine)), n)
            gap = x[i : i + step][who] - self.entries[entry]
            far = (gap * gap).sum(1)
            self.evaluated += len(far)
            best = np.minimum.reduceat(far, start[:-1])
            hit = np.flatnonzero(far == best[who])
            hit = hit[np.concatenate([[True], who[hit][1:] != who[hit][:-1]])]
            code[i : i + step], error[i : i + step] = entry[hit], best
        return code, error


def _memos(books: dict[int, Books]) -> dict[int, list[Cells]]:
    return {d: [Cells(entries) for entries in b] for d, b in books.items()}


def first_books(rows: DataFrame, parts: int, entries: int) -> dict[int, Books]:
    """Codebooks from the first vectors of each length."""
    out = {}
    for (d,) in rows.select("d").distinct().orderBy("d").collect():  # one row for each vector length
        head = rows.where(F.col("d") == d).orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).collect()
        x = np.array([np.frombuffer(r.x, "<i2" if len(r.x) == 2 * d else "<i8").astype(np.int64) if d else np.zeros(0, np.int64) for r in head])
        out[d] = np.ascontiguousarray(cut(x.reshape(len(head), d), parts))
    return out


def _update(rows: DataFrame, books: dict[int, Books], parts: int) -> dict[int, Books]:
    """One round: every part to its nearest entry, every entry to the floored mean of its parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = _memos(books)
        held = {d: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for d, b in books.items()}
        for b in batches:
            for d, _, x in unpack(b.column("d").to_numpy(), b.column("x")):
                for p, part in enumerate(cut(x, parts)):
                    code, _ = memos[d][p].nearest(part)
                    order = np.argsort(code, kind="stable")
                    entry, start = np.unique(code[order], return_index=True)
                    held[d][p, entry] += np.add.reduceat(np.hstack([np.ones((len(part), 1), np.int64), part])[order], start)
        for d, h in held.items():
            p, e, at = np.nonzero(np.broadcast_to(h[:, :, :1] > 0, h.shape))
            kinds = [pa.array(np.full(len(p), d), pa.int32()), *[pa.array(v, pa.int32()) for v in (p, e, at)], pa.array(h[p, e, at])]
            yield pa.RecordBatch.from_arrays(kinds, ["d", "part", "entry", "at", "s"])

    sums = rows.select("d", "x").mapInArrow(run, "d int, part int, entry int, at int, s long").groupBy("d", "part", "entry", "at").agg(F.sum("s").alias("s"))
    total = {d: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for d, b in books.items()}
    for r in sums.collect():  # one number for each codebook component
        total[r.d][r.part, r.entry, r["at"]] = r.s
    return {d: np.where(t[:, :, :1] > 0, t[:, :, 1:] // np.maximum(t[:, :, :1], 1), books[d]) for d, t in total.items()}


def train(rows: DataFrame, parts: int, entries: int, rounds: int) -> dict[int, Books]:
    """Codebooks of quantised rows (vec_id, d, x) by vector length."""
    books = first_books(rows, parts, entries)
    for _ in range(rounds):
        books = _update(rows, books, parts)
    return books


def digest(b: Books) -> str:
    return hashlib.sha256(",".join(map(str, b.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: dict[int, Books], parts: int) -> DataFrame:
    """(vec_id, label, d, codes, error) of quantised rows; codes: one byte a part."""
    keep = [f for f in rows.schema.fields if f.name in ("vec_id", "label", "d")]
    shape = T.StructType([*keep, T.StructField("codes", T.BinaryType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos = _memos(books)
        for b in batches:
            for d, pick, x in unpack(b.column("d").to_numpy(), b.column("x")):
                found = [memos[d][p].nearest(part) for p, part in enumerate(cut(x, parts))]
                codes = np.array([c for c, _ in found]).astype(np.uint8).T
                mine = b.select([f.name for f in keep]).take(pa.array(pick))
                cols = [*mine.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(sum(e for _, e in found))]
                yield pa.RecordBatch.from_arrays(cols, shape.names)

    return rows.mapInArrow(run, shape)


def compress(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """(vec_id, label, codes, error, label_error, codebooks_sha256) for each row with a valid vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte a part: 1 to 256 entries")
    rows = stored(quantised(vectors, embedding, scale, {"vec_id": vec_id, "label": label}))
    books = train(rows, parts, entries, rounds)
    coded = stored(encode(rows, books, parts))
    by_label = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    names = [F.lit(v) for d, b in books.items() for v in (d, digest(b))]
    sha = F.create_map(*names)[F.col("d")] if names else F.lit(None).cast("string")
    both = coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
    return both.select("vec_id", "label", "codes", "error", "label_error", sha.alias("codebooks_sha256"))
