"""Helpers shared by the operators of this package: text slices, vectorised hashes, row keys, components.

Text reaches Python as Arrow string columns; ``text_slices`` cuts a column into runs of whole texts of
bounded size, so temporary arrays stay small whatever the batch size (one text longer than the bound is a
slice by itself). Null texts count as empty.
"""

from __future__ import annotations

import ctypes
import time
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 20
#: Rows of one Arrow batch: keeps a batch of long texts within some tens of MB.
BATCH_ROWS = 1000
HASH_BYTES = 1 << 18
#: Bits of a filter of keys for each key, and at most.
KEY_BITS, FILTER_BITS = 16, 1 << 28
#: Seconds without use after which a worker drops what it keeps.
IDLE_S = 10

_U = np.uint64
#: Odd multipliers of the polynomial hashes (any odd 64-bit numbers do).
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: a checkpoint folder and Arrow batches of bounded size."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


class Slice(NamedTuple):
    first: int  # row of the batch that the first text is
    rows: int
    buf: np.ndarray  # uint8, the texts one after another
    off: np.ndarray  # int64, rows + 1 offsets into buf


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    arr = pc.fill_null(col.cast(pa.large_binary()), b"")
    n = len(arr)
    if not n:
        return
    bufs = arr.buffers()
    off = np.frombuffer(bufs[1], np.int64)[arr.offset : arr.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield Slice(i, j - i, data[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective avalanche of 64-bit values."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i up to n."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = max(1 << 16, n + 1 + n // 8)
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        _powers[base] = (out[0], out[1])
    fwd, inv = _powers[base]
    return fwd[: n + 1], inv[: n + 1]


def prefix_hash(values: np.ndarray, base: int) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` takes the hash of any range from them."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + _U(1)) * powers(base, len(values))[0][: len(values)], out=out[1:])
    return out


def span_hash(pre: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    return mix64((pre[end] - pre[start]) * powers(base, len(pre))[1][start])


def window_hash(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every run of ``width`` values (len - width + 1 of them)."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    pre = prefix_hash(values, base)
    n = len(values) - width + 1
    return mix64((pre[width:] - pre[:n]) * powers(base, len(pre))[1][:n])


#: White space of the word patterns `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words(NamedTuple):
    start: np.ndarray  # byte offsets into the slice
    end: np.ndarray
    first: np.ndarray  # rows + 1: index of each text's first word


def split_words(s: Slice, space: np.ndarray = SPACE) -> Words:
    """Maximal runs of non-space bytes; a run never crosses from one text to the next."""
    solid = ~space[s.buf]
    if not len(solid):
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(s.rows + 1, np.int64))
    edge = np.zeros(len(solid) + 1, bool)
    edge[s.off] = True
    before, after = np.empty_like(solid), np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    after[-1], after[:-1] = False, solid[1:]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return Words(start, end, np.searchsorted(start, s.off))


def word_hashes(buf: np.ndarray, w: Words) -> np.ndarray:
    """Hash of each word; the byte sums are taken over some hundred KB at a time."""
    out = np.empty(len(w.start), np.uint64)
    i = 0
    while i < len(out):
        base = w.start[i]
        j = max(i + 1, int(np.searchsorted(w.end, base + HASH_BYTES, "right")))
        pre = prefix_hash(buf[base : w.end[j - 1]], BYTE_BASE)
        out[i:j] = span_hash(pre, w.start[i:j] - base, w.end[i:j] - base, BYTE_BASE)
        i = j
    return out


def owner(first: np.ndarray) -> np.ndarray:
    """Index of the text for each item, from the texts' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it a name that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def result_name(df: DataFrame, name: str) -> str:
    """The name of a column to be added; one that ``df`` has already is an error, never overwritten."""
    if free_name(df, name) != name:
        raise ValueError(f"the table has a column {name}: choose another name for the result")
    return name


try:
    _trim = ctypes.CDLL(None).malloc_trim
except AttributeError:  # not a GNU system
    _trim = None


class WorkerCache:
    """What a worker keeps from task to task, such as a vocabulary's automaton, and can build again.

    Each worker of an executor has its own; ``give_back`` drops what no step has used for ``IDLE_S`` seconds, so the
    steps that come later don't carry it along.
    """

    every: list[WorkerCache] = []

    def __init__(self, most: int):
        self.most, self.held, self.used = most, {}, 0.0
        self.every.append(self)

    def get(self, key: str, build: Callable[[], object]):
        self.used = time.monotonic()
        if key not in self.held:
            if len(self.held) >= self.most:
                self.held.clear()
            self.held[key] = build()
            self.used = time.monotonic()
            give_back()
        return self.held[key]


def give_back() -> None:
    """Memory that a finished task has freed, and what lies idle, goes back to the system: a worker serves many tasks."""
    for cache in WorkerCache.every:
        if time.monotonic() - cache.used > IDLE_S:
            cache.held.clear()
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def trimmed(run):
    """A function over the batches of a task that gives memory back at its end."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def row_key(text: str = "text", doc_id: str = "doc_id") -> Column:
    """Key of a row by its content: rows repeated as a whole share it and count as one document."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def as_signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def local_components(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the edges (u, v)."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        before = label.copy()
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        label = label[label]
        if np.array_equal(before, label):
            break
        keep = label[u] != label[v]
        u, v = u[keep], v[keep]
    while not np.array_equal(label, label[label]):
        label = label[label]
    return label


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (u, v): rows (node, component), component the smallest node reachable.

    Alternating large-star and small-star rounds with minima from partial aggregates and joins, so a hub of
    many links is never collected in one place; each round ends in a table of the checkpoint folder.
    """
    e = edges.where("u is not null and v is not null and u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    e = stored(e.distinct())
    state = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(low.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v")
        )
        e = stored(small.where("u != v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    found = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(e.select("v", "v").distinct())


def runs_of(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Tables of the rows with one value of ``column``, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        v = b.column(column).to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(v[1:] != v[:-1]) + 1, [len(v)]])
        if held and held[-1].column(column)[0].as_py() != v[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if a and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(a, z - a))
    if held:
        yield pa.Table.from_batches(held)


def sifted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``rows`` whose ``key`` is among those of ``keys``, and a few others, before a join shuffles them.

    One bit for each hash of a key, in bitmaps that go to every task: 16 bits a key, 32 MB at most whatever the
    keys. With more than 2^24 keys more of the other rows pass; none that the join needs is ever lost.
    """
    bits = min(max(1 << 15, 1 << (KEY_BITS * keys.count()).bit_length()), FILTER_BITS)
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    cell, at = F.floor(place / 32768).cast("int"), F.pmod(place, F.lit(32768))
    maps = keys.groupBy(cell.alias("cell")).agg(F.bitmap_construct_agg(at).alias("bits"))
    whole = rows.select(F.struct(*rows.columns).alias("row"), cell.alias("cell"), at.cast("int").alias("at"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = whole.join(F.broadcast(maps), "cell").where(F.getbit(byte, F.pmod("at", F.lit(8))) == 1)
    return met.select("row.*")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared checkpoint folder and read again: its lineage ends there, and the
    shuffles behind it don't stay on disk for the steps after it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)
