"""Suffix-array dedup with a logarithmic family of indexes.

Looks for byte strings of ``length`` bytes that start at two places or more. Suffixes are sampled by content: of
every window of ``length`` bytes the position whose next ``PREFIX`` bytes hash smallest is a sample, so equal
windows have the same sample at the same offset, and about one position in 180 is one. The sampled suffixes of a
batch of documents, sorted by prefix (by its hash, within partitions by hash), are its sparse suffix array.

Levels: a new batch's array is merge-scanned against itself and against every existing level (sort-merge joins
on the prefix; arrays and levels are partitioned and sorted alike, so a scan moves nothing); suffixes whose
prefix occurs at another place survive on both sides. Then the batch becomes a level of size 1. Before the next
batch, levels of equal size are merged into one of twice the size, so n batches leave about log2(n) levels and
an entry is merged at most log2(n) times. Levels are sorted tables in the checkpoint folder. Of equal prefixes
in one Arrow slice only the first enters the index; the others are known to survive.

Survivors are matched in full: the bytes of all windows that share a surviving sample meet by its prefix, and a
window is removed if the same bytes start at another place. Each Arrow slice folds equal contexts first (one
row of a context a slice), and prefixes with more than ``HOT`` places are dealt out by window hash instead.

Cases: null texts are empty; texts under ``length`` bytes lose nothing; a string that repeats inside one text
counts, overlaps included; rows repeated as a whole are one document and all get its result; equal texts
under different ids are different documents; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import BYTE_BASE, Slice, as_signed, mix64, runs_of, text_slices, window_hash
from kiln.llm.substring import _keyed
from kiln.session import shuffle_partitions

LENGTH, PREFIX = 400, 32
BATCHES = 4
#: Places of a prefix beyond which its windows are dealt out by hash.
HOT = 20_000
SEGMENT = 2 << 20
_POS_BITS = 23
_U = np.uint64


def segments(s: Slice, length: int) -> Iterator[tuple[int, Slice]]:
    """A slice itself, or a text too long for one in pieces that overlap by length - 1 bytes: (offset, piece)."""
    if len(s.buf) <= 2 * SEGMENT:
        yield 0, s
        return
    for at in range(0, max(1, len(s.buf) - length + 1), SEGMENT):
        piece = s.buf[at : at + SEGMENT + length - 1]
        yield at, Slice(s.first, 1, piece, np.array([0, len(piece)]))


def samples(s: Slice, length: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Samples of a slice: (position, text, first and last window start it is the sample of, prefix hash)."""
    none = np.zeros(0, np.int64)
    n = len(s.buf) - length + 1
    if n <= 0:
        return none, none, none, none, none.astype(np.uint64)
    h = window_hash(s.buf, prefix, BYTE_BASE)
    low = (h >> _U(_POS_BITS)) << _U(_POS_BITS) | np.arange(len(h)).astype(np.uint64)
    span, width = length - prefix + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: n], low[span - width : span - width + n])
    at = (low[:n] & _U((1 << _POS_BITS) - 1)).astype(np.int64)
    text = np.repeat(np.arange(s.rows), np.diff(s.off))
    start = np.flatnonzero(text[:n] == text[length - 1 :])
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    at, doc = at[start], text[start]
    cut = np.ones(len(at), bool)
    cut[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(cut)
    last = np.append(head[1:], len(at)) - 1
    return at[head], doc[head], start[head], start[last], h[at[head]]


def _entries(length: int, prefix: int):
    # sure rows have their prefix in ``own`` and any number in ``h``: they need no meeting and go anywhere
    shape = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("pos", pa.int64()), ("own", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key").to_numpy()
            for whole in text_slices(b.column("text"), SEGMENT):
                for off, s in segments(whole, length):
                    at, doc, _, _, h = samples(s, length, prefix)
                    key, pos = keys[s.first + doc], at - s.off[doc] + off
                    _, lead, inverse, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
                    first = np.zeros(len(h), bool)
                    first[lead] = True
                    # another place than the first of the prefix: both survive
                    other = (key != key[lead][inverse]) | (pos != pos[lead][inverse])
                    twice = (np.bincount(inverse, weights=other, minlength=len(n)) > 0)[inverse]
                    # indexed: the first of each prefix, and not twice; sure: known to survive
                    rows = np.concatenate([np.flatnonzero(first), np.flatnonzero(twice)])
                    sure = np.arange(len(rows)) >= len(lead)
                    loose = mix64(key[rows].view(np.uint64) + mix64(pos[rows].astype(np.uint64)))
                    own = pa.array(h[rows].view(np.int64), mask=~sure)
                    yield pa.RecordBatch.from_arrays([as_signed(np.where(sure, loose, h[rows])), pa.array(key[rows]), pa.array(pos[rows]), own], schema=shape)

    return run, "h long, key long, pos long, own long"


class IndexFamily:
    """Levels of suffix arrays (h, key, pos); ``scan`` finds what a batch shares with them, and adds it."""

    def __init__(self, partitions: int) -> None:
        self.partitions = partitions
        self.levels: list[tuple[int, DataFrame]] = []

    def arranged(self, entries: DataFrame) -> DataFrame:
        """Entries as suffix arrays are kept: partitioned and sorted by prefix, in a table of their own."""
        return entries.repartition(self.partitions, "h").sortWithinPartitions("h", "key", "pos").checkpoint()

    def scan(self, array: DataFrame) -> DataFrame:
        """Survivors (h, key, pos): of the batch, and of the levels where a prefix of the batch occurs."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self.arranged(b.union(a))))
        place = F.struct("key", "pos")
        within = array.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b")
        found = array.join(within.select("h"), "h", "left_semi")
        for _, level in self.levels:
            found = found.union(array.join(level.select("h"), "h", "left_semi"))
            found = found.union(level.join(array.select("h"), "h", "left_semi"))
        self.levels.append((1, array))
        return found


def _contexts(length: int, prefix: int):
    kind = "route long, doc_id long, key long, place long, n int, sure boolean, ctx binary, offs binary"
    shape = pa.schema([("route", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()), ("place", pa.int64()), ("n", pa.int32()), ("sure", pa.bool_()), ("ctx", pa.binary()), ("offs", pa.binary())])

    def rows_of(s: Slice, off: int, alive: dict[int, dict[int, int]], ids: list, keys: np.ndarray) -> list[tuple]:
        at, doc, first, last, h = samples(s, length, prefix)
        seen: dict[tuple, list] = {}
        for a, d, x, y, g in zip(at.tolist(), doc.tolist(), first.tolist(), last.tolist(), h.tolist(), strict=True):
            row = s.first + d
            base = int(s.off[d])
            times = alive[row].get(a - base + off) if row in alive else None
            if times is None:
                continue
            ctx = s.buf[x : y + length].tobytes()
            seen.setdefault((g, a - x, ctx), []).append((row, x - base + off, y - x + 1, times))
        out = []
        for (g, _, ctx), places in seen.items():
            signed = g - (1 << 64) if g >> 63 else g
            sure = len({(keys[r], ids[r], p) for r, p, _, _ in places}) > 1
            r, p, n, times = places[0]
            salts = -(-times // HOT)
            if salts == 1:
                out.append((signed, ids[r], int(keys[r]), p, n, sure, ctx, None))
            else:
                wins = window_hash(np.frombuffer(ctx, np.uint8), length, BYTE_BASE)
                for k in range(salts):
                    own = np.flatnonzero(wins % _U(salts) == k)
                    route = int(mix64(np.array([g + k & (1 << 64) - 1], np.uint64)).view(np.int64)[0])
                    out.append((route, ids[r], int(keys[r]), p, n, sure, wins[own].tobytes(), own.astype(np.int32).tobytes()))
            if sure:  # known here: these places need no meeting
                loose = mix64(np.array([x[1] for x in places], np.uint64) ^ _U(g)).view(np.int64)
                out += [(int(z), ids[r], int(keys[r]), p, n, True, None, None) for z, (r, p, n, _) in zip(loose, places, strict=True)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = b.column("doc_id").to_pylist(), b.column("key").to_numpy()
            alive = {i: dict(zip(p, t, strict=True)) for i, (p, t) in enumerate(zip(b.column("pos").to_pylist(), b.column("times").to_pylist(), strict=True))}
            for whole in text_slices(b.column("text"), SEGMENT):
                for off, s in segments(whole, length):
                    rows = rows_of(s, off, alive, ids, keys)
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), shape, strict=True)], schema=shape)

    return run, kind


def _repeats(length: int):
    """Windows that occur at two places: of groups of contexts with one prefix, several groups at a time."""
    shape = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("place", pa.int64())])

    def solve(t: pa.Table) -> pa.RecordBatch:
        ids, keys, place = t.column("doc_id"), t.column("key").to_numpy(), t.column("place").to_numpy()
        n, sure = t.column("n").to_numpy(), t.column("sure").to_numpy()
        out_row, out_start, out_size = [], [], []
        wins, rows, offs = [], [], []
        for i, (ctx, off) in enumerate(zip(t.column("ctx").to_pylist(), t.column("offs").to_pylist(), strict=True)):
            if ctx is None:
                out_row.append(np.array([i]))
                out_start.append(place[i : i + 1])
                out_size.append(n[i : i + 1].astype(np.int64))
                continue
            w = window_hash(np.frombuffer(ctx, np.uint8), length, BYTE_BASE) if off is None else np.frombuffer(ctx, np.uint64)
            wins.append(w)
            offs.append(np.arange(len(w)) if off is None else np.frombuffer(off, np.int32).astype(np.int64))
            rows.append(np.full(len(w), i))
        if wins:
            w, r, o = np.concatenate(wins), np.concatenate(rows), np.concatenate(offs)
            order = np.argsort(w, kind="stable")
            w, r, o = w[order], r[order], o[order]
            head = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]])) if len(w) else np.zeros(0, np.int64)
            if len(head):
                spot = mix64(keys[r].view(np.uint64) + mix64((place[r] + o).astype(np.uint64)))
                twice = np.minimum.reduceat(spot, head) != np.maximum.reduceat(spot, head)
                twice |= np.logical_or.reduceat(sure[r], head)
                again = np.repeat(twice, np.diff(np.append(head, len(w)))) & ~sure[r]
                r, at = r[again], place[r[again]] + o[again]
                by = np.lexsort((at, r))
                r, at = r[by], at[by]
                cut = np.ones(len(r), bool)
                cut[1:] = (r[1:] != r[:-1]) | (at[1:] != at[:-1] + 1)
                first = np.flatnonzero(cut)
                out_row.append(r[first])
                out_start.append(at[first])
                out_size.append(np.diff(np.append(first, len(r))))
        none = np.zeros(0, np.int64)
        row, start, size = (np.concatenate([none, *x]) for x in (out_row, out_start, out_size))
        return pa.RecordBatch.from_arrays([ids.combine_chunks().take(pa.array(row)), pa.array(keys[row]), pa.array(size << 32 | start)], schema=shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for t in runs_of(batches, "route"):
            held.append(t)
            size += t.nbytes
            if size > 1 << 20:
                yield solve(pa.concat_tables(held))
                held, size = [], 0
        if held:
            yield solve(pa.concat_tables(held))

    return run, "doc_id long, key long, place long"


def survivors(docs: DataFrame, length: int, prefix: int, batches: int) -> DataFrame:
    """Places (h, key, pos) of sampled suffixes whose prefix occurs at another place, batch by batch."""
    run, kind = _entries(length, prefix)
    family = IndexFamily(shuffle_partitions(docs.sparkSession))
    # one pass over the texts; the suffix array of each batch is a part of this table, sorted as it is
    entries = family.arranged(docs.select("key", "text").mapInArrow(run, kind))
    found = entries.where("own is not null").select(F.col("own").alias("h"), "key", "pos")
    for k in range(batches):
        array = entries.where(F.col("own").isNull() & (F.pmod("key", F.lit(batches)) == k)).select("h", "key", "pos")
        found = found.union(family.scan(array))
    return found.distinct().checkpoint()


def _spans(length: int):
    """Removed byte ranges of a text, and its digests, from the places of its repeated windows."""

    def run(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for s in text_slices(texts):
            for i in range(s.rows):
                raw = s.buf[s.off[i] : s.off[i + 1]]
                late = places[s.first + i]
                n = len(raw)
                edge = np.zeros(n + 1, np.int64)
                if late.is_valid and len(late.values):
                    p = late.values.to_numpy()
                    start = p & ((1 << 32) - 1)
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + (p >> 32) - 1 + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                kept = raw[~gone].tobytes()
                out.append({"n_bytes": n, "n_removed": int(gone.sum()), "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest(),
                            "spans": [{"a": a, "b": b} for a, b in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True)]})
        span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        return pa.array(out, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("kept_sha256", pa.string()), ("kept", pa.binary())]))

    return F.arrow_udf(run, "n_bytes long, n_removed long, spans array<struct<a:long,b:long>>, kept_sha256 string, kept binary")


def dedup(docs: DataFrame, length: int = LENGTH, prefix: int = PREFIX, batches: int = BATCHES, text: str = "text", out: str = "cut") -> DataFrame:
    """``docs`` with a struct ``out``: n_bytes, n_removed, spans (removed byte ranges), kept (the other bytes) and
    kept_sha256. Every byte covered by a ``length``-byte string that starts at another place, too, is removed."""
    if not 8 <= prefix <= length:
        raise ValueError("prefix must be from 8 to length bytes")
    rows = _keyed(docs, text)
    found = survivors(rows, length, prefix, batches)
    times = found.groupBy("h").agg(F.count("*").alias("times"))
    alive = found.join(times, "h").groupBy("key").agg(F.collect_list("pos").alias("pos"), F.collect_list("times").alias("times"))
    run, kind = _contexts(length, prefix)
    ctx = rows.join(alive, "key").mapInArrow(run, kind)
    run, kind = _repeats(length)
    late = ctx.repartition("route").sortWithinPartitions("route").mapInArrow(run, kind)
    late = late.groupBy("key", "doc_id").agg(F.collect_list("place").alias("places"))
    late = late.groupBy("key").agg(F.collect_list(F.struct("doc_id", "places")).alias("runs"))
    own = F.filter(F.col("runs"), lambda r: r["doc_id"].eqNullSafe(F.col("doc_id")))
    joined = rows.join(late, "key", "left").withColumn("own", F.get(own, F.lit(0)))
    columns = [F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns]
    return joined.select(*columns, _spans(length)(F.col("text"), F.col("own")["places"]).alias(out))
