"""Substring dedup on word windows by level-wise doubling.

A window of ``width`` words is repeated only if each half-length run inside it is. Level 1 (half the width)
looks at one run of every window, its minimiser (the run with the smallest hash, so equal windows pick the
same run at the same place; about one position in six is the minimiser of some window). Runs that occur
once are dropped, with all the windows they stand for; the runs that repeat are extended to the full width at
level 2, where each window that occurs again keeps its earliest place only. Longer repeats are chains of
repeated windows, so nothing is left to extend.

Each Arrow slice folds its own repeats before the shuffle: of equal runs or windows only the earliest of the
slice is sent under its hash, the others are already known to be repeated. A passage in a third of all rows
so meets as one row per slice, never one per copy.

Cases: null texts and texts under ``width`` words lose nothing; the order of places is (doc_id, start), null
ids first; rows repeated as a whole are one document and all get its result; rows that share a doc_id but
not the text are ordered by text hash; empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import (
    SPACE,
    WORD_BASE,
    as_signed,
    give_back,
    mix64,
    owner,
    row_key,
    split_words,
    text_slices,
    trimmed,
    window_hash,
    word_hashes,
)

WIDTH = 20
SLICE = 4 << 20
_U = np.uint64


def _anchors(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a slice: (start word of each window, its document, its minimiser's word, hashes of all runs)."""
    half = width // 2
    doc = owner(first)
    runs = window_hash(h, half, WORD_BASE)
    n = len(h) - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, runs
    best, at = runs[:n].copy(), np.arange(n)
    for j in range(1, width - half + 1):
        less = runs[j : j + n] < best
        best[less] = runs[j : j + n][less]
        at[less] = np.flatnonzero(less) + j
    start = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return start, doc[start], at[start], runs


def _fold(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys in place order: index of each first occurrence, and how often its key occurs."""
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def _level1(width: int):
    shape = pa.schema([("route", pa.int64()), ("key", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key").to_numpy()
            for s in text_slices(b.column("text"), SLICE):
                w = split_words(s)
                _, doc, at, runs = _anchors(word_hashes(s.buf, w), w.first, width)
                new = np.ones(len(at), bool)
                new[1:] = at[1:] != at[:-1]
                at, doc = at[new], doc[new]
                run_hash = runs[at]
                first, n = _fold(run_hash)
                count = np.zeros(len(at), np.int64)
                count[first] = np.minimum(n, 2)
                # rows that are known to repeat need no meeting: they go anywhere
                route = np.where(count > 0, run_hash, mix64(run_hash + np.arange(len(at)).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [as_signed(route), pa.array(keys[s.first :][doc]), pa.array((at - w.first[doc]) << 2 | count)],
                    schema=shape,
                )

    return run, "route long, key long, place long"


def _level2(width: int):
    shape = pa.schema([(c, pa.int64()) for c in ("route", "doc_id", "key", "place")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, pos = b.column("doc_id"), b.column("key").to_numpy(), b.column("pos")
            order_id = np.array([-(1 << 63) if x is None else x for x in ids.to_pylist()], np.int64)
            for s in text_slices(b.column("text"), SLICE):
                w = split_words(s)
                h = word_hashes(s.buf, w)
                start, doc, at, _ = _anchors(h, w.first, width)
                if not len(start):
                    continue
                lists = pos.slice(s.first, s.rows)
                flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
                alive = np.zeros(len(h) + 1, bool)
                alive[np.repeat(w.first[:-1], size) + flat] = True
                keep = alive[at]
                start, doc = start[keep], doc[keep]
                full = window_hash(h, width, WORD_BASE)[start]
                where = start - w.first[doc]
                row = s.first + doc
                # order of places: document, then start; rows repeated as a whole count as one place
                order = np.lexsort((where, keys[row], order_id[row], full))
                f, r, p = full[order], row[order], where[order]
                head = np.ones(len(f), bool)
                head[1:] = f[1:] != f[:-1]
                lead = np.maximum.accumulate(np.where(head, np.arange(len(f)), 0))
                same = (keys[r] == keys[r[lead]]) & (order_id[r] == order_id[r[lead]]) & (p == p[lead])
                ask = np.flatnonzero(head)
                ask = ask[np.lexsort((p[ask], r[ask]))]  # rows of a document together: they compress well
                sure = ~same
                # repeats known here go as runs of consecutive starts, anywhere
                sr, sp = r[sure], p[sure]
                by = np.lexsort((sp, sr))
                sr, sp = sr[by], sp[by]
                cut = np.ones(len(sr), bool)
                cut[1:] = (sr[1:] != sr[:-1]) | (sp[1:] != sp[:-1] + 1)
                at0 = np.flatnonzero(cut)
                length = np.diff(np.append(at0, len(sr)))
                rows = np.concatenate([r[ask], sr[at0]])
                places = np.concatenate([p[ask], sp[at0]])
                known = np.concatenate([np.zeros(len(ask), np.int64), length])
                loose = mix64(places.astype(np.uint64) + (keys[rows].view(np.uint64) << _U(1)))
                route = np.where(known > 0, loose, np.concatenate([f[ask], np.zeros(len(at0), np.uint64)]))
                yield pa.RecordBatch.from_arrays(
                    [as_signed(route), ids.take(pa.array(rows)), pa.array(keys[rows]), pa.array(known << 32 | places)], schema=shape
                )

    return run, "route long, doc_id long, key long, place long"


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """One column ``rest`` with all columns of ``docs``, whatever their names, beside doc_id, text and key."""
    rest = [F.col(c) for c in docs.columns if c != text]
    rows = docs.select(F.struct(*rest).alias("rest"), F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.withColumn("key", row_key())


def _late_windows(rows: DataFrame, width: int) -> DataFrame:
    """Runs of windows that occur at an earlier place: (key, runs array<struct<doc_id, places>>).

    A place is the start word in the low 32 bits and the number of windows above them; level 1 has the start
    above two bits that tell how often (0: another row of the slice asks, 2: twice or more) its run occurs.
    """
    if width < 2 or width % 2:
        raise ValueError("width must be even")
    run, kind = _level1(width)
    level1 = rows.select("key", "text").mapInArrow(trimmed(run), kind)
    meet = Window.partitionBy("route")
    times = F.col("place").bitwiseAND(3)
    met = level1.withColumn("met", F.sum((times > 0).cast("int")).over(meet))
    alive = met.where((times != 1) | (F.col("met") > 1)).select("key", F.shiftright("place", 2).cast("int").alias("pos"))
    alive = alive.groupBy("key").agg(F.collect_list("pos").alias("pos"))
    run, kind = _level2(width)
    # all columns go along, so that this shuffle of the texts is the one that dedup() joins with, too
    level2 = rows.join(alive, "key").mapInArrow(trimmed(run), kind)
    sure = F.col("place") >= 1 << 32
    spot = F.struct("doc_id", "key", "place")
    first = F.min(F.when(~sure, spot)).over(meet)
    late = level2.withColumn("first", first).where(sure | (spot != F.col("first")))
    late = late.groupBy("key", "doc_id").agg(F.collect_list("place").alias("places"))
    return late.groupBy("key").agg(F.collect_list(F.struct("doc_id", "places")).alias("runs"))


def repeated_windows(docs: DataFrame, width: int = WIDTH, text: str = "text") -> DataFrame:
    """Runs of windows that occur at an earlier place: rows (doc_id, start, size).

    ``start`` is the word where the first window of the run starts, ``size`` the number of windows.
    """
    late = _late_windows(_keyed(docs, text), width).select(F.inline("runs")).select("doc_id", F.explode("places").alias("place"))
    size = F.greatest(F.shiftright("place", 32), F.lit(1))
    return late.select("doc_id", F.col("place").bitwiseAND((1 << 32) - 1).alias("start"), size.alias("size"))


def removed_words(n: int, places: np.ndarray, width: int) -> np.ndarray:
    """Mask of the words that the windows of the places cover."""
    edge = np.zeros(n + 1, np.int64)
    start, size = places & ((1 << 32) - 1), np.maximum(places >> 32, 1)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + size - 1 + width, n), -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(width: int, digest: bool):
    def run(texts: pa.Array, places: pa.Array) -> pa.Array:
        total, gone, kept = [], [], []
        for s in text_slices(texts, SLICE):
            w = split_words(s)
            for i in range(s.rows):
                a, b = w.first[i], w.first[i + 1]
                late = places[s.first + i]
                raw = s.buf[s.off[i] : s.off[i + 1]].tobytes()
                total.append(int(b - a))
                if not late.is_valid or not len(late.values):
                    words = raw.translate(_BLANK).split(b" ") if digest else None
                    kept.append(b" ".join(x for x in words if x) if digest else raw)
                    gone.append(0)
                    continue
                mask = removed_words(int(b - a), late.values.to_numpy(), width)
                at = s.off[i]
                if digest:
                    stay = np.flatnonzero(~mask) + a
                    kept.append(b" ".join(raw[x:y] for x, y in zip((w.start[stay] - at).tolist(), (w.end[stay] - at).tolist(), strict=True)))
                else:
                    kept.append(_without(raw, w.start[a:b] - at, mask))
                gone.append(int(mask.sum()))
        give_back()
        texts_out = [hashlib.sha256(k).hexdigest() for k in kept] if digest else [k.decode() for k in kept]
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts_out, pa.string())], ["n_words", "n_removed", "kept"]
        )

    return F.arrow_udf(run, "n_words long, n_removed long, kept string")


_BLANK = bytes(32 if SPACE[b] else b for b in range(256))


def _without(raw: bytes, start: np.ndarray, mask: np.ndarray) -> bytes:
    """The text without the masked words and the white space after each."""
    edge = np.append(start, len(raw)).tolist()
    out = [raw[: edge[0]]]
    out += [raw[edge[i] : edge[i + 1]] for i in np.flatnonzero(~mask).tolist()]
    return b"".join(out)


def dedup(docs: DataFrame, width: int = WIDTH, text: str = "text", digest: bool = False, out: str = "cut") -> DataFrame:
    """``docs`` with a struct ``out``: n_words, n_removed and kept - the text without the removed words
    (white space of the others as it was), or with ``digest`` the SHA-256 of the kept words joined by a blank."""
    rows = _keyed(docs, text)
    # a key is a 64-bit hash: of documents that share one by chance each takes its own runs
    own = F.filter(F.col("runs"), lambda r: r["doc_id"].eqNullSafe(F.col("doc_id")))
    joined = rows.join(_late_windows(rows, width), "key", "left").withColumn("own", F.get(own, F.lit(0)))
    cut = _cut(width, digest)(F.col("text"), F.col("own")["places"])
    columns = [F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns]
    return joined.select(*columns, cut.alias(out))
