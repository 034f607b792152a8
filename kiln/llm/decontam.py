"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark passages.

Normalising lower-cases A-Z and keeps the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`. Windows of ``width``
consecutive words of every item (the whole item where it has fewer) are the automaton's patterns; each text is
scanned once, and match offsets are mapped to word numbers and to byte spans of the original text.

The automaton holds the windows of the benchmark, not of the corpus. Their size is checked: a benchmark of
more than ``block_bytes`` of windows is cut into blocks of items, each scanned by its own automaton, and the
hits of the blocks are merged per document. The driver holds the windows of one block at a time.

Cases: null texts and texts without words hit nothing; null item_ids are left out, repeated items count once;
item_ids shared by different texts are one item with the windows of all; rows of ``docs`` are kept one for
one; an empty benchmark marks every document clean.
"""

from __future__ import annotations

import hashlib
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import WorkerCache, result_name

WIDTH = 10
BLOCK_BYTES = 32 << 20

#: Bytes to normalised bytes: letters and digits (lower-cased), bytes of non-ASCII letters, else a blank.
_NORMAL = bytes(b + 32 if 65 <= b < 91 else b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_NORMAL).split() if text else []


def windows(text: str | None, width: int = WIDTH) -> set[bytes]:
    w = words(text)
    return {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


class Scanner:
    """Automaton over windows; each carries the numbers of the items it comes from."""

    def __init__(self, patterns: list[tuple[bytes, list[str]]]):
        self.automaton = ahocorasick.Automaton()
        for window, items in patterns:
            # byte strings as Latin-1 text, with the blanks that mark word borders
            self.automaton.add_word(" " + window.decode("latin-1") + " ", (len(window), items))
        if patterns:
            self.automaton.make_automaton()
        self.empty = not patterns

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit spans (first word, word after the last; disjoint, sorted) and items."""
        raw = text.encode().translate(_NORMAL) if text else b""
        w = raw.split()
        if not w or self.empty:
            return len(w), [], set()
        line = " " + b" ".join(w).decode("latin-1") + " "
        spans, items = [], set()
        for end, (size, found) in self.automaton.iter(line):
            spans.append((end - size, end))  # of the words, without the blanks
            items.update(found)
        if not spans:
            return len(w), [], items
        blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
        at = np.searchsorted(blanks, np.array(spans)).tolist()
        merged: list[list[int]] = []
        for a, b in sorted((a - 1, b) for a, b in at):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        return len(w), [(a, b) for a, b in merged], items


def byte_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges of the original text for ranges of word numbers."""
    solid = np.frombuffer(text.encode().translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(start[a]), int(end[b - 1])) for a, b in spans]


def _blocks(items: DataFrame, item_id: str, text: str, width: int, block_bytes: int):
    """Windows with their items, in blocks of bounded size: [(window, [item_id, ...]), ...]."""

    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(windows(t, width)) for t in texts.to_pylist()], pa.list_(pa.binary()))

    rows = items.select(F.col(item_id).cast("string").alias("item"), F.explode(F.arrow_udf(cut, "array<binary>")(F.col(text))).alias("w"))
    rows = rows.where("item is not null").groupBy("w").agg(F.array_sort(F.collect_set("item")).alias("items"))
    size = rows.agg(F.sum(F.length("w") + 32 * F.size("items"))).first()[0] or 0
    n = 1 + size // block_bytes
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("w"), F.lit(n)) == k)
        yield [(bytes(r.w), list(r["items"])) for r in part.toLocalIterator()]


_scanners = WorkerCache(4)


def scanner(name: str, sent) -> Scanner:
    """The automaton of a broadcast block of windows, built once in a worker."""
    return _scanners.get(name, lambda: Scanner(sent.value))


def _scan(sent, name: str):
    span = lambda t: pa.list_(pa.struct([("a", t), ("b", t)]))
    shape = pa.struct(
        [("n_words", pa.int64()), ("spans", span(pa.int32())), ("byte_spans", span(pa.int64())), ("items", pa.list_(pa.string()))]
    )

    def run(texts: pa.Array) -> pa.Array:
        scan, rows = scanner(name, sent).scan, []
        for t in texts.to_pylist():
            n, spans, items = scan(t)
            where = byte_spans(t, spans) if spans else []
            pairs = [[{"a": a, "b": b} for a, b in x] for x in (spans, where)]
            rows.append({"n_words": n, "spans": pairs[0], "byte_spans": pairs[1], "items": sorted(items)})
        return pa.array(rows, shape)

    return F.arrow_udf(run, "n_words long, spans array<struct<a:int,b:int>>, byte_spans array<struct<a:long,b:long>>, items array<string>")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    out: str = "hit",
) -> DataFrame:
    """``docs`` with a struct ``out`` (not a name of theirs): n_words, spans (word ranges), byte_spans (of the original) and items."""
    found = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    out = result_name(docs, out)
    parts = []
    for k, patterns in enumerate(_blocks(benchmark, item_id, item_text, width, block_bytes)):
        sent = docs.sparkSession.sparkContext.broadcast(patterns)
        found = found.withColumn(f"hit{k}", _scan(sent, uuid.uuid4().hex)(F.col("text")))
        parts.append(f"hit{k}")
    if len(parts) == 1:
        return found.select("row.*", F.col(parts[0]).alias(out))
    join = lambda f: F.flatten(F.array(*[F.col(p)[f] for p in parts]))
    whole = F.struct(
        F.col(parts[0])["n_words"].alias("n_words"),
        merge_spans(join("spans"), "int").alias("spans"),
        merge_spans(join("byte_spans"), "long").alias("byte_spans"),
        F.array_sort(F.array_distinct(join("items"))).alias("items"),
    )
    return found.select("row.*", whole.alias(out))


def merge_spans(spans, kind: str):
    """Union of spans given in any order, as disjoint sorted spans."""
    none = F.array().cast(f"array<struct<a:{kind},b:{kind}>>")

    def add(acc, s):
        last = F.try_element_at(acc, F.lit(-1))
        grown = F.struct(last["a"].alias("a"), F.greatest(last["b"], s["b"]).alias("b"))
        joins = (F.size(acc) > 0) & (s["a"] <= F.try_element_at(acc, F.lit(-1))["b"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(acc, F.array(s))
        )

    return F.aggregate(F.array_sort(spans), none, add)


def hit_words(hit="hit"):
    """Number of words inside the spans."""
    return F.aggregate(F.col(hit)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])


def items_digest(hit="hit"):
    return F.sha2(F.array_join(F.col(hit)["items"], ","), 256)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
