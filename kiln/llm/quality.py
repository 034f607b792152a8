"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors of its hashed word and character n-grams; a softmax over two
classes reads the average. The vectors and the softmax are trained together by stochastic gradient descent in
numpy, on a bounded sample of labelled rows (``max_docs``). A word is hashed as written, together with the
word before it, and by whether the text has it before; character n-grams are runs of 2 to 4 bytes.

Because averaging and softmax are linear up to the last step, scoring needs one number per hash bucket: a
model is a vector of ``buckets`` floats, of fixed size whatever the corpus, and every text is scored whole.

Cases: null text counts as empty and has the score of the bias alone; without labels of both classes the
score is the share of label 1 (0.5 without any); rows are kept one for one, null and repeated ids included;
labels with a null id or value are left out, repeated labels count once each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import WORD_BASE, Slice, give_back, mix64, owner, result_name, split_words, text_slices, trimmed, window_hash, word_hashes

BUCKETS = 1 << 17
MAX_DOCS = 5000
CHAR_GRAMS = (2, 3, 4)
SLICE = 1 << 19
_U = np.uint64


def feature_groups(s: Slice, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of every feature of a slice, one kind of feature after the other."""

    def bucket(h: np.ndarray) -> np.ndarray:
        return ((h >> _U(20)) & _U(buckets - 1)).astype(np.int32)

    w = split_words(s)
    h = word_hashes(s.buf, w)
    if len(h):
        doc = owner(w.first).astype(np.int32)
        yield doc, bucket(h)
        inside = doc[1:] == doc[:-1]
        yield doc[1:][inside], bucket(window_hash(h, 2, WORD_BASE)[inside])
        yield doc[1:][inside], bucket(mix64(np.where(h[1:] == h[:-1], _U(0x5EED), _U(0xFEED)))[inside])
        order = np.lexsort((h, doc))
        seen = np.zeros(len(h), np.uint64)
        seen[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        yield doc, bucket(mix64(seen + _U(0xABCD)))
    chars = s.buf.astype(np.uint64)
    text = np.repeat(np.arange(s.rows, dtype=np.int32), np.diff(s.off))
    for n in CHAR_GRAMS:
        if len(chars) < n:
            continue
        m = len(chars) - n + 1
        x = np.full(m, n, np.uint64)
        for j in range(n):
            x = x << _U(8) | chars[j : j + m]
        inside = text[:m] == text[n - 1 :]
        yield text[:m][inside], bucket(mix64(x)[inside])


def features(s: Slice, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    groups = list(feature_groups(s, buckets))
    none = np.zeros(0, np.int32)
    return np.concatenate([none, *(r for r, _ in groups)]), np.concatenate([none, *(f for _, f in groups)])


class Model(NamedTuple):
    weight: np.ndarray  # per bucket: what its vector adds to the log-odds of label 1
    bias: float

    def scores(self, col: pa.Array) -> np.ndarray:
        out = np.full(len(col), self.bias)
        for s in text_slices(col, SLICE):
            n, total = np.zeros(s.rows, np.int64), np.zeros(s.rows)
            for row, f in feature_groups(s, len(self.weight)):
                n += np.bincount(row, minlength=s.rows)
                total += np.bincount(row, weights=self.weight[f], minlength=s.rows)
            out[s.first : s.first + s.rows] += total / np.maximum(n, 1)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def labelled(docs: DataFrame, labels: DataFrame, label: str, max_docs: int) -> DataFrame:
    """At most ``max_docs`` rows (doc_id, text, y) of labelled documents, repeats counted once: the ids first by their
    hash, then the rows first by the hash of id, text and label."""
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("y"))
    ids = ids.distinct().orderBy(F.xxhash64("doc_id", "y"), "doc_id", "y").limit(max_docs)
    # the id list is bounded by max_docs, so it may be broadcast
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y").distinct()
    # an id may have many texts, so the rows are bounded too
    return rows.orderBy(F.xxhash64("doc_id", "text", "y"), "doc_id", "y", "text").limit(max_docs)


def _shares(buckets: int):
    """Distinct buckets of a text with their shares of its features: int32 numbers, then float16 shares."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for s in text_slices(texts, SLICE):
            row, f = features(s, buckets)
            key, n = np.unique(row.astype(np.int64) * buckets + f, return_counts=True)
            at = np.searchsorted(key, np.arange(s.rows + 1) * buckets)
            for a, b in zip(at[:-1], at[1:], strict=True):
                # times 1024: small shares stay exact enough in half precision
                share = 1024 * n[a:b] / max(1, n[a:b].sum())
                out.append((key[a:b] % buckets).astype(np.int32).tobytes() + share.astype(np.float16).tobytes())
        return pa.array(out, pa.binary())

    return F.arrow_udf(run, "binary")


def fit(rows: list[tuple], buckets: int, dim: int, epochs: int, rate: float, seed: int) -> Model:
    """Stochastic gradient descent over rows (label, buckets, shares)."""
    ones = sum(y for y, _, _ in rows)
    if not 0 < ones < len(rows):
        share = (ones + 0.5) / (len(rows) + 1)
        return Model(np.zeros(buckets), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    top = rng.uniform(-1 / dim, 1 / dim, (2, dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    # steps are scaled by the squared gradients so far (one number per bucket)
    seen, seen_top = np.full(buckets, 1e-8, np.float32), 1e-8
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, f, share = rows[i]
            share = share.astype(np.float32) / 1024
            x = share @ vec[f] if len(f) else np.zeros(dim, np.float32)
            z = top @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            err = p.astype(np.float32)
            err[y] -= 1
            back = top.T @ err
            seen[f] += (share * share) * float(back @ back)
            vec[f] -= (rate * share / np.sqrt(seen[f]))[:, None] * back
            grad = np.outer(err, x)
            seen_top += float((grad * grad).sum())
            top -= rate * grad / np.sqrt(seen_top)
            bias -= 0.01 * err
    return Model(vec @ (top[1] - top[0]), float(bias[1] - bias[0]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_docs: int = MAX_DOCS,
    buckets: int = BUCKETS,
    dim: int = 8,
    epochs: int = 6,
    rate: float = 0.3,
    seed: int = 7,
) -> Model:
    """Fits the vectors and the softmax on at most ``max_docs`` labelled documents. One task trains: what it holds
    (about 16 KB a document) is bounded by max_docs, not by the corpus; the driver gets the model alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for b in batches:
            for d, y, f in zip(*(b.column(c).to_pylist() for c in ("doc_id", "y", "f")), strict=True):
                k = len(f) // 6
                rows.append((str(d), y, hashlib.md5(f).digest(), np.frombuffer(f, np.int32, k), np.frombuffer(f, np.float16, k, 4 * k)))
        rows.sort(key=lambda r: r[:3])
        model = fit([(r[1], r[3], r[4]) for r in rows], buckets, dim, epochs, rate, seed)
        yield pa.RecordBatch.from_arrays([pa.array([model.weight.astype(np.float64).tobytes()], pa.binary()), pa.array([model.bias])], names=["weight", "bias"])

    sample = labelled(docs, labels, label, max_docs).select("doc_id", F.col("y").cast("int").alias("y"), _shares(buckets)(F.col("text")).alias("f"))
    got = sample.repartition(1).mapInArrow(trimmed(run), "weight binary, bias double").first()
    if got is None:  # Spark knows that there is no labelled row
        return Model(np.zeros(buckets), 0.0)
    return Model(np.frombuffer(got.weight, np.float64), got.bias)


def score(model: Model, text: str = "text") -> Column:
    def run(texts: pa.Array) -> pa.Array:
        scores = model.scores(texts)
        give_back()
        return pa.array(scores, pa.float64())

    return F.arrow_udf(run, "double")(F.col(text))


def classify(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text", out: str = "quality") -> DataFrame:
    """``docs`` with a struct ``out`` (not a name of theirs): score (0 to 1) and predicted (1 from ``threshold`` on)."""
    scored = docs.withColumn(result_name(docs, out), score(model, text))
    return scored.withColumn(out, F.struct(F.col(out).alias("score"), (F.col(out) >= threshold).cast("int").alias("predicted")))
