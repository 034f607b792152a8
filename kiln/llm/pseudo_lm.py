"""Language-model scoring by masked pseudo-likelihood.

Every word of a text is predicted from the words on both sides of it, and the conditional log-probabilities are
summed. A word has a hash bucket, a bucket belongs to a class: one of the most frequent buckets of the corpus,
or a class of words with the same ending. P(word | context) = P(class | context) P(word | class): a network
with one hidden layer over vectors of the two words on either side gives the first factor, the word counts of
the whole corpus the second.

Counts: ``word_counts`` is a table of every word (64-bit hash) with its exact count, as large as the vocabulary;
for scoring it is joined to the distinct words of each chunk of texts. Sums of buckets (for the classes) are
added up by Spark over all documents. Network: each partition
trains a copy by stochastic gradient descent in numpy over its documents (every word of every document is a
target, in batches of ``BATCH``), and the copies are averaged, weighted by their targets. Bucket sums and network have a fixed size (some MB), whatever the corpus: words that
share a bucket share class and context vector, but not their counts.

Cases: null texts and texts without words have 0 words, sum 0 and a null mean; rows are kept one for one, null
and repeated ids included; an empty corpus gives a uniform model.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.common import LOWER, Slice, as_signed, free_name, mix64, result_name, split_words, stored, text_slices, word_hashes

CLASSES, FREQUENT, ENDINGS = 64, 32, 32
BUCKETS = 1 << 18
TABLE, HIDDEN = 1 << 13, 16
CONTEXT = (-2, -1, 1, 2)
BATCH, RATE = 512, 0.5
#: Bytes of text that share one list of word counts when they are scored; words folded at once when counted.
CHUNK, FOLD = 8 << 20, 1 << 19
#: Rows of one matrix product: so small a product stays in the task's own thread.
BLOCK = 256
_U = np.uint64


def hashes(s: Slice) -> np.ndarray:
    """64-bit hashes of all words of a slice, in lower case."""
    s = s._replace(buf=LOWER[s.buf])
    return word_hashes(s.buf, split_words(s))


def word_buckets(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words of a slice, and rows + 1 offsets; a bucket's high bits are the word's ending."""
    return hashed_buckets(s)[1:]


def hashed_buckets(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and buckets of all words of a slice, and rows + 1 offsets."""
    s = s._replace(buf=LOWER[s.buf])
    w = split_words(s)
    h = word_hashes(s.buf, w)
    last = s.buf[w.end - 1].astype(np.uint64) if len(h) else np.zeros(0, np.uint64)
    before = np.where(w.end - w.start > 1, s.buf[np.maximum(w.end - 2, 0)], 0).astype(np.uint64) if len(h) else last
    # the sizes are powers of two, so a mask takes the remainder
    ending = mix64(last << _U(8) | before) & _U(ENDINGS - 1)
    size = BUCKETS // ENDINGS
    return h, (ending * _U(size) + (h & _U(size - 1))).astype(np.int64), w.first


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for s in text_slices(b.column("text")):
            total += np.bincount(word_buckets(s)[0], minlength=BUCKETS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])


class Corpus(NamedTuple):
    cls: np.ndarray  # class of each bucket
    inside: np.ndarray  # log P(bucket | class)
    prior: np.ndarray  # log P(class)
    size: np.ndarray  # log of the words of each class


def corpus_counts(docs: DataFrame) -> Corpus:
    """Word statistics of all documents: at most ``BUCKETS`` sums reach the driver."""
    got = docs.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.ones(BUCKETS)  # one of each, so that no word is impossible
    n[got["bucket"].to_numpy(np.int64)] += got["n"].to_numpy()
    cls = FREQUENT + np.arange(BUCKETS) // (BUCKETS // ENDINGS)
    top = np.argsort(-n, kind="stable")[:FREQUENT]
    cls[top] = np.arange(FREQUENT)
    of_class = np.bincount(cls, weights=n, minlength=CLASSES) + 1e-9
    prior = np.log(of_class / of_class.sum()).astype(np.float32)
    return Corpus(cls, np.log(n / of_class[cls]).astype(np.float32), prior, np.log(of_class).astype(np.float32))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their numbers, repeats folded run by run."""

    def folded() -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([as_signed(word), pa.array(n)], names=["word", "n"])

    held, size = [], 0
    for b in batches:
        for s in text_slices(b.column("text")):
            held.append(hashes(s))
            size += len(held[-1])
            if size > FOLD:
                yield folded()
                held, size = [], 0
    if size:
        yield folded()


def word_counts(docs: DataFrame) -> DataFrame:
    """Exact count of every word (64-bit hash) of all documents, as a table."""
    return stored(docs.select("text").mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), b.shape[1]), np.float32)
    for i in range(0, len(a), BLOCK):
        np.matmul(a[i : i + BLOCK], b, out=out[i : i + BLOCK])
    return out


class Network(NamedTuple):
    vec: np.ndarray  # [position, table row, hidden]; row TABLE stands for a place outside the text
    top: np.ndarray  # [hidden, class]
    bias: np.ndarray

    def hidden(self, ctx: np.ndarray) -> np.ndarray:
        h = self.vec[0].take(ctx[0], 0)
        for k in range(1, len(CONTEXT)):
            h += self.vec[k].take(ctx[k], 0)
        return np.tanh(h, out=h)

    def log_probs(self, ctx: np.ndarray, cls: np.ndarray) -> np.ndarray:
        z = product(self.hidden(ctx), self.top)
        z += self.bias
        z -= z.max(1, keepdims=True)
        of = z[np.arange(len(cls)), cls]
        return of - np.log(np.exp(z, out=z).sum(1))

    def copy(self) -> Network:
        """Arrays of its own, of numpy's own number type: those that come out of a broadcast carry a copy of the
        type, and ``np.add.at`` is some ten times slower on them."""
        return Network(*(x.astype(np.float32) for x in self))


def start_network(corpus: Corpus, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    vec = rng.normal(0, 0.1, (len(CONTEXT), TABLE + 1, HIDDEN)).astype(np.float32)
    top = rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32)
    return Network(vec, top, corpus.prior.copy())


def contexts(buckets: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Table rows of the words around the given words, one array for each context position."""
    rows = (mix64(buckets.astype(np.uint64)) & _U(TABLE - 1)).astype(np.int32)
    doc = np.searchsorted(first, at, "right") - 1
    out = np.full((len(CONTEXT), len(at)), TABLE, np.int32)
    for k, d in enumerate(CONTEXT):
        p = at + d
        fine = (p >= first[doc]) & (p < first[doc + 1])
        out[k, fine] = rows[p[fine]]
    return out


def step(net: Network, ctx: np.ndarray, cls: np.ndarray, rate: float) -> None:
    """One step of gradient descent, in place."""
    h = net.hidden(ctx)
    p = product(h, net.top)
    p += net.bias
    p -= p.max(1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(cls)), cls] -= 1
    back = product(p, net.top.T)
    net.top[:] -= rate / len(cls) * sum(h[i : i + BLOCK].T @ p[i : i + BLOCK] for i in range(0, len(cls), BLOCK))
    net.bias[:] -= rate / len(cls) * p.sum(0)
    np.multiply(h, h, out=h)
    back *= np.subtract(1, h, out=h)
    # words are met a few times a batch, so their steps aren't divided by its size
    back *= -0.1 * rate
    back = back.ravel()
    unit = np.arange(HIDDEN)
    for k in range(len(CONTEXT)):
        # flat indices: numpy adds them faster than rows
        np.add.at(net.vec[k].reshape(-1), ((ctx[k].astype(np.int64) * HIDDEN)[:, None] + unit).ravel(), back)


def _train(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, net = sent.value
        net = net.copy()
        seen = 0
        for b in batches:
            for s in text_slices(b.column("text")):
                buckets, first = word_buckets(s)
                if not len(buckets):
                    continue
                ctx = contexts(buckets, first, np.arange(len(buckets)))
                cls = corpus.cls[buckets]
                for i in range(0, len(buckets), BATCH):
                    step(net, ctx[:, i : i + BATCH], cls[i : i + BATCH], RATE)
                seen += len(buckets)
        if seen:
            flat = np.concatenate([x.ravel() for x in net])
            part = np.array_split(flat * seen, 16)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(16), pa.int32()), pa.array([float(seen)] * 16), pa.array([x.astype(np.float32).tobytes() for x in part], pa.binary())],
                names=["part", "seen", "sum"],
            )

    return run, "part int, seen double, sum binary"


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up copies of the network part by part; a task holds one sum for each of its parts."""
    total: dict[int, list] = {}
    for b in batches:
        for part, seen, raw in zip(*(b.column(c).to_pylist() for c in ("part", "seen", "sum")), strict=True):
            x = np.frombuffer(raw, np.float32).astype(np.float64)
            old = total.get(part)
            total[part] = [seen, x] if old is None else [old[0] + seen, old[1] + x]
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x[0] for x in total.values()], pa.float64()), pa.array([x[1].astype(np.float32).tobytes() for x in total.values()], pa.binary())],
        names=["part", "seen", "sum"],
    )


def train(docs: DataFrame, seed: int = 11) -> tuple[Corpus, Network]:
    """Counts and network from all documents; one averaged network (some MB) reaches the driver."""
    corpus = corpus_counts(docs)
    net = start_network(corpus, seed)
    sent = docs.sparkSession.sparkContext.broadcast((corpus, net))
    run, kind = _train(sent)
    copies = docs.select("text").mapInArrow(run, kind)
    got = {r.part: r for r in copies.repartition(16, "part").mapInArrow(_add, kind).collect()}
    if got:
        flat = np.concatenate([np.frombuffer(got[k]["sum"], np.float32) / got[k].seen for k in range(16)])
        cut = np.cumsum([net.vec.size, net.top.size])
        vec, top, bias = np.split(flat.astype(np.float32), cut)
        net = Network(vec.reshape(net.vec.shape), top.reshape(net.top.shape), bias)
    return corpus, net


def score_slice(s: Slice, corpus: Corpus, net: Network, counts: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed conditional log-probabilities of each text of a slice; ``counts`` are the words of the
    slice in ascending order with the logarithms of their counts, without them the bucket sums count."""
    h, buckets, first = hashed_buckets(s)
    logs, cls = np.empty(len(buckets)), corpus.cls[buckets]
    ctx = contexts(buckets, first, np.arange(len(buckets)))
    for i in range(0, len(buckets), BATCH):
        logs[i : i + BATCH] = net.log_probs(ctx[:, i : i + BATCH], cls[i : i + BATCH])
    if counts is None:
        logs += corpus.inside[buckets]
    else:
        logs += counts[1][np.searchsorted(counts[0], h)] - corpus.size[cls]
    total = np.concatenate([[0.0], np.cumsum(logs)])
    return np.diff(first), total[first[1:]] - total[first[:-1]]


_models: dict[str, tuple[Corpus, Network]] = {}


def kept_model(name: str, sent) -> tuple[Corpus, Network]:
    if name not in _models:
        _models.clear()
        corpus, net = sent.value
        _models[name] = corpus, net.copy()
    return _models[name]


def _chunks(text: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers runs of rows of about ``CHUNK`` bytes of text."""
        chunk, size = uuid.uuid4().int >> 65, 0
        for b in batches:
            of = np.empty(b.num_rows, np.int64)
            for s in text_slices(b.column(text)):
                if size and size + len(s.buf) > CHUNK:
                    chunk, size = uuid.uuid4().int >> 65, 0
                of[s.first : s.first + s.rows] = chunk
                # a row counts too, so that many rows without text are cut as well
                size += len(s.buf) + 64 * s.rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of)], names=[*b.schema.names, name])

    return run


def _chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each chunk; a chunk whose rows lie in two tasks lists a word twice."""

    def listed() -> pa.RecordBatch:
        word = np.unique(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(word), chunk)), as_signed(word)], names=["_chunk", "word"])

    held, chunk = [], None
    for b in batches:
        of = b.column("_chunk").to_numpy()
        cut = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)] if len(of) else [0]
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            if held and of[a] != chunk:
                yield listed()
                held = []
            chunk = of[a]
            held += [np.unique(hashes(s)) for s in text_slices(b.column("text").slice(a, z - a))]
    if held:
        yield listed()


def _score_table(table: pa.Array, model: tuple[Corpus, Network], counts=None) -> pa.StructArray:
    n, total = np.zeros(len(table), np.int64), np.zeros(len(table))
    for s in text_slices(table):
        a, b = score_slice(s, *model, counts)
        n[s.first : s.first + s.rows], total[s.first : s.first + s.rows] = a, b
    mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
    return pa.StructArray.from_arrays([pa.array(n), pa.array(total), mean], ["n_words", "log_prob", "mean_log_prob"])


KIND = "n_words long, log_prob double, mean_log_prob double"


def score(docs: DataFrame, corpus: Corpus, net: Network, text: str = "text", out: str = "lm", words: DataFrame | None = None) -> DataFrame:
    """``docs`` with a struct ``out`` (not a name of theirs): n_words, log_prob (summed) and mean_log_prob (a word; null without any).

    ``words`` is the table of ``word_counts``: with it P(word | class) comes from exact counts (a word that the
    corpus hasn't counts as met once), without it from the sums of the hash buckets."""
    sent, name = docs.sparkSession.sparkContext.broadcast((corpus, net)), uuid.uuid4().hex
    out, own = result_name(docs, out), free_name(docs, "_chunk")
    if words is None:
        return docs.withColumn(out, F.arrow_udf(lambda texts: _score_table(texts, kept_model(name, sent)), KIND)(F.col(text)))
    kind = T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())])
    placed = stored(docs.mapInArrow(_chunks(text, own), kind))
    listed = placed.select(F.col(own).alias("_chunk"), F.col(text).alias("text")).mapInArrow(_chunk_words, "_chunk long, word long")
    # written as a table, so that the join's shuffles don't stay on disk beside those of the texts
    listed = stored(listed.join(words, "word", "left").select("_chunk", "word", F.coalesce("n", F.lit(1)).alias("n")))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        word = left.column("word").to_numpy().view(np.uint64)
        order = np.argsort(word)
        texts = right.column(text).combine_chunks()
        lm = _score_table(texts, kept_model(name, sent), (word[order], np.log(left.column("n").to_numpy()[order])))
        return right.drop_columns(own).append_column(out, lm)

    kind = T.StructType([*docs.schema.fields, T.StructField(out, T.StructType.fromDDL(KIND))])
    return listed.groupBy("_chunk").cogroup(placed.groupBy(own)).applyInArrow(run, kind)
