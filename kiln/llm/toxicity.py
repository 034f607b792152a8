"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps words to symbols (insult, threat, target, negation, report, quote mark, clause end,
other). Three small transducers read the symbols: one remembers a target of the clause, one a negation within
the last three words, one reported speech (a reporting verb or an open quotation). Their composition is one
machine whose states are triples; when it meets an insult or threat it emits a pattern such as
``insult+target`` or ``insult+negated``, and clauses that never meet one emit nothing. A document's features
are the weighted numbers of matched patterns, so a word counts by the clause it stands in, and the weight of
each pattern (negated or reported ones too) is learned.

The insult and threat lexicon starts from a short seed list and learns words and word beginnings that labelled
toxic documents have and clean ones haven't, from a bounded sample of labelled rows (``max_docs``); the
pattern weights are a logistic regression on the same rows.

Cases: null text counts as empty (no pattern, score of the bias); without labels of both classes the seed
lexicon keeps unit weights; rows are kept one for one, null and repeated ids included; labels with a null id
or value are left out.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.quality import labelled

MAX_DOCS = 8000
MAX_LEXICON = 4000
#: A unit enters the lexicon if so many toxic sample documents have it (at least that share of them too), and
#: this share of all documents that have it is toxic.
MIN_DOCS, MIN_PART, MIN_SHARE = 4, 0.015, 0.9
PREFIXES = range(3, 8)
#: Words remembered by one worker.
MEMORY = 150_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, END = range(8)
#: Public everyday words of the symbols (English, German, French, Spanish).
SEED = {
    INSULT: "idiot idiots moron morons stupid loser losers scum trash pathetic worthless disgusting clown dumb",
    THREAT: "kill hurt destroy shoot murder",
    TARGET: "you your yours yourself they them he she him her dich du dir ihr euch tu te toi vous tú usted vosotros",
    NEGATION: "not no never none nobody n't nicht kein keine nie ne pas jamais aucun nunca ningún jamás",
    REPORT: "said says say claimed claims reported reports quoted wrote writes called sagte dit dijo",
}
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_END = re.compile(r"[.!?;:]+[\"'”»)]*$")


class Transducer(NamedTuple):
    """Deterministic: state x symbol -> state; ``tag`` is what a state adds to a pattern emitted from it."""

    next: list[list[int]]
    tag: list[str]


def _machine(states: int, tag: list[str], moves: dict[int, list[int]]) -> Transducer:
    stay = list(range(states))
    return Transducer([[moves.get(symbol, stay)[s] for symbol in range(8)] for s in range(states)], tag)


def target_machine() -> Transducer:
    return _machine(2, ["", "target"], {TARGET: [1, 1], END: [0, 0]})


def negation_machine(reach: int = 3) -> Transducer:
    """State k: a negation stands so many more words away at most."""
    fade = [max(0, k - 1) for k in range(reach + 1)]
    moves = {s: fade for s in (OTHER, INSULT, THREAT, TARGET, REPORT)}
    return _machine(reach + 1, [""] + ["negated"] * reach, moves | {NEGATION: [reach] * (reach + 1), END: [0] * (reach + 1)})


def report_machine() -> Transducer:
    """0 plain, 1 after a reporting verb (until the clause ends), 2 inside a quotation that followed one."""
    return _machine(3, ["", "reported", "reported"], {REPORT: [1, 1, 2], QUOTE: [0, 2, 0], END: [0, 0, 2]})


class Composed(NamedTuple):
    """Product of transducers: next[state][symbol], and the pattern an insult or threat emits in that state."""

    next: list[list[int]]
    pattern: list[list[int]]
    names: list[str]


def compose(*machines: Transducer) -> Composed:
    states = list(itertools.product(*(range(len(m.next)) for m in machines)))
    number = {s: i for i, s in enumerate(states)}
    names: list[str] = []
    move, pattern = [], []
    for s in states:
        move.append([number[tuple(m.next[q][a] for m, q in zip(machines, s, strict=True))] for a in range(8)])
        tags = [t for m, q in zip(machines, s, strict=True) if (t := m.tag[q])]
        row = []
        for kind in ("insult", "threat"):
            name = "+".join([kind, *tags])
            if name not in names:
                names.append(name)
            row.append(names.index(name))
        pattern.append(row)
    return Composed(move, pattern, names)


GRAMMAR = compose(target_machine(), negation_machine(), report_machine())
WIDTH = len(GRAMMAR.names)


class Lexicon:
    """Word -> (symbol, weight): whole words first, then the longest known beginning."""

    def __init__(self, words: dict[str, tuple[int, float]], starts: dict[str, float]):
        self.words, self.starts = words, starts
        self.lengths = sorted({len(s) for s in starts}, reverse=True)
        self.known: dict[str, tuple | None] = {}

    def of(self, token: str) -> tuple | None:
        """Symbols of a token between blanks, None if it is a plain word: ((symbol, weight), ...)."""
        out, plain = [], True
        for k, w in enumerate(_WORD.findall(token)):
            found = self.words.get(w)
            if found is None:
                n = next((n for n in self.lengths if len(w) > n and w[:n] in self.starts), 0)
                found = (INSULT, self.starts[w[:n]]) if n else (OTHER, 0.0)
            out.append(found)
            plain = plain and found[0] == OTHER and k == 0
        if token[:1] in "\"“«„":
            out.insert(0, (QUOTE, 0.0))
            plain = False
        ends = _END.search(token)
        if ends:
            out.append((END, 0.0))
        if token[-1:] in "\"”»":
            out.append((QUOTE, 0.0))
            plain = False
        return None if plain and not ends else tuple(out)


def read(text: str | None, lexicon: Lexicon, grammar: Composed = GRAMMAR) -> np.ndarray:
    """Weighted numbers of the patterns matched in a whole text."""
    out = np.zeros(WIDTH)
    if not text:
        return out
    known, state = lexicon.known, 0
    if len(known) > MEMORY:
        known.clear()
    move = grammar.next
    for token in text.lower().split():
        try:
            symbols = known[token]
        except KeyError:
            symbols = lexicon.of(token)
            if len(token) < 60:
                known[token] = symbols
        if symbols is None:
            state = move[state][OTHER]
            continue
        for symbol, weight in symbols:
            if symbol == INSULT or symbol == THREAT:
                out[grammar.pattern[state][symbol - INSULT]] += weight
            state = move[state][symbol]
    return out


class Model(NamedTuple):
    lexicon: Lexicon
    weight: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = float(np.log1p(read(text, self.lexicon)) @ self.weight + self.bias)
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


class Unit(NamedTuple):
    text: str
    start: bool  # a beginning of words, else a whole word
    bad: tuple[int, int]  # toxic documents that have it, by half of the sample; a beginning counts once a word
    good: tuple[int, int]  # the same of clean documents


def _half() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(2))


def _learn_units(sample: DataFrame, max_lexicon: int) -> list[Unit]:
    """Words and beginnings with their document counts: counted by Spark, the best kept."""

    def units(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            words = set(_WORD.findall((t or "").lower()))
            starts = [w[:n] for w in words for n in PREFIXES if len(w) > n]
            out.append([*words, *("^" + s for s in starts)])
        return pa.array(out, pa.list_(pa.string()))

    rows = sample.select("y", _half().alias("h"), F.explode(F.arrow_udf(units, "array<string>")(F.col("text"))).alias("unit"))
    sums = [F.sum(F.when((F.col("y") == y) & (F.col("h") == h), 1).otherwise(0)).alias(f"n{y}{h}") for y in (1, 0) for h in (0, 1)]
    n = rows.groupBy("unit").agg(*sums).withColumn("bad", F.expr("n10 + n11")).withColumn("good", F.expr("n00 + n01"))
    toxic = sample.agg(F.sum("y")).first()[0] or 0
    best = n.where((F.col("bad") >= max(MIN_DOCS, MIN_PART * toxic)) & (F.col("bad") >= MIN_SHARE * (F.col("bad") + F.col("good"))))
    best = best.orderBy(F.desc("bad"), "good", "unit").limit(max_lexicon)
    return [Unit(r.unit.removeprefix("^"), r.unit[0] == "^", (r.n10, r.n11), (r.n00, r.n01)) for r in best.collect()]


def build_lexicon(units: list[Unit], halves: tuple[int, ...] = (0, 1)) -> Lexicon:
    """Lexicon from the counts of the given halves of the sample."""
    words = {w: (kind, 1.0) for kind, names in SEED.items() for w in names.split()}
    counts = {(u.text, u.start): (sum(u.bad[h] for h in halves), sum(u.good[h] for h in halves)) for u in units}
    least = MIN_DOCS * len(halves) / 2
    found = {k: (bad, good) for k, (bad, good) in counts.items() if bad >= max(least, MIN_SHARE * (bad + good))}
    starts: dict[str, float] = {}
    for (u, start), (bad, good) in found.items():
        weight = float(np.log((bad + 0.5) / (good + 0.5)))
        if not start:
            words[u] = (INSULT, weight)
            continue
        # of nested beginnings with nearly the same documents the longest is the stem
        longer = [b for (v, s), (b, _) in found.items() if s and len(v) == len(u) + 1 and v.startswith(u)]
        if max(longer, default=0) < 0.95 * bad:
            starts[u] = weight
    # a beginning that is only the beginning of one known word adds nothing
    for u in [u for u in starts if any(w.startswith(u) and found.get((w, False), (0,))[0] >= 0.9 * found[u, True][0] for w in words)]:
        del starts[u]
    return Lexicon(words, starts)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = MAX_DOCS, max_lexicon: int = MAX_LEXICON) -> Model:
    """Learns the lexicon and the pattern weights from at most ``max_docs`` labelled documents."""
    sample = labelled(docs, labels, label, max_docs)
    units = _learn_units(sample, max_lexicon)
    # pattern weights come from rows read with the lexicon of the other half, so chance entries earn no trust
    other = [(x.words, x.starts) for x in (build_lexicon(units, (1,)), build_lexicon(units, (0,)))]

    def run(texts: pa.Array, half: pa.Array) -> pa.Array:
        lex = [Lexicon(*x) for x in other]
        rows = zip(texts.to_pylist(), half.to_pylist(), strict=True)
        return pa.array([read(t, lex[h]).tolist() for t, h in rows], pa.list_(pa.float64()))

    found = sample.select("y", F.arrow_udf(run, "array<double>")(F.col("text"), _half()).alias("f"))
    return fit(build_lexicon(units), Counter({(r.y, tuple(r.f)): r["count"] for r in found.groupBy("y", "f").count().collect()}))


def fit(lexicon: Lexicon, counts: Counter, ridge: float = 1.0, rounds: int = 30) -> Model:
    """Logistic regression by Newton steps on counted (label, features) pairs; unit weights without both labels."""
    rows = sorted(counts)
    if len({y for y, _ in rows}) < 2:
        return Model(lexicon, np.ones(WIDTH), -2.0)
    x = np.column_stack([np.log1p(np.array([f for _, f in rows])), np.ones(len(rows))])
    y = np.array([y for y, _ in rows], float)
    n = np.array([counts[r] for r in rows], float)
    # weights are drawn towards 1 (a matched clause is a sign of toxicity) where the labels say little
    prior, pull = np.append(np.ones(WIDTH), 0.0), np.append(np.full(WIDTH, ridge), 1e-3)
    w = prior.copy()
    w[-1] = -2
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + pull * (w - prior)
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Model(lexicon, w[:-1], float(w[-1]))


_lexicons: dict[str, Lexicon] = {}


def kept_lexicon(name: str, words: dict, starts: dict) -> Lexicon:
    """The lexicon of a model with the words it has met, kept between the tasks of a worker."""
    if name not in _lexicons:
        _lexicons.clear()
        _lexicons[name] = Lexicon(words, starts)
    return _lexicons[name]


def score(model: Model, text: str = "text") -> Column:
    words, starts, weight, bias = model.lexicon.words, model.lexicon.starts, model.weight, model.bias
    name = uuid.uuid4().hex

    def run(texts: pa.Array) -> pa.Array:
        m = Model(kept_lexicon(name, words, starts), weight, bias)
        return pa.array([m.score(t) for t in texts.to_pylist()], pa.float64())

    return F.arrow_udf(run, "double")(F.col(text))


def classify(docs: DataFrame, model: Model, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    return docs.withColumn("score", score(model, text)).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
