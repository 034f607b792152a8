"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a pre-token there is one token that the merge procedure leaves last. An automaton over the
vocabulary gives all tokens that are suffixes of the prefix; a suffix t is that last token if the last token
of the rest stays separate from t, which a test on the two tokens alone decides (``compatible``). Following
the stored last tokens backwards gives exactly the ids of the merge procedure, in time linear in the text.
The pre-tokens of many texts that aren't remembered take these steps together, one byte of each at a time; they
are cut where the classes of characters change.

Cases: null text counts as empty (no ids, empty decoded text); a special token's string in the text becomes
that token, as the library does by default; rows are kept one for one, repeated and null ids included; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import WorkerCache

#: Fixed value: the pattern by which byte-level vocabularies split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens in each of a worker's two generations of memory, and token pairs remembered (beyond that afresh).
MEMORY = 100_000
#: Pre-tokens of texts that are looked up together, new ones from which they are encoded together, and bits of a pair's place.
TOGETHER, FEW, PLACES = 50_000, 32, 20
#: Bytes of the states whose next states are all tabled: a table of every state would take 100 MB a worker.
NEAR = 2
#: Characters from which a pre-token isn't remembered.
LONG = 100


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand
    for themselves, the others are numbered upwards from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


def char_classes() -> np.ndarray:
    """Class of every character that ``SPLIT`` tells apart: 1 letter, 2 number, 3 space, 0 other."""
    every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    out = np.zeros(len(every), np.uint8)
    for k, kind in enumerate((r"\p{L}+", r"\p{N}+", r"\s+"), 1):
        for m in regex.finditer(kind, every):
            out[m.start() : m.end()] = k
    return out


def pre_tokens(text: str, classes: np.ndarray) -> list[str]:
    """What ``SPLIT`` finds in a text, from the places where the class of the characters changes."""
    if not text:
        return []
    char = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = classes[char]
    start = np.ones(len(char), bool)
    start[1:] = kind[1:] != kind[:-1]
    # the last space before something else stands alone, and a plain one joins what follows
    last = (kind[:-1] == 3) & start[1:]
    start[:-1] |= last
    start[1:] &= ~(last & (char[:-1] == 32))
    for i in np.flatnonzero((char[:-1] == 39) & start[:-1] & (kind[1:] == 1)).tolist():
        end = i + 2 if text[i + 1] in "stmd" else i + 3 if text[i + 1 : i + 3] in ("re", "ve", "ll") else 0
        if end:
            start[i + 1] = False
            start[end : end + 1] = True
    at = np.flatnonzero(start).tolist()
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)], strict=True)]


class PrefixBpe:
    """Encoder and decoder for a byte-level BPE file of the `tokenizers` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre["use_regex"]:
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        self.letter = {b: c for b, c in enumerate(letters)}
        raw = self.letter_byte = {c: b for b, c in enumerate(letters)}
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        # merge that makes each token: when it happens, and its two halves
        self.when, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merge[x << 32 | y] = rank
            if self.left[made] < 0:
                self.when[made], self.left[made], self.right[made] = rank, x, y
        self.text = [b""] * size
        # tokens that are made from their own bytes
        made = {}
        for t, i in vocab.items():
            self.text[i] = bytes(raw[c] for c in t)
            if self.left[i] < 0 or self._reachable(i):
                made[self.text[i]] = i
        self._automaton(made)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.special.items():
            self.text[i] = bytes(raw[c] for c in t) if all(c in raw for c in t) else t.encode()
        names = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.classes = char_classes()
        # pre-tokens met lately, and those of the generation before: what is met again moves up, the rest is dropped
        self.ids_of: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.steps: dict[str, tuple[str, tuple[tuple[int, int], ...]]] = {}

    def _automaton(self, made: dict[bytes, int]) -> None:
        """States are the beginnings of tokens; the state of a prefix is its longest end that is one.

        ``near``: next state by state and byte, for the states of up to two bytes; ``links``: (state, byte) of longer
        beginnings, sorted, with their states in ``to``; ``shorter``: the longest end of a state that is another one;
        ``end``: the longest end of a state that is a token, as a state; ``down``: the next shorter one of a token;
        ``token`` and ``depth``: of a token's state its id, of any its bytes.
        """
        states = sorted({t[:k] for t in made for k in range(len(t) + 1)}, key=len)
        number = {t: i for i, t in enumerate(states)}
        parent = np.array([0, *(number[t[:-1]] for t in states[1:])])
        byte = np.array([0, *(t[-1] for t in states[1:])])
        self.token = np.array([made.get(t, -1) for t in states])
        self.depth = np.array([len(t) for t in states])
        shorter = self.shorter = np.zeros(len(states), np.int64)
        key = parent << 8 | byte
        key[0] = 1 << 40  # the empty beginning, and what is looked up in vain
        self.to = np.argsort(key)
        self.links = key[self.to]
        self.near = np.zeros((np.searchsorted(self.depth, NEAR, "right"), 256), np.int32)
        self.end = np.where(self.token >= 0, np.arange(len(states)), 0)
        cuts = np.searchsorted(self.depth, np.arange(self.depth[-1] + 3))
        for size in range(self.depth[-1] + 1):
            own, below = slice(*cuts[size : size + 2]), slice(*cuts[size + 1 : size + 3])
            if size > 1:
                shorter[own] = self.step(shorter[parent[own]], byte[own])
            if size:
                self.end[own] = np.where(self.token[own] >= 0, self.end[own], self.end[shorter[own]])
            if size <= NEAR:
                self.near[own] = self.near[shorter[own]]
                self.near[parent[below], byte[below]] = np.arange(below.start, below.stop)
        self.down = self.end[shorter]
        self.link = array("q", self.links.tobytes())
        self.size = np.array([len(t) for t in self.text])
        # pairs met by many pre-tokens together: a place for each hash, taken by the last pair that had it
        self.met, self.apart = np.full(1 << PLACES, -1), np.zeros(1 << PLACES, bool)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The states after a byte each: a longer beginning, or that of the next shorter end that is one."""
        out, todo = np.empty(len(state), np.int64), np.arange(len(state))
        while True:
            near = state < len(self.near)
            out[todo[near]] = self.near[state[near], byte[near]]
            todo, state, byte = todo[~near], state[~near], byte[~near]
            if not len(todo):
                return out
            key = state << 8 | byte
            at = np.searchsorted(self.links, key)
            found = self.links[at] == key
            out[todo[found]] = self.to[at[found]]
            todo, state, byte = todo[~found], self.shorter[state[~found]], byte[~found]

    def next(self, state: int, byte: int) -> int:
        """``step`` for one state."""
        while state >= len(self.near):
            key = state << 8 | byte
            at = bisect_left(self.link, key)
            if self.link[at] == key:
                return int(self.to[at])
            state = int(self.shorter[state])
        return int(self.near[state, byte])

    def _reachable(self, t: int) -> bool:
        """A token is made from its own bytes only if no earlier merge spans the border of its halves."""
        return self.compatible(self.left[t], self.right[t], self.when[t])

    def compatible(self, a: int, b: int, until: int = 1 << 60) -> bool:
        """Whether the tokens a, b next to each other stay apart through all merges before ``until``.

        Undoes merges at the border, latest first. x and y are the tokens at the border until the times
        x_gone and y_gone, when they become part of something larger; a merge of x and y that comes before
        (at equal rank the merge further left goes first) joins the two sides.
        """
        x, y, x_gone, y_gone = a, b, until, until - 1
        merge, when = self.merge, self.when
        while True:
            r = merge.get(x << 32 | y)
            if r is not None and r < x_gone and r <= y_gone:
                return False
            if when[x] > when[y]:
                x_gone, x = when[x], self.right[x]
            elif when[y] >= 0:
                y_gone, y = when[y], self.left[y]
            else:
                return True

    def word(self, w: str) -> bytes:
        """Ids of one pre-token (in byte letters), little-endian."""
        n = len(w)
        last = []
        pairs, end, token, depth = self.pairs, self.end, self.token, self.depth
        state = 0
        for at, letter in enumerate(w, 1):
            state = self.next(state, self.letter_byte[letter])
            found = end[state]
            while True:
                t, size = int(token[found]), int(depth[found])
                if size == at:
                    break
                p = last[at - size - 1]
                key = p << 32 | t
                ok = pairs.get(key)
                if ok is None:
                    if len(pairs) > MEMORY:
                        pairs.clear()
                    ok = pairs[key] = self.compatible(p, t)
                if ok:
                    break
                found = self.down[found]
            last.append(t)
        ids = []
        at = n - 1
        while at >= 0:
            t = last[at]
            ids.append(t)
            at -= len(self.text[t])
        ids.reverse()
        return array("I", ids).tobytes()

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs; what is found is kept."""
        key = a << 32 | b
        place = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - PLACES)).astype(np.int64)
        ok = self.apart[place]
        new = np.flatnonzero(self.met[place] != key)
        if len(new):
            pairs, at, back = np.unique(key[new], return_index=True, return_inverse=True)
            found = np.array([self.compatible(x >> 32, x & 0xFFFFFFFF) for x in pairs.tolist()])
            ok[new] = found[back]
            at = place[new[at]]
            self.met[at] = -1
            at, one = np.unique(at, return_index=True)
            self.met[at], self.apart[at] = pairs[one], found[one]
        return ok

    def words(self, words: list[str]) -> list[bytes]:
        """``word`` for many pre-tokens (as they are in the text) at once: longest first, one byte of each a step."""
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        # byte k of all words that have one, then byte k + 1: the word in row i has its byte k at base[k] + i
        many = np.searchsorted(-size, -np.arange(size[0]))
        base = np.concatenate([[0], np.cumsum(many)])
        row = np.repeat(np.arange(len(raw)), size)
        place = base[np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] + row
        byte = np.empty(len(row), np.uint8)
        byte[place] = np.frombuffer(b"".join([raw[i] for i in order.tolist()]), np.uint8)
        last = np.empty(len(row), np.int64)
        state = np.zeros(len(raw), np.int64)
        for k, n in enumerate(many.tolist()):
            state = self.step(state[:n], byte[base[k] : base[k + 1]])
            todo, found = np.arange(n), self.end[state]
            while len(todo):
                t, back = self.token[found], self.depth[found]
                ok = back > k
                part = np.flatnonzero(~ok)
                ok[part] = self.stay(last[base[k - back[part]] + todo[part]], t[part])
                last[base[k] + todo[ok]] = t[ok]
                todo, found = todo[~ok], self.down[found[~ok]]
        at, rows, steps = size - 1, np.arange(len(raw)), []
        while len(rows):
            t = last[base[at] + rows]
            steps.append((rows, t))
            at = at - self.size[t]
            rows, at = rows[at >= 0], at[at >= 0]
        count = np.bincount(np.concatenate([r for r, _ in steps]), minlength=len(raw))
        stop = np.cumsum(count)
        ids = np.empty(stop[-1], "<u4")
        for k, (r, t) in enumerate(steps):
            ids[stop[r] - 1 - k] = t
        data = ids.tobytes()
        out = [b""] * len(raw)
        for i, a, b in zip(order.tolist(), (4 * (stop - count)).tolist(), (4 * stop).tolist(), strict=True):
            out[i] = data[a:b]
        return out

    def learn(self, met: set[str]) -> None:
        """Puts ``met`` (less than MEMORY) into the younger memory, but for very long ones and special tokens' strings."""
        new = met.difference(self.ids_of)
        if len(new) < FEW:
            return
        if len(self.ids_of) + len(new) > MEMORY:
            self.older, self.ids_of = self.ids_of, {}
            new = met
        again = {w: ids for w, ids in zip(new, map(self.older.get, new), strict=True) if ids}
        fresh = [w for w in new.difference(again) if len(w) < LONG and w not in self.special]
        self.ids_of |= again
        if fresh:
            self.ids_of.update(zip(fresh, self.words(fresh), strict=True))

    def missed(self, w: str) -> bytes:
        """Ids of a pre-token that wasn't in the memory's younger generation when its text began."""
        if w in self.special:
            return self.special[w].to_bytes(4, "little")
        ids = self.ids_of.get(w) or self.older.get(w) or self.word(w.encode().decode("latin-1").translate(self.letter))
        if len(w) < LONG:
            if len(self.ids_of) >= MEMORY:
                self.older, self.ids_of = self.ids_of, {}
            self.ids_of[w] = ids
        return ids

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text; special tokens' strings stand among them as they are."""
        if not self.special_split or not any(s in text for s in self.special):
            return pre_tokens(text, self.classes)
        parts = self.special_split.split(text)
        return [w for p in parts for w in ([p] if p in self.special else pre_tokens(p, self.classes))]

    def joined(self, words: list[str]) -> bytes:
        try:
            return b"".join(map(self.ids_of.__getitem__, words))
        except KeyError:
            known = list(map(self.ids_of.get, words))
            return b"".join([self.missed(w) if ids is None else ids for w, ids in zip(words, known, strict=True)])

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        return self.joined(self.cut(text))

    def together(self, held: list[list[str]]) -> Iterator[bytes]:
        self.learn(set(chain.from_iterable(held)))
        return map(self.joined, held)

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """``encode`` for many texts, null as empty; what is new in several of them, or in a part of a long one, is learnt at once."""
        held, n = [], 0
        for text in texts:
            words = self.cut(text or "")
            if n + len(words) > TOGETHER:
                yield from self.together(held)
                held, n = [], 0
            if len(words) > TOGETHER:
                yield b"".join([next(self.together([words[a : a + TOGETHER]])) for a in range(0, len(words), TOGETHER)])
            else:
                held.append(words)
                n += len(words)
        yield from self.together(held)

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids; bytes that aren't UTF-8 become replacement characters."""
        raw = b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


_codecs = WorkerCache(4)


def codec(path: str) -> PrefixBpe:
    return _codecs.get(path, lambda: PrefixBpe(path))


def encode(docs: DataFrame, vocabulary: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with a column ``out``: the token ids, binary, four little-endian bytes each."""

    def run(texts: pa.Array) -> pa.Array:
        c = codec(vocabulary)
        return pa.array(list(c.encode_all(texts.to_pylist())), pa.binary())

    return docs.withColumn(out, F.arrow_udf(run, "binary")(F.col(text)))


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with a column ``out`` (string): the text of the ids."""

    def run(rows: pa.Array) -> pa.Array:
        c = codec(vocabulary)
        return pa.array([c.decode(x or b"").decode() for x in rows.to_pylist()], pa.string())

    return tokens.withColumn(out, F.arrow_udf(run, "string")(F.col(ids)))


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text", out: str = "bpe") -> DataFrame:
    """``docs`` with a struct ``out``: n_tokens and the SHA-256 of the ids and of the text decoded from them.

    Encodes and decodes in one pass, so ids and decoded texts don't travel back as columns.
    """

    def run(texts: pa.Array) -> pa.Array:
        c = codec(vocabulary)
        n, a, b = [], [], []
        for ids in c.encode_all(texts.to_pylist()):
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.withColumn(out, F.arrow_udf(run, kind)(F.col(text)))
