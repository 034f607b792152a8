"""Each operator against a brute-force version, on small tables with nulls, empties, ties, repeats and clashes."""

from __future__ import annotations

import hashlib
import math
import random
import weakref
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kiln.llm import bpe, common, decontam, ego_join, parity_join, pseudo_lm, quality, substring, suffix_index, token_counts, toxicity
from kiln.llm.common import components, prepare, sifted
from kiln.llm.queries import BPE_FILE, COUNT_FILE, vocabulary
from tests.llm.helpers import SCHEMA, WORD, documents, find, frame, prose

EMPTY: list = []


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return frame(spark).cache()


def rows_of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_bpe_memory_keeps_frequent_words(monkeypatch):
    """A word that is met again and again is encoded once, however many rare words pass between."""
    monkeypatch.setattr(bpe, "MEMORY", 20)
    codec, asked = bpe.PrefixBpe(vocabulary(BPE_FILE)), Counter()
    word = codec.word
    monkeypatch.setattr(codec, "word", lambda w: (asked.update([w]), word(w))[1])
    tok = Tokenizer.from_file(vocabulary(BPE_FILE))
    for i in range(30):
        text = f"often{'x' * (i % 2)} often often rare" + chr(97 + i % 26) + " zq" * (i % 3) + f" odd{chr(0x100 + i)} often " + "w" * (90 + i)
        assert np.frombuffer(codec.encode(text), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(codec.ids_of) <= 20 and len(codec.older) <= 20
    assert asked[codec.letter[32] + "often"] == 1 and max(asked.values()) < 30


def test_idle_models_are_dropped(monkeypatch):
    """What one step has built doesn't stay in the worker through the steps after it; what is in use does."""
    held = [weakref.ref(bpe.codec(vocabulary(BPE_FILE))), weakref.ref(decontam.scanner("x", SimpleNamespace(value=[(b"a b", ["1"])])))]
    common.give_back()
    assert all(x() for x in held)
    monkeypatch.setattr(common, "IDLE_S", -1, raising=False)
    list(common.trimmed(iter)([]))
    assert not any(x() for x in held)


def test_bpe_automaton_is_small():
    """No table of all states and bytes; the next state is the longest end that begins a token."""
    codec = bpe.PrefixBpe(vocabulary(BPE_FILE))
    assert sum(x.nbytes for x in vars(codec).values() if isinstance(x, np.ndarray)) < 30 << 20
    rng = np.random.default_rng(3)
    state, byte = rng.integers(0, len(codec.token), 2000), rng.integers(0, 256, 2000)
    assert codec.step(state, byte).tolist() == [codec.next(s, b) for s, b in zip(state.tolist(), byte.tolist(), strict=True)]


def test_bpe_new_words_are_encoded_together(monkeypatch):
    """New pre-tokens of many texts take their steps at once, few one by one; the ids are the library's."""
    monkeypatch.setattr(bpe, "MEMORY", 400)
    monkeypatch.setattr(bpe, "TOGETHER", 150)
    codec, alone = bpe.PrefixBpe(vocabulary(BPE_FILE)), []
    word = codec.word
    monkeypatch.setattr(codec, "word", lambda w: (alone.append(w), word(w))[1])
    r = random.Random(3)
    letters = "etaoinshrdlu'EÉßжшя日本語ひ9٣ \n\t\u3000\u0301\u200d🙂.,!-_"
    texts = [None, "", " ", "<|endoftext|>", *("".join(r.choices(letters, k=r.choice((3, 90, 400)))) for _ in range(200))]
    texts += ["x" * 300 + " it's <|endoftext|>we'll", "".join(r.choices(letters, k=9000))]
    tok = Tokenizer.from_file(vocabulary(BPE_FILE))
    got = []
    for ids in codec.encode_all(texts):
        got.append(np.frombuffer(ids, "<u4").tolist())
        assert len(codec.ids_of) <= 400 and len(codec.older) <= 400
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    cut = [w for t in texts for w in codec.cut(t or "")]
    assert 0 < len(alone) < 0.1 * len(cut) and len(cut) > 10_000


def test_bpe_pre_tokens_are_those_of_the_pattern():
    classes, r = bpe.char_classes(), random.Random(4)
    letters = "stmdrevlLx'' \n\t\r\x1c\x85\xa0\u2028\u3000aé日1²٣Ⅷ!?\u0301_\U0001f642\U00010400"
    for n in range(3000):
        text = "".join(r.choices(letters, k=n % 40))
        assert bpe.pre_tokens(text, classes) == bpe.regex.findall(bpe.SPLIT, text)


def test_bpe_equals_library(spark, docs):
    tok = Tokenizer.from_file(vocabulary(BPE_FILE))
    odd = ["<|endoftext|> a<|endoftext|>", "́a ‍🏳️‍🌈  \n\n x", "aaaaaaaaaaaaaaa" * 40, "it's I'LL  we'll"]
    df = docs.unionByName(spark.createDataFrame([(900 + i, t, "k", 0) for i, t in enumerate(odd)], SCHEMA))
    got = {(r.doc_id, r.text): r for r in bpe.round_trip(df, vocabulary(BPE_FILE)).collect()}
    assert len(df.columns) == 4 and sum(1 for _ in got) >= 30
    for (_, text), r in got.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids
        assert r.bpe.n_tokens == len(ids)
        assert r.bpe.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = tok.decode(ids, skip_special_tokens=False)
        assert r.bpe.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    both = bpe.decode(bpe.encode(df, vocabulary(BPE_FILE)), vocabulary(BPE_FILE)).collect()
    assert all(r.decoded == (r.text or "") for r in both)
    assert bpe.round_trip(frame(spark, EMPTY), vocabulary(BPE_FILE)).count() == 0


@pytest.mark.parametrize("name", [COUNT_FILE, BPE_FILE])
def test_token_counts_equal_library(spark, docs, name):
    tok = Tokenizer.from_file(vocabulary(name))
    got = token_counts.token_counts(docs, vocabulary(name)).collect()
    assert len(got) == len(documents())
    assert all(r.n_tokens == len(tok.encode(r.text or "", add_special_tokens=False).ids) for r in got)
    cut = token_counts.Counter(vocabulary(name), call_bytes=100)
    texts = [prose(50, 400), "<|endoftext|> " * 90, " ́ a " * 90, "x" * 5000]
    assert cut.count(texts) == [len(tok.encode(t, add_special_tokens=False).ids) for t in texts]
    assert cut.cuts == (name == COUNT_FILE)


def test_decontamination(spark, docs):
    items = [("b1", prose(2, 60)), ("b2", "two WORDS"), ("b2", prose(5, 30)), ("b3", None), ("b4", "..."), (None, "one"), ("b5", "absent thing")]
    bench = spark.createDataFrame(items * 2, "item_id string, text string")
    want_windows = defaultdict(set)
    for i, t in items:
        for w in decontam.windows(t) if i else ():
            want_windows[w].add(i)
    for block in (decontam.BLOCK_BYTES, 2000):
        got = decontam.decontaminate(docs, bench, block_bytes=block)
        got = got.withColumn("n_hit", decontam.hit_words()).withColumn("digest", decontam.items_digest())
        for r in got.collect():
            w = decontam.words(r.text)
            mark, found = [0] * len(w), set()
            for size in {len(x.split()) for x in want_windows}:
                for i in range(len(w) - size + 1):
                    hit = want_windows.get(b" ".join(w[i : i + size]), set()) if size == 10 or len(w) >= size else set()
                    if hit:
                        found |= hit
                        mark[i : i + size] = [1] * size
            assert (r.hit.n_words, r.n_hit, set(r.hit["items"])) == (len(w), sum(mark), found)
            assert r.digest == decontam.digest(list(found))
            if r.text:
                raw = r.text.encode()
                assert all(decontam.words(raw[s.a : s.b].decode()) == w[x.a : x.b] for s, x in zip(r.hit.byte_spans, r.hit.spans, strict=True))
    none = decontam.decontaminate(docs, bench.limit(0)).collect()
    assert len(none) == len(documents()) and not any(r.hit.spans for r in none)


def test_substring_dedup(spark, docs):
    for width in (4, 20):
        seen, want = {}, Counter()
        order = sorted({(d, t) for d, t, *_ in documents()}, key=lambda x: (x[0] is not None, x[0] or 0))
        result = {}
        for d, t in order:
            w = WORD.findall(t or "")
            gone = [0] * len(w)
            for i in range(len(w) - width + 1):
                key = tuple(w[i : i + width])
                if seen.setdefault(key, (d, i)) != (d, i):
                    gone[i : i + width] = [1] * width
            kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
            result[d, t] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
        for d, t, k, p in documents():
            want[(d, t, k, p, *result[d, t])] += 1
        got = substring.dedup(docs, width=width, digest=True).select(*docs.columns, "cut.*")
        assert rows_of(got, *docs.columns, "n_words", "n_removed", "kept") == want
        full = substring.dedup(docs, width=width).select("text", "cut.*").collect()
        assert all(len(WORD.findall(r.kept)) == r.n_words - r.n_removed for r in full)
        assert all(r.kept == r.text for r in full if r.text and not r.n_removed)
    assert substring.dedup(frame(spark, EMPTY)).count() == 0


def test_suffix_array_dedup(spark, docs):
    rows = sorted({(d, t) for d, t, *_ in documents()}, key=str)
    for length, prefix, batches in ((400, 32, 4), (60, 16, 3)):
        places = defaultdict(set)
        for k, (_, t) in enumerate(rows):
            raw = (t or "").encode()
            for i in range(len(raw) - length + 1):
                places[raw[i : i + length]].add((k, i))
        want = Counter()
        result = {}
        for d, t in rows:
            raw = (t or "").encode()
            gone = np.zeros(len(raw), bool)
            for i in range(len(raw) - length + 1):
                if len(places[raw[i : i + length]]) > 1:
                    gone[i : i + length] = True
            spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
            result[d, t] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
        for d, t, k, p in documents():
            want[(d, t, k, p, *result[d, t])] += 1
        got = suffix_index.dedup(docs, length, prefix, batches).selectExpr(
            *docs.columns, "cut.n_bytes", "cut.n_removed", "size(cut.spans) as n_spans", "cut.kept_sha256"
        )
        assert rows_of(got, *docs.columns, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffix_index.dedup(frame(spark, EMPTY)).count() == 0


def test_suffix_long_texts_and_hot_prefixes(spark, monkeypatch):
    """Texts longer than a segment, and prefixes dealt out by window hash, give the same spans."""
    rows = [(1, prose(60, 700)), (2, prose(60, 700)[1500:4000]), (3, "zz" + prose(60, 700)[2000:2900])]
    want = [r.cut.spans for r in suffix_index.dedup(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    run, _ = suffix_index._contexts(400, 32)
    assert run and want[0]
    s = next(suffix_index.text_slices(__import__("pyarrow").array([rows[0][1]])))
    monkeypatch.setattr(suffix_index, "SEGMENT", 1000)
    pieces = [(off, x) for off, x in suffix_index.segments(s, 400)]
    starts = {off + i for off, x in pieces for i in range(len(x.buf) - 399)}
    assert starts == set(range(len(s.buf) - 399)) and len(pieces) > 1


def brute_components(rows, width, num, den):
    sets = {}
    for d, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d, t] = frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])
    parent = {k: k for k in sets}
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                parent[find(parent, a)] = find(parent, b)
    groups = defaultdict(list)
    for k in keys:
        groups[find(parent, k)].append(k)
    least = {k: min((d for d, _ in g if d is not None), default=None) for g in groups.values() for k in g}
    return {k: (len(sets[k]), least[k]) for k in keys}


@pytest.mark.parametrize(("width", "num", "den"), [(3, 90, 100), (5, 80, 100), (1, 50, 100)])
def test_parity_join(spark, docs, width, num, den):
    want = brute_components({(d, t) for d, t, *_ in documents()}, width, num, den)
    got = parity_join.classes(docs, width, num, den).join(docs.withColumnRenamed("pos", "_p"), __import__("pyspark.sql.functions", fromlist=["col"]).col("row.pos") == __import__("pyspark.sql.functions", fromlist=["col"]).col("_p"))
    rows = got.select("row.doc_id", "text", "n_shingles", "component_id").collect()
    assert len(rows) == len(documents())
    assert all((r.n_shingles, r.component_id) == want[r.doc_id, r.text] for r in rows)


def test_parity_join_random_families(spark):
    """Near copies at distances around the threshold, in several sizes: no link is lost, none is made up."""
    import random

    r = random.Random(5)
    rows = []
    for f, size in enumerate((3, 12, 30, 60, 200)):
        base = prose(300 + f, size).split()
        for k in range(14):
            w = list(base)
            for _ in range(r.randrange(1 + size // 20 + (size > 5))):
                w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
            rows.append((1000 * f + k, " ".join(w)))
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(5)
    for width, num, den in ((3, 90, 100), (2, 70, 100)):
        want = brute_components(rows, width, num, den)
        got = parity_join.classes(df, width, num, den).select("row.doc_id", "n_shingles", "component_id").collect()
        by_id = {d: v for (d, _), v in want.items()}
        assert all((x.n_shingles, x.component_id) == by_id[x.doc_id] for x in got)


def test_keep_first(docs):
    kept = parity_join.keep_first(docs, 3, 90, 100)
    want = brute_components({(d, t) for d, t, *_ in documents()}, 3, 90, 100)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert all(n == 1 for n in got.values())
    for (d, t), (n, least) in want.items():
        assert ((d, t) in got) == (n == 0 or d == least)


def test_block_pigeonhole():
    """Any two sets within the bound share a key, also where blocks are empty."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = a.copy()
        for _ in range(int(rng.integers(0, 5))):
            b = np.delete(b, rng.integers(len(b))) if rng.random() < 0.5 and len(b) > 1 else np.append(b, np.uint64(rng.integers(1 << 62)))
        both = len(np.intersect1d(a, b))
        if 10 * both < 8 * (len(a) + len(b) - both):
            continue
        row, key = parity_join.block_keys(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 80, 100)
        assert set(key[row == 0]) & set(key[row == 1])
        sk = [parity_join.sketch_of(x) for x in (a, b)]
        assert parity_join.close(sk[0], len(a), sk[1], len(b), 80, 100)


def test_embedding_join(spark):
    rng = np.random.default_rng(2)
    rows, ident = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            centre = rng.normal(size=8)
            for _ in range(12):
                rows.append((ident, [float(np.float32(x)) for x in centre + rng.normal(size=8) * 0.08], label))
                ident += 1
    rows += [(900 + k, rows[0][1], 0) for k in range(9)] + [rows[1], rows[1]]
    rows += [(950, None, 0), (951, [], 0), (952, [0.0] * 8, 0), (953, [float("nan")] + [1.0] * 7, 0), (954, [None, 1.0], 0), (955, [1.0, 2.0], 0), (956, [2.0, 4.0], 0)]
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    units = {}
    for v, e, l in rows:
        units[v] = (ego_join.unit(None if e is None else [None if x is None else float(np.float32(x)) for x in e]), l)
    links, parent = Counter(), {v: v for v in units}
    ids = sorted(units)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            (x, lx), (y, ly) = units[a], units[b]
            if x is not None and y is not None and lx is not None and lx == ly and len(x) == len(y) and float(x @ y) >= 0.98:
                links[a] += 1
                links[b] += 1
                parent[find(parent, a)] = find(parent, b)
    least = {}
    for v in ids:
        least[find(parent, v)] = min(v, least.get(find(parent, v), v))
    for block in (512, 5):
        got = ego_join.near_duplicates(df, 0.98, block=block).collect()
        assert len(got) == len(rows) and sum(links.values()) > 100
        for r in got:
            assert (r.n_links, r.component_id) == (links[r.vec_id], least[find(parent, r.vec_id)])
            assert r.kept == (r.vec_id == r.component_id)
    assert ego_join.near_duplicates(df.limit(0), 0.98).count() == 0


def test_grid_recursion_loses_nothing():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(700, 4))
    v /= np.linalg.norm(v, axis=1)[:, None]
    found = []
    whole = ego_join.Interval(v, v[:, :2])
    ego_join.join_intervals(whole, whole, 0.98, math.sqrt(0.04), found, True)
    got = {(int(i), int(j)) for a, b in found for i, j in zip(a, b, strict=True)}
    i, j = np.nonzero(np.triu(v @ v.T >= 0.98, 1))
    assert got == set(zip(i.tolist(), j.tolist(), strict=True)) and got


def labelled_table(spark, n=240):
    docs, labels = [], []
    for i in range(n):
        bad, toxic = i % 4 == 0, i % 5 == 0
        text = prose(2000 + i, 40)
        text = " ".join(w.upper() + "!!" for w in text.split()) if bad else text
        if toxic:
            w = text.split()
            w[7], w[20] = "grumfel" + "abcdefgh"[i % 8] + "o", "you idiot"
            text = " ".join(w)
        docs.append((i, text, "k", 0))
        labels.append((i, 0 if bad else 1, int(toxic)))
    docs += [(1000, None, "k", 0), (1001, "", "k", 0), (None, "one", "k", 0), (5, docs[5][1], "k", 0)]
    labels += [(None, 1, 1), (3, None, None), (7, labels[7][1], labels[7][2])]
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_learns_and_keeps_rows(spark):
    docs, labels = labelled_table(prepare(spark))
    model = quality.train(docs, labels.where("doc_id % 3 != 0 or doc_id is null"))
    got = quality.classify(docs, model).select("*", "quality.score", "quality.predicted").collect()
    assert len(got) == 244 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0]
    assert sum(r.predicted == int(r.doc_id % 4 != 0) for r in held) >= 0.95 * len(held)
    flat = quality.train(docs, labels.limit(0))
    assert {round(r.score, 6) for r in quality.classify(docs, flat).select("quality.score").collect()} == {0.5}


def test_labelled_rows_are_bounded(spark):
    """A labelled id that is repeated over many rows, alike or not, gives no more rows than the bound."""
    prepare(spark)
    docs = spark.createDataFrame([(1, "same", "k", 0)] * 50 + [(2, f"text {i}", "k", 0) for i in range(60)] + [(3, None, "k", 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    whole = quality.labelled(docs, labels, "quality", 100).collect()
    assert len(whole) == 62 and sum(r.text == "same" for r in whole) == 1
    few = [quality.labelled(d, labels, "quality", 10).collect() for d in (docs, docs.repartition(7))]
    assert len(few[0]) == 10 and sorted(map(str, few[0])) == sorted(map(str, few[1]))


def test_toxicity_learns_and_keeps_rows(spark):
    docs, labels = labelled_table(prepare(spark))
    model = toxicity.train(docs, labels.where("doc_id % 3 != 0 or doc_id is null"))
    got = toxicity.classify(docs, model).collect()
    assert len(got) == 244 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.doc_id % 3 == 0]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in held) >= 0.95 * len(held)
    assert toxicity.train(docs, labels.limit(0)).score("you idiot") > toxicity.train(docs, labels.limit(0)).score("hello there")


def test_toxicity_grammar_reads_clauses():
    lex, names = toxicity.build_lexicon([]), toxicity.GRAMMAR.names

    def patterns(text):
        return {n for n, x in zip(names, toxicity.read(text, lex), strict=True) if x}

    assert patterns("the idiot left") == {"insult"}
    assert patterns("you are an idiot") == {"insult+target"}
    assert patterns("you left. an idiot came") == {"insult"}
    assert patterns("not an idiot") == {"insult+negated"}
    assert patterns("not at all a great idiot") == {"insult"}
    assert patterns("someone said the idiot left") == {"insult+reported"}
    assert patterns("I will kill you") == {"threat"} and patterns("you, I will kill") == {"threat+target"}
    assert patterns("") == patterns(None) == set()


def test_pseudo_likelihood(spark, docs):
    corpus, net = pseudo_lm.train(docs)
    got = pseudo_lm.score(docs, corpus, net).collect()
    assert len(got) == len(documents())
    for r in got:
        n = len(WORD.findall(r.text or ""))
        assert r.lm.n_words == n and (r.lm.mean_log_prob is None) == (n == 0)
        assert r.lm.log_prob <= 0 and math.isfinite(r.lm.log_prob)
    # word by word, by the definition
    text = prose(2, 60)
    import pyarrow as pa

    s = next(pseudo_lm.text_slices(pa.array([text])))
    b, first = pseudo_lm.word_buckets(s)
    total = 0.0
    for i in range(len(b)):
        h = np.zeros(pseudo_lm.HIDDEN, np.float32)
        for k, d in enumerate(pseudo_lm.CONTEXT):
            row = int(pseudo_lm.mix64(b[i + d : i + d + 1].astype(np.uint64))[0] % np.uint64(pseudo_lm.TABLE)) if 0 <= i + d < len(b) else pseudo_lm.TABLE
            h = h + net.vec[k][row]
        z = np.tanh(h) @ net.top + net.bias
        total += z[corpus.cls[b[i]]] - np.log(np.exp(z).sum()) + corpus.inside[b[i]]
    assert abs(pseudo_lm.score_slice(s, corpus, net)[1][0] - total) < 1e-2
    # every class is a distribution over its words
    sums = np.bincount(corpus.cls, weights=np.exp(corpus.inside.astype(float)), minlength=pseudo_lm.CLASSES)
    assert np.allclose(sums[np.bincount(corpus.cls, minlength=pseudo_lm.CLASSES) > 0], 1, atol=1e-3)
    empty = frame(spark, EMPTY)
    assert pseudo_lm.score(empty, *pseudo_lm.train(empty)).count() == 0


def test_training_adds_in_the_plain_number_type(monkeypatch):
    """Arrays out of a broadcast carry a copy of their type, on which ``np.add.at`` is some ten times slower."""
    import pickle
    from types import SimpleNamespace

    import pyarrow as pa

    n = pseudo_lm.BUCKETS
    corpus = pseudo_lm.Corpus(np.arange(n) % pseudo_lm.CLASSES, np.zeros(n, np.float32), *[np.zeros(pseudo_lm.CLASSES, np.float32)] * 2)
    sent = pickle.loads(pickle.dumps((corpus, pseudo_lm.start_network(corpus, 1))))
    kinds, step = [], pseudo_lm.step
    monkeypatch.setattr(pseudo_lm, "step", lambda net, *rest: (kinds.extend(x.dtype for x in net), step(net, *rest)))
    run, _ = pseudo_lm._train(SimpleNamespace(value=sent))
    list(run(iter([pa.RecordBatch.from_arrays([pa.array([prose(1, 600)])], names=["text"])])))
    assert len(kinds) == 6 and all(k is np.dtype(np.float32) for k in kinds)


def test_every_word_is_a_target():
    """Texts of a few words too: the network's copies are weighted by all words they met."""
    from types import SimpleNamespace

    import pyarrow as pa

    n = pseudo_lm.BUCKETS
    corpus = pseudo_lm.Corpus(np.arange(n) % pseudo_lm.CLASSES, np.zeros(n, np.float32), *[np.zeros(pseudo_lm.CLASSES, np.float32)] * 2)
    run, _ = pseudo_lm._train(SimpleNamespace(value=(corpus, pseudo_lm.start_network(corpus, 1))))
    texts = ["red apple blue", "ocean", None, "", prose(1, 1203)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    (out,) = run(iter([batch]))
    assert set(out.column("seen").to_pylist()) == {3 + 1 + 1203}


def test_words_of_one_bucket_keep_their_counts(spark, monkeypatch):
    """A rare word that shares the bucket of a frequent one has its own count; rows stay one for one."""
    import pyarrow as pa

    monkeypatch.setattr(pseudo_lm, "CHUNK", 500)
    names = [f"{i}ab" for i in range(60000)]
    b, _ = pseudo_lm.word_buckets(next(pseudo_lm.text_slices(pa.array([" ".join(names)]))))
    rare = names[1 + int(np.flatnonzero(b[1:] == b[0])[0])]
    rows = [(i, "0ab " * 99) for i in range(20)] + [(100, "0ab"), (101, rare), (102, None), (102, None), (None, rare.upper())]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = pseudo_lm.word_counts(docs)
    assert sorted(r.n for r in words.collect()) == [2, 20 * 99 + 1]
    got = pseudo_lm.score(docs, *pseudo_lm.train(docs), words=words).collect()
    assert sorted((str(r.doc_id), r.text) for r in got if r.text) == sorted((str(d), t) for d, t in rows if t) and len(got) == len(rows)
    lm = {r.text: r.lm for r in got if r.lm.n_words < 2}
    assert abs(lm["0ab"].log_prob - lm[rare].log_prob - math.log((20 * 99 + 1) / 2)) < 1e-4
    assert lm[None].n_words == 0 and lm[None].log_prob == 0 and lm[None].mean_log_prob is None


def test_network_beats_word_counts(spark):
    """On text where words follow from their neighbours, context lowers the loss on unseen text."""
    import pyarrow as pa

    line = "red apple blue ocean green forest white snow "
    corpus_df = prepare(spark).createDataFrame([(i, line * 60) for i in range(20)], "doc_id long, text string").repartition(2)
    corpus, net = pseudo_lm.train(corpus_df)
    s = next(pseudo_lm.text_slices(pa.array([line * 3])))
    b, _ = pseudo_lm.word_buckets(s)
    alone = (corpus.prior[corpus.cls[b]] + corpus.inside[b]).sum()
    assert pseudo_lm.score_slice(s, corpus, net)[1][0] > alone + 5


def test_sifted_keeps_every_key(spark, monkeypatch):
    rows = spark.range(20_000).selectExpr("xxhash64(id) AS key", "id AS cell", "'x' AS bits").unionByName(
        spark.sql("SELECT cast(null AS bigint) AS key, 0L AS cell, 'x' AS bits")
    )
    keys = spark.range(0, 20_000, 100).selectExpr("xxhash64(id) AS key").union(spark.range(3).selectExpr("xxhash64(id)"))
    wanted = {r.key for r in keys.collect()}
    for limit, most in ((common.FILTER_BITS, 1_500), (1 << 15, 1_500)):
        monkeypatch.setattr(common, "FILTER_BITS", limit)
        got = sifted(rows, keys, "key")
        assert got.columns == rows.columns
        found = [r.key for r in got.collect()]
        assert wanted <= set(found) and len(found) == len(set(found)) <= most
    full = sifted(rows, rows.where("key is not null"), "key")  # more keys than the filter has bits for
    assert full.count() == 20_000
    assert sifted(rows, keys.limit(0), "key").count() == sifted(rows.limit(0), keys, "key").count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))] + [(i, i + 1) for i in range(300, 340)] + [(5, 5), (None, 3)]
    parent = {i: i for i in range(400)}
    for a, b in edges:
        if a is not None and a != b:
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    touched = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(parent, x) for x in touched}


def test_embedding_nulls_do_not_collide(spark):
    """A vector with a null component is no copy of the valid vector that is left without it."""
    rows = [(1, [0.6, None, 0.8], 1), (2, [0.6, 0.8], 1), (3, [0.6, None, 0.8], 1), (4, [0.6, 0.8], 1), (5, [None, 0.6, 0.8], 1), (6, [0.0, 0.0], 1), (7, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in ego_join.near_duplicates(df, cosine=0.98).collect()}
    assert got == {1: (0, 1, True), 2: (1, 2, True), 3: (0, 3, True), 4: (1, 2, False), 5: (0, 5, True), 6: (0, 6, True), 7: (0, 7, True)}


CLASHING = ["score", "predicted", "quality", "_hit0", "hit0", "row", "_stays", "_key", "stays", "_chunk", "word", "cut", "_cut", "hit", "_hit", "node", "class"]


def clashing(spark):
    """Documents whose further columns have the operators' own names."""
    docs = spark.createDataFrame([(i, prose(i % 7, 60) + (" extra" if i > 6 else "")) for i in range(14)], "doc_id long, text string")
    return docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])


def test_clashing_columns_are_kept(spark):
    docs = clashing(prepare(spark)).repartition(3)
    want = {r.doc_id: tuple(r) for r in docs.collect()}
    same = lambda rows: all(tuple(r)[: len(docs.columns)] == want[r.doc_id] for r in rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.classify(docs, model, out="verdict").collect()
    assert len(got) == 14 and same(got) and all(r.verdict.predicted in (0, 1) for r in got)
    bench = spark.createDataFrame([(1, prose(1, 60))], "item_id long, text string")
    got = decontam.decontaminate(docs, bench, out="found", block_bytes=64).collect()
    assert same(got) and {r.doc_id for r in got if r.found.spans} == {1, 8}
    kept = parity_join.keep_first(docs, 3, 80, 100)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == list(range(7)) and same(kept.collect())
    got = pseudo_lm.score(docs, *pseudo_lm.train(docs), out="lm", words=pseudo_lm.word_counts(docs)).collect()
    assert len(got) == 14 and same(got)
    for bad in (lambda: quality.classify(docs, model), lambda: decontam.decontaminate(docs, bench)):
        with pytest.raises(ValueError, match="another name"):  # never overwritten
            bad()
