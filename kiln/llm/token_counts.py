"""Token counts: exact token numbers of whole texts, without keeping tokens.

Arrow batches go to the tokenizer library in calls of about equal bytes; texts longer than a call are cut
at safe boundaries and their counts summed. A cut is safe between an ASCII white-space character and a
following ASCII letter where the vocabulary drops white space before merging (no pre-token, normalisation or special
string spans it); with any other kind of vocabulary file a text is never cut.

Cases: null text counts as empty (0 bytes, 0 tokens); rows are kept one for one, repeated ids and null ids
included; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CALL_BYTES = 256 << 10
_CUT = re.compile(r"[ \t\n\r\f\v](?=[A-Za-z])")


class Counter:
    """Counts by one vocabulary file: `tokenizers` for .json, `sentencepiece` for .model."""

    def __init__(self, path: str, call_bytes: int = CALL_BYTES):
        self.call_bytes, self.cuts = call_bytes, False
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            with open(path, encoding="utf-8") as f:
                spec = f.read()
            tok = Tokenizer.from_str(spec)
            tok.no_truncation()
            tok.no_padding()
            self.lengths = lambda xs: [len(e) for e in tok.encode_batch_fast(xs, add_special_tokens=False)]
            self.cuts = _drops_white_space(json.loads(spec))
        else:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda xs: [len(e) for e in sp.encode(xs, num_threads=1)]

    def pieces(self, text: str) -> list[str]:
        if not self.cuts or len(text) <= self.call_bytes:
            return [text]
        out, at = [], 0
        while len(text) - at > self.call_bytes:
            m = _CUT.search(text, at + self.call_bytes // 2)
            if m is None:
                break
            out.append(text[at : m.start() + 1])
            at = m.start() + 1
        return [*out, text[at:]]

    def count(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        call, rows, size = [], [], 0

        def flush():
            for r, n in zip(rows, self.lengths(call) if call else (), strict=True):
                out[r] += n
            call.clear()
            rows.clear()

        for r, text in enumerate(texts):
            for p in self.pieces(text or ""):
                call.append(p)
                rows.append(r)
                size += len(p)
                if size >= self.call_bytes:
                    flush()
                    size = 0
        flush()
        return out


def _drops_white_space(spec: dict) -> bool:
    """True for files whose first splitting step removes white space and whose normalisers look at no neighbour
    beyond it."""
    steps = lambda x, k: x.get(k, [x]) if x else []
    pre, norm = steps(spec.get("pre_tokenizer"), "pretokenizers"), steps(spec.get("normalizer"), "normalizers")
    return (
        bool(pre)
        and pre[0].get("type") == "Split"
        and pre[0].get("behavior") == "Removed"
        and pre[0].get("invert") is True
        and r"[^\s" in pre[0]["pattern"].get("Regex", "")
        and all(x["type"] in ("NFC", "Lowercase") or x.get("pattern") == {"Regex": r"\s+"} for x in norm)
        and not any(t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens", []))
    )


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _counters[path] = Counter(path)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with a column ``out`` (long): the number of tokens of ``text`` by the file ``vocabulary``."""

    def count(texts: pa.Array) -> pa.Array:
        return pa.array(counter(vocabulary).count(texts.to_pylist()), pa.int64())

    return docs.withColumn(out, F.arrow_udf(count, "long")(F.col(text)))
