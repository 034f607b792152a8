"""Pluggable tokenizers as Column expressions.

The default tokenizer splits text into pieces: a chat special marker
(``<|...|>`` or ``<｜...｜>``) is one piece, a run of ASCII letters/digits is
one piece, every other character is one piece. It is lossless
(``concat(pieces) == text``), runs as JVM regex expressions inside whole-stage
codegen and has the same result under Java regex and RE2, so DuckDB can
check it.

``ArrowTokenizer`` wraps a ``tokenizers`` JSON file behind an iterator
pandas UDF (Arrow batches, one tokenizer load per Python worker).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern of the default tokenizer (also used verbatim in oracle SQL).
SPECIAL = r"<\|[a-z_]+\|>|<｜[^｜]+｜>"
PIECE = SPECIAL + r"|[A-Za-z0-9]+|[^A-Za-z0-9]"
RUN = SPECIAL + r"|[A-Za-z0-9]+"


class RegexTokenizer:
    name = "regex_pieces"

    def pieces(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(f"({PIECE})"), 1)

    def count(self, text: Column) -> Column:
        """Number of pieces without materialising them: every special marker
        and letter/digit run collapses to one character, the rest is one
        character per piece."""
        return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), RUN, "a")).cast("long")


DEFAULT = RegexTokenizer()


class ArrowTokenizer:
    """Token ids from a ``tokenizers`` file, computed in Arrow batches."""

    name = "arrow"

    def __init__(self, path: str):
        self.path = path

    def _udf(self, kind: str):
        import pandas as pd
        from pyspark.sql.types import ArrayType, LongType

        path = self.path

        @F.pandas_udf(ArrayType(LongType()) if kind == "ids" else LongType())
        def encode(batches):  # iterator of Series -> iterator of Series
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            for s in batches:
                enc = tok.encode_batch(s.fillna("").tolist(), add_special_tokens=False)
                if kind == "ids":
                    yield pd.Series([e.ids for e in enc])
                else:
                    yield pd.Series([len(e.ids) for e in enc], dtype="int64")

        return encode

    def pieces(self, text: Column) -> Column:
        return self._udf("ids")(text)

    def count(self, text: Column) -> Column:
        return self._udf("count")(text)
