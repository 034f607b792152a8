"""The pipeline's stages: row contracts, and each stage against a plain version on its own input."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline as P
import __spark_entry__ as E
from kiln.llm import decontam
from kiln.llm.common import stored
from tests.conftest import SF_SMALL
from tests.llm.helpers import WORD
from tests.llm.test_operators import brute_components


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, SF_SMALL))
        before = {(r.doc_id, r.text) for r in docs.collect()}
        if name != "tokens":
            assert out.schema == docs.schema
            after = {(r.doc_id, r.text) for r in out.collect()}
            assert len({d for d, _ in before} - {d for d, _ in after}) < 0.5 * len(before)
        if name == "near_duplicates":
            want = brute_components(before, 5, 80, 100)
            assert after == {k for k, (n, least) in want.items() if n == 0 or k[0] == least}
        if name == "substrings":
            seen, want = {}, {}
            for d, t in sorted(before):
                w = WORD.findall(t or "")
                gone = [0] * len(w)
                for i in range(len(w) - 19):
                    if seen.setdefault(tuple(w[i : i + 20]), (d, i)) != (d, i):
                        gone[i : i + 20] = [1] * 20
                kept = [x for x, g in zip(w, gone, strict=True) if not g]
                if kept or not w:
                    want[d] = kept
            assert {d: WORD.findall(t or "") for d, t in after} == want
        if name == "decontamination":
            windows = {w for t in bench for w in decontam.windows(t)}
            sizes = {len(w.split()) for w in windows}

            def hit(t):
                w = decontam.words(t)
                return any(b" ".join(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

            assert after == {k for k in before if not hit(k[1])}
        docs = out
    assert all(r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for r in docs.collect() for d, t in before if d == r.doc_id)


def test_registered(spark):
    assert "pipeline" in E.queries() and sum(q.startswith("op") and q[2].isdigit() for q in E.queries()) == 13
    got = E.queries()["pipeline"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def test_awkward_tables(spark):
    """Nulls, empty texts, rows repeated as a whole, columns with the stages' own names; then empty tables."""
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(30)
    odd = spark.createDataFrame([(None, None), (9001, ""), (9001, ""), (9002, None), (None, " \n")], "doc_id long, text string")
    docs = real.select("doc_id", "text").unionByName(odd).unionByName(real.select("doc_id", "text"))
    docs = docs.select("*", *[F.concat(F.lit(c), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in ("score", "predicted", "_cut", "_hit", "stays", "key", "hit0")])
    want = {r.doc_id: tuple(r)[2:] for r in docs.collect()}
    for name, stage in P.STAGES:
        out = stored(stage(spark, docs, SF_SMALL))
        if name != "tokens":
            assert out.dtypes == docs.dtypes
            assert all(tuple(r)[2:] == want[r.doc_id] for r in out.collect())
            assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
        docs = out
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
