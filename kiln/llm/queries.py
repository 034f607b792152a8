"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (
    bpe, decontam, ego_join, oracles, parity_join, pseudo_lm, quality, substring, suffix_index, token_counts, toxicity, url_filter, vector_codes, whitening,
)
from kiln.llm.common import held_out, prepare

#: Folder of the vocabulary files; the names in it are parameters of the operators.
TOKENIZERS = os.path.dirname(public_tokenizers.__file__)
BPE_FILE, COUNT_FILE = "byte_bpe_50k.json", "word_bpe_49k.json"
QUALITY_THRESHOLD, TOXIC_THRESHOLD, TOKEN_LIMIT = 0.7, 0.3, 2048


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where(~held_out())


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, training_labels(spark, sf_dir))
    scored = quality.classify(docs.select("doc_id", "text"), model, QUALITY_THRESHOLD)
    return scored.select("doc_id", held_out().alias("held_out"), "quality.score", "quality.predicted")


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary(BPE_FILE)).select("doc_id", "bpe.*")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_index.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "cut.n_bytes", "cut.n_removed", F.size("cut.spans").cast("long").alias("n_spans"), "cut.kept_sha256"
    )


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("hit.n_words").alias("n_words"),
        decontam.hit_words().alias("n_hit"),
        F.size("hit.items").cast("long").alias("n_items"),
        decontam.items_digest().alias("items_sha256"),
        (F.size("hit.spans") > 0).alias("contaminated"),
    )


def op5_parity_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = parity_join.classes(docs, width=3, num=90, den=100)
    return found.select("row.doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op6_grid_order_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary(COUNT_FILE)).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"),
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = substring.dedup(docs, digest=True)
    return cut.select("doc_id", "cut.n_words", "cut.n_removed", F.col("cut.kept").alias("kept_sha256"))


def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = pseudo_lm.word_counts(docs)
    return pseudo_lm.score(docs, *pseudo_lm.train(docs), words=words).select("doc_id", "lm.*")


def op10_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, training_labels(spark, sf_dir))
    scored = toxicity.classify(docs.select("doc_id", "text"), model, TOXIC_THRESHOLD)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", "codebooks_sha256")


URL_RULES = [
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_bpe_round_trip,
        op3_suffix_array_dedup,
        op4_benchmark_decontamination,
        op5_parity_jaccard_join,
        op6_grid_order_embedding_join,
        op7_token_counts,
        op8_substring_dedup,
        op9_pseudo_likelihood,
        op10_toxicity_grammar,
        op11_embedding_whitening,
        op12_vector_codes,
        op13_url_filter,
    )
}

#: DuckDB text of the queries that SQL expresses.
SQL: dict[str, str] = {
    "op4_benchmark_decontamination": oracles.OP4,
    "op5_parity_jaccard_join": oracles.OP5,
    "op6_grid_order_embedding_join": oracles.OP6,
    "op8_substring_dedup": oracles.OP8,
    "op12_vector_codes": oracles.OP12,
    "op13_url_filter": oracles.op13(URL_RULES),
}
