"""The corpus pipeline: five stages over `documents`, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the caller writes as Parquet and rereads
as the next one's ``docs``. Columns beyond doc_id and text pass through, whatever their names; rows repeated as a whole are near duplicates of each other; empty tables
give empty results. All but the last return the columns of `documents`; each works on every row that its
predecessor kept. Rows with null text are empty documents to every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import bpe, decontam, parity_join, quality, substring
from kiln.llm.common import free_name, prepare
from kiln.llm.queries import BPE_FILE, QUALITY_THRESHOLD, table, training_labels, vocabulary
from kiln.session import ensure_checkpoint_dir


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score from the threshold on)."""
    prepare(spark)
    model = quality.train(docs, training_labels(spark, sf_dir))
    return docs.where(quality.score(model) >= QUALITY_THRESHOLD)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at Jaccard 0.8 or more: that of the smallest id.

    Rows repeated as a whole are copies, too; documents without words are in no group and stay.
    """
    prepare(spark)
    return parity_join.keep_first(docs, width=5, num=80, den=100).select(docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word windows that occur at an earlier place; texts left without words go."""
    prepare(spark)
    out = free_name(docs, "cut")
    cut = substring.dedup(docs, out=out)
    removed = F.col(out)["n_removed"]
    emptied = (removed > 0) & (removed == F.col(out)["n_words"])
    kept = F.when(removed > 0, F.col(out)["kept"]).otherwise(F.col("text"))
    cut = cut.where(~emptied).withColumn("text", kept)
    if "n_chars" in docs.columns:
        size = F.when(removed > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    out = free_name(docs, "hit")
    found = decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), out=out)
    return found.where(F.size(F.col(out)["spans"]) == 0).select(docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and the SHA-256 of ids and decoded text of every document."""
    prepare(spark)
    return bpe.round_trip(docs.select("doc_id", "text"), vocabulary(BPE_FILE)).select("doc_id", "bpe.*")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("tokens", encode_tokens),
]

#: The classifier and the tokenizer have no SQL form; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written to the shared folder and read again."""
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
