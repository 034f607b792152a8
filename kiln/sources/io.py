"""Readers and writers (S1–S16) with declared schemas (no inference).

JSON sources are read with an explicit schema and a corrupt-record column;
required-field checks are one aggregate, raised on the driver with the
offending keys. Sinks never overwrite existing output unless asked.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, LongType, MapType, StringType, StructField, StructType,
)

from kiln.operators.adapters import ADAPTERS

# a tool call stays JSON text: its key order, depth and types are part of what is rendered
MESSAGE = StructType([
    StructField("role", StringType()), StructField("content", StringType()),
    StructField("tool_calls", ArrayType(StringType())), StructField("thinking", StringType()),
    StructField("trainable", BooleanType()),
])
MESSAGES = ArrayType(MESSAGE)
CONVERSATION_FILE = StructType([StructField("messages", MESSAGES), StructField("_corrupt_record", StringType())])
COMPARISON = StructType([
    StructField("prompt_conversation", MESSAGES), StructField("completion_A", MESSAGES), StructField("completion_B", MESSAGES),
])
COMPARISON_FILE = StructType([StructField("comparison", COMPARISON), StructField("label", StringType())])
CHECKPOINT_LOG = StructType([
    StructField("name", StringType()), StructField("epoch", LongType()), StructField("batch", LongType()),
    StructField("state_path", StringType()), StructField("sampler_path", StringType()),
])
TRACE_EVENT = StructType([
    StructField("name", StringType()), StructField("ph", StringType()), StructField("pid", LongType()),
    StructField("tid", LongType()), StructField("ts", DoubleType()), StructField("args", MapType(StringType(), StringType())),
    StructField("cat", StringType()),
])


def read_conversations(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """JSONL with a ``messages`` list per line; a line without it is an error naming its keys."""
    df = spark.read.schema(CONVERSATION_FILE).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    if check:
        raw = spark.read.text(path)
        bad = raw.filter((F.trim("value") != "") & F.get_json_object("value", "$.messages").isNull()).select(
            F.json_object_keys("value").alias("keys")).limit(1).collect()
        if bad:
            raise ValueError(f"each line needs a 'messages' field; found keys {sorted(bad[0]['keys'] or [])}")
    return df.select("messages")


def read_comparisons(spark: SparkSession, path: str) -> DataFrame:
    """S2 + S3: labelled comparisons; rows missing the comparison or label are dropped."""
    df = spark.read.schema(COMPARISON_FILE).json(path)
    return df.filter(F.col("comparison").isNotNull() & F.col("label").isNotNull()).select(
        F.struct(
            F.col("comparison.prompt_conversation").alias("prompt"),
            F.col("comparison.completion_A").alias("completion_a"),
            F.col("comparison.completion_B").alias("completion_b"),
            F.col("label").alias("label"),
        ).alias("cmp")
    )


def read_parquet_union(spark: SparkSession, paths: list[str]) -> DataFrame:
    """S4 + S6: Parquet parts (configs × splits) concatenated by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(p) for p in paths])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text lines, stripped; blank lines dropped."""
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("line")).filter(F.col("line") != "")


def read_dataset(spark: SparkSession, kind: str, paths: list[str]) -> DataFrame:
    """A named source in its own schema (Parquet parts) through its adapter."""
    if kind not in ADAPTERS:
        raise ValueError(f"unknown dataset {kind!r}; known: {sorted(ADAPTERS)}")
    return ADAPTERS[kind](read_parquet_union(spark, paths))


def write_conversations(df: DataFrame, path: str, messages: str = "messages") -> None:
    """One object with its ``messages`` a line; rows without are skipped; existing output is never overwritten."""
    df.filter(F.col(messages).isNotNull()).select(F.col(messages).alias("messages")).write.mode("ignore").json(path)


def config_hash(dataset: str, config: dict) -> str:
    """S10 cache key: dataset name **and** configuration."""
    return hashlib.sha256(json.dumps({"dataset": dataset, "config": config}, sort_keys=True).encode()).hexdigest()[:16]


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, None if there is no such path; any other failure is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def load_or_cache(spark: SparkSession, cache_root: str, dataset: str, config: dict, build) -> DataFrame:
    """Read the cached table if present, else build, write and read it back."""
    path = f"{cache_root.rstrip('/')}/{dataset}-{config_hash(dataset, config)}"
    if (cached := read_if_there(spark, path)) is not None:
        return cached
    build().write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append one JSON object per step."""
    df.write.mode("append").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines with a declared schema."""
    return spark.read.schema(schema).json(path)


def run_schema(schema: StructType) -> StructType:
    """A log's schema with the run it belongs to."""
    return StructType([StructField("run", LongType()), *schema.fields])


def last_checkpoint(log: DataFrame, required_key: str = "state_path", by: Sequence[str] = ()) -> DataFrame:
    """Last resumable row (loop state order) having ``required_key``, one for each run in ``by``."""
    return log.filter(F.col(required_key).isNotNull()).groupBy(*by).agg(
        F.max_by(F.struct(*[c for c in log.columns if c not in by]), F.struct("epoch", "batch")).alias("_r")
    ).select(*by, "_r.*")


def write_eval_csv(df: DataFrame, path: str, required: list[str]) -> None:
    """CSV with every required column present (missing → null); an existing file is an error."""
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in required]
    df.select(*cols).write.mode("error").option("header", True).csv(path)
