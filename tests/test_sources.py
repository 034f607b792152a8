"""Sources and sinks on files written from the driver tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from kiln.operators import adapters
from kiln.sources import io
from kiln.sources.tables import messages
from tests.conftest import SF_SMALL


def test_conversation_jsonl_roundtrip(spark, tmp_path):
    conv = adapters.conversation_arrays(messages(spark, SF_SMALL))
    path = str(tmp_path / "conv")
    conv.select("messages").write.json(path)
    back = io.read_conversations(spark, path)
    assert back.count() == conv.count()


def test_conversation_missing_messages_raises(spark, tmp_path):
    p = tmp_path / "bad.jsonl"
    p.write_text(json.dumps({"messages": [{"role": "user", "content": "x"}]}) + "\n" + json.dumps({"prompt": "y"}) + "\n")
    with pytest.raises(ValueError, match="prompt"):
        io.read_conversations(spark, str(p))


def test_comparisons_drop_incomplete(spark, tmp_path):
    p = tmp_path / "cmp.jsonl"
    good = {"comparison": {"prompt_conversation": [], "completion_A": [{"role": "assistant", "content": "a"}],
                           "completion_B": [{"role": "assistant", "content": "b"}]}, "label": "A"}
    p.write_text(json.dumps(good) + "\n" + json.dumps({"label": "B"}) + "\n")
    assert io.read_comparisons(spark, str(p)).count() == 1


def test_last_checkpoint(spark):
    log = spark.createDataFrame(
        [("a", 0, 1, "s1", None), ("b", 0, 5, None, "x"), ("c", 1, 2, "s3", None)], io.CHECKPOINT_LOG)
    assert io.last_checkpoint(log).first()["name"] == "c"


def test_lines_and_csv(spark, tmp_path):
    p = tmp_path / "words.txt"
    p.write_text("  apple \n\nbanana\n")
    assert [r.line for r in io.read_lines(spark, str(p)).collect()] == ["apple", "banana"]
    df = spark.createDataFrame([("m", 0.5)], "model_name string, mse double")
    out = str(tmp_path / "csv")
    io.write_eval_csv(df, out, ["model_name", "mse", "error"])
    assert spark.read.option("header", True).csv(out).columns == ["model_name", "mse", "error"]


def test_sink_never_overwrites(spark, tmp_path):
    out = str(tmp_path / "sink")
    df = spark.createDataFrame([("q", [("user", "a")]), ("r", None)], "query string, messages array<struct<role:string,content:string>>")
    io.write_conversations(df, out)
    io.write_conversations(df.withColumn("messages", F.array()), out)
    back = spark.read.json(out)
    assert back.columns == ["messages"] and [r.messages[0].content for r in back.collect()] == ["a"]


def test_cache(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    a = io.load_or_cache(spark, str(tmp_path), "ds", {"n": 3}, build)
    b = io.load_or_cache(spark, str(tmp_path), "ds", {"n": 3}, build)
    assert a.count() == b.count() == 3 and len(calls) == 1
    assert os.path.isdir(str(tmp_path))
