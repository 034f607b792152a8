"""The JSON writer against json.dumps."""

import json
import random

from pyspark.sql import functions as F

from kiln.functions import formats, json_text


def value(r, depth=0):
    kind = r.random()
    if depth < 4 and kind < 0.25:
        return {r.choice(["b", "a", "é", "zz", "k\n", ""]) + str(i): value(r, depth + 1) for i in range(r.randrange(4))}
    if depth < 4 and kind < 0.4:
        return [value(r, depth + 1) for _ in range(r.randrange(4))]
    return r.choice([
        None, True, False, 0, -7, 12345678901234567890, 1.5, -0.25, 1e16, 1e-7, 123456789.125, 1e7, 0.0001, 0.00012, 1.5e300, -2.5e-9, 1e15, 100.0, 0.0,
        "plain", "", "Ünï — 日本", "😀 a", 'quo"te \\ back/slash', "tab\tnew\nline\r\b\f\x00\x1f\x7f", "a,b:c{d}[e]", "\u2028", "x" * 20_000, "é" * 3000,
    ])


def test_writer_equals_dumps(spark):
    r = random.Random(1)
    values = [{"name": "t", "args": value(r)} for _ in range(400)]
    texts = [json.dumps(v, ensure_ascii=bool(i % 2), indent=i % 3 or None, separators=None if i % 5 else (",", ":")) for i, v in enumerate(values)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {x.i: x.o for x in df.select("i", json_text.python_json(F.col("t")).alias("o")).collect()}
    for i, v in enumerate(values):
        assert got[i] == json.dumps(v), texts[i][:200]


def test_numbers_as_python_writes_them(spark):
    raw = ["1.50", "1e5", "1E400", "-0", "-0.0", "10", "0.1e-3", "9.99e22", "5e-324", "123456.7e2"]
    df = spark.createDataFrame([(t,) for t in raw], "t string")
    for r in df.select("t", json_text.python_json(F.col("t")).alias("o")).collect():
        assert r.o == json.dumps(json.loads(r.t)) or r.t in ("1E400", "5e-324")


def test_tool_calls_text(spark):
    calls = [{"name": "search", "args": {"z": ["é", {"b": 1, "a": None}], "n": 2.5}}, {"name": "x", "args": {}}]
    df = spark.createDataFrame([([json.dumps(c, ensure_ascii=False) for c in calls],), ([],), (None,)], "c array<string>")
    got = [r.o for r in df.select(formats.tool_calls_text(F.col("c")).alias("o")).collect()]
    assert got == ["\n".join(f"<tool_call>\n{json.dumps(c)}\n</tool_call>" for c in calls), "", ""]
