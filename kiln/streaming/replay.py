"""A table as a stream of slices: each is appended to the source folder and consumed by a run of the query.

Every run starts from the checkpoint of the one before, so state, watermark and sink pass a restart between any two
slices. A slice may hold many files; a run takes all that is new, so results never depend on a half-listed folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def slices(df: DataFrame, by: str, n: int) -> list[DataFrame]:
    """``df`` cut into ``n`` ranges of the long column ``by`` of about equal size (bounds: one aggregate)."""
    cuts = df.agg(F.percentile_approx(by, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    out = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = df if low is None else df.where(F.col(by) > low)
        out.append(part if high is None else part.where(F.col(by) <= high))
    return out


def feed(parts: Iterable[DataFrame], build: Callable[[DataFrame], DataFrame], out: str, mode: str = "append") -> None:
    """Append each part to ``out/source`` and run ``build(stream)`` into ``out/rows`` until nothing new is left."""
    for part in parts:
        part.write.mode("append").parquet(f"{out}/source")
        stream = part.sparkSession.readStream.schema(part.schema).parquet(f"{out}/source")
        writer = build(stream).writeStream.outputMode(mode).format("parquet").option("path", f"{out}/rows")
        writer.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()


def rows(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """What the sink has committed."""
    return spark.read.schema(schema).parquet(f"{out}/rows")
