"""Buffer shuffle of a stream (K1): a bounded buffer carried between micro-batches, strictly sequential batches.

The buffer has ``size`` slots. The first rows fill them; every later row takes a slot drawn from (seed, position), and
the row that it replaces leaves the buffer. When the stream has reached its declared length, the rows still held
leave in a drawn order of their slots. The row that arrives at position p pushes out the row of place p - size, so
the places are dense whatever the micro-batches are, and place // batch is a strictly sequential batch index.

A slot's row depends on that slot alone: the state is keyed by groups of slots and spread over all tasks; it holds
positions only. Readers join the rows by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kiln.operators.ranking import hash_rank, md5_key
from kiln.streaming import replay

ROWS = "place long, position long"
#: Keys of the state: how many tasks may share the buffer.
SHARDS = 64


def slot(position: Column, size: int, seed: int) -> Column:
    drawn = F.conv(F.substring(md5_key(seed, position), 1, 8), 16, 10).cast("long") % size
    return F.when(position < size, position).otherwise(drawn)


def closing(spark: SparkSession, length: int, size: int, seed: int) -> DataFrame:
    """Virtual rows behind the declared length: one for each slot, in drawn order."""
    slots = spark.range(size).select(F.col("id").alias("slot"))
    ranked = hash_rank(slots, md5_key(f"{seed}:end", "slot"), ["slot"], "r")
    return ranked.select((F.col("r") - 1 + length).alias("position"), "slot", F.lit(True).alias("closing"))


def shuffle_stream(stream: DataFrame, size: int, length: int) -> DataFrame:
    """(place, position) of a stream (position, slot, closing)."""

    def pass_on(_key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], [])
        new = pd.concat(list(pdfs))
        if ((~new["closing"]) & (new["position"] >= length)).any():
            raise ValueError(f"the stream is longer than its declared length of {length}")
        at = np.concatenate([np.array(held[0], np.int64), new["slot"].to_numpy()])
        position = np.concatenate([np.array(held[1], np.int64), new["position"].to_numpy()])
        order = np.lexsort((position, at))
        at, position = at[order], position[order]
        leaves = np.append(at[1:] == at[:-1], False)
        out = pd.DataFrame({"place": position[1:][leaves[:-1]] - size, "position": position[leaves]})
        state.update((at[~leaves].tolist(), position[~leaves].tolist()))
        yield out[out["position"] < length]

    keyed = stream.withColumn("shard", F.pmod("slot", F.lit(SHARDS))).groupBy("shard")
    return keyed.applyInPandasWithState(pass_on, ROWS, "slots array<long>, positions array<long>", "append", GroupStateTimeout.NoTimeout)


class SequentialBatches:
    """Batches of a shuffled stream of declared length: read one after another, the incomplete last one dropped."""

    def __init__(self, rows: DataFrame, length: int, batch_size: int):
        if (n := rows.count()) != length:
            raise ValueError(f"the stream has {n} rows, not the declared {length}")
        self.rows = rows.withColumn("batch_idx", F.floor(F.col("place") / batch_size).cast("long"))
        self.length, self.batch_size, self.index = length, batch_size, -1

    def __len__(self) -> int:
        return self.length // self.batch_size

    def all(self) -> DataFrame:
        return self.rows.where(F.col("batch_idx") < len(self))

    def get_batch(self, index: int) -> DataFrame:
        if index != self.index + 1:
            raise ValueError(f"batches are read in order: {self.index + 1} is next, not {index}")
        if index >= len(self):
            raise IndexError(f"{len(self)} batches")
        self.index = index
        return self.rows.where(F.col("batch_idx") == index).orderBy("place")


def run_buffer_shuffle(parts: list[DataFrame], length: int, batch_size: int, out: str, size: int = 10_000, seed: int = 0) -> SequentialBatches:
    """Feed parts with a dense ``position`` from 0 on through the buffer and close it at the declared length."""
    spark = parts[0].sparkSession
    size = max(1, min(size, length))
    real = [p.select("position", slot(F.col("position"), size, seed).alias("slot"), F.lit(False).alias("closing")) for p in parts]
    replay.feed([*real, closing(spark, length, size, seed)], lambda s: shuffle_stream(s, size, length), out)
    return SequentialBatches(replay.rows(spark, out, ROWS), length, batch_size)
