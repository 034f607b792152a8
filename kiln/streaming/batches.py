"""Count- and version-based micro-batching on Structured Streaming (K1, K3, K6; K1's buffer, K2 and K4 have modules of their own).

The reference streams by *counts* (fixed batches, "emit when N groups are
ready") and by *versions* (drop trajectories sampled too many steps ago), not
by event time. Both are written as ``foreachBatch`` jobs:

* every micro-batch is ranked in a seeded shuffle order (distributed, see
  ``shuffle_rank``) and numbered after the rows already committed, so batch
  ``i`` holds positions ``[i·b, (i+1)·b)`` across micro-batch boundaries;
* the committed row count lives in a small ledger table (one row per epoch)
  next to the output; a replayed epoch overwrites its own partition and
  ledger row, so the sink is idempotent and survives lost executors;
* a batch is complete when it holds ``b`` rows; readers only take complete
  batches (drop-last, K1) or every batch (keep-last).

Output and checkpoint folders live under the session's shared checkpoint
directory unless given.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators import split
from kiln.session import ensure_checkpoint_dir
from kiln.sources.io import read_if_there


def scratch_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:8]}")


def _ledger_offset(spark: SparkSession, ledger: str, epoch: int) -> int:
    led = read_if_there(spark, ledger)
    if led is None:  # first epoch: no ledger yet
        return 0
    row = led.filter(F.col("epoch") < epoch).agg(F.sum("rows").alias("n")).first()
    return int(row["n"] or 0)


def count_batches_writer(out: str, batch_size: int, id_col: str, seed: int = 0):
    """foreachBatch function: number rows into fixed batches across micro-batches (K1)."""
    ledger = os.path.join(out, "_ledger")
    data = os.path.join(out, "rows")

    def write(mb: DataFrame, epoch: int) -> None:
        spark = mb.sparkSession
        offset = _ledger_offset(spark, ledger, epoch)
        ranked = split.shuffle_rank(mb, seed, id_col, "mb_rank")
        pos = F.col("mb_rank") + F.lit(offset)
        rows = ranked.withColumn("position", pos.cast("long")).withColumn(
            "batch_idx", F.floor((pos - 1) / F.lit(batch_size)).cast("long")
        ).withColumn("epoch", F.lit(epoch).cast("long")).drop("mb_rank")
        # one pass over the micro-batch: rows written, then their count read back
        rows.write.mode("overwrite").parquet(os.path.join(data, f"epoch={epoch}"))
        n = spark.read.parquet(os.path.join(data, f"epoch={epoch}")).count()
        spark.createDataFrame([(epoch, n)], "epoch long, rows long").write.mode("overwrite").parquet(
            os.path.join(ledger, f"e={epoch}")
        )

    return write


def read_batches(spark: SparkSession, out: str, batch_size: int, drop_last: bool = True) -> DataFrame:
    """Rows of the fixed batches written by ``count_batches_writer``; only complete ones when ``drop_last``."""
    rows = spark.read.parquet(os.path.join(out, "rows"))
    if not drop_last:
        return rows
    full = rows.groupBy("batch_idx").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == batch_size)
    return rows.join(full.select("batch_idx"), "batch_idx", "left_semi")


def run_count_batches(stream: DataFrame, batch_size: int, id_col: str, seed: int = 0, out: str | None = None,
                      trigger_available_now: bool = True) -> str:
    """Run a stream into fixed batches and wait for the available input (K1)."""
    spark = stream.sparkSession
    out = out or scratch_dir(spark, "count-batches")
    q = (
        stream.writeStream.foreachBatch(count_batches_writer(out, batch_size, id_col, seed))
        .option("checkpointLocation", os.path.join(out, "_checkpoint"))
        .trigger(availableNow=trigger_available_now)
        .start()
    )
    q.awaitTermination()
    return out


def staleness_writer(out: str, current_step: int, max_steps_off_policy: int, step_col: str = "sampler_step"):
    """K3: fresh rows to ``fresh/``, stale rows (current − sampler step > max) to ``requeue/``."""

    def write(mb: DataFrame, epoch: int) -> None:
        stale = (F.lit(current_step) - F.col(step_col)) > max_steps_off_policy
        tagged = mb.withColumn("_stale", stale).withColumn("epoch", F.lit(epoch).cast("long"))
        tagged.filter(~F.col("_stale")).drop("_stale").write.mode("overwrite").parquet(os.path.join(out, "fresh", f"epoch={epoch}"))
        tagged.filter(F.col("_stale")).drop("_stale").write.mode("overwrite").parquet(os.path.join(out, "requeue", f"epoch={epoch}"))

    return write


def run_staleness_filter(stream: DataFrame, current_step: int, max_steps_off_policy: int, step_col: str = "sampler_step",
                         out: str | None = None) -> str:
    spark = stream.sparkSession
    out = out or scratch_dir(spark, "staleness")
    q = (
        stream.writeStream.foreachBatch(staleness_writer(out, current_step, max_steps_off_policy, step_col))
        .option("checkpointLocation", os.path.join(out, "_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out


def run_step_metrics(stream: DataFrame, step_col: str, value_col: str, out: str | None = None) -> str:
    """K6: running per-step metrics (count, sum, mean) as a streaming aggregation in update mode.

    Each micro-batch's updated steps are appended with the epoch; the latest
    row per step is the current value (``read_step_metrics``).
    """
    spark = stream.sparkSession
    out = out or scratch_dir(spark, "step-metrics")
    agg = stream.groupBy(step_col).agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("value_sum"))

    def write(mb: DataFrame, epoch: int) -> None:
        mb.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(os.path.join(out, f"epoch={epoch}"))

    q = (
        agg.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", os.path.join(out, "_checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out


def read_step_metrics(spark: SparkSession, out: str, step_col: str) -> DataFrame:
    m = spark.read.parquet(out)
    latest = m.groupBy(step_col).agg(F.max_by(F.struct("n", "value_sum"), "epoch").alias("_v"))
    return latest.select(step_col, F.col("_v.n").alias("n"), F.col("_v.value_sum").alias("value_sum"),
                         (F.col("_v.value_sum") / F.col("_v.n")).alias("value_mean"))
