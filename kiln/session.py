"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint directory, memory) belong to
whoever launches the job; these helpers only fill in what is unset so the
same code runs on a laptop, in tests and on a large cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for correctness and plan quality. Only applied when the
# session does not already carry a value.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kiln") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Fill in the correctness defaults on an existing session where unset."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    # Session time zone must be UTC for timestamp_ntz -> timestamp casts to
    # agree with other engines; it is safe to force for our jobs.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``
    (read from the session, never overridden). Only when it is unset (tests,
    local runs) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="kiln-ckpt-", dir=os.environ.get("KILN_SCRATCH", "/tmp"))
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
