"""Registry of end-to-end queries: a Spark plan and its DuckDB oracle SQL.

Every plan takes ``(spark, sf_dir)``, reads the driver tables (or data Spark
derives from them) and returns a DataFrame with scalar columns whose names
equal those of the oracle SQL. Plans without an oracle are checked by row
count and by unit tests against a plain-Python model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    plan: Plan
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn`` as query ``name`` covering operator ids ``ops``."""

    def wrap(fn: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql.strip() if sql else None, tuple(ops.split()))
        return fn

    return wrap


def load_all() -> dict[str, Entry]:
    # Import for the registration side effect.
    from kiln.plans import (  # noqa: F401
        sft,
        splits,
        rl,
        prefs,
        retrieval,
        grading,
        data,
        streams,
        parse,
        rows,
    )

    return REGISTRY
