"""Decontamination.

Texts are matched exactly. The join key is (md5(text), text): the digest
spreads long strings evenly over shuffle partitions and the text equality
keeps the match exact. Catalyst/AQE choose broadcast vs shuffled join from
runtime sizes; nothing is broadcast by hint, so a large test set still works.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keyed(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_h", F.md5(F.col(text)))


def decontaminate(train: DataFrame, test: DataFrame, text: str = "text") -> DataFrame:
    """Drop training rows whose text equals any test text (left anti)."""
    t = _keyed(test.select(F.col(text).alias("_t")).distinct(), "_t")
    tr = _keyed(train, text)
    return tr.join(t, (tr["_h"] == t["_h"]) & (tr[text] == t["_t"]), "left_anti").drop("_h")


def contaminated(train: DataFrame, test: DataFrame, text: str = "text") -> DataFrame:
    """Training rows that still match a test text (left semi); must be empty."""
    t = _keyed(test.select(F.col(text).alias("_t")).distinct(), "_t")
    tr = _keyed(train, text)
    return tr.join(t, (tr["_h"] == t["_h"]) & (tr[text] == t["_t"]), "left_semi").drop("_h")
