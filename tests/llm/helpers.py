"""Small documents with the awkward cases, and brute-force versions of the operators."""

from __future__ import annotations

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")
BASE = ["alpha", "beta", "gamma", "delta", "épée", "zeta", "eta", "theta", "iota", "kappa", "über", "mu", "nu", "xi", "日本"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(BASE) + str(r.randrange(30)) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, key, pos): names that clash with internal ones; nulls, empty, long, repeated rows, ties."""
    long = prose(1, 3000)
    passage = prose(2, 60)
    rows = [
        (1, long), (2, long), (3, long[:9000] + " changed here " + long[9000:]), (4, None), (5, ""), (6, "   \n\t"), (7, "one"),
        (8, "one"), (9, "One"), (10, "two words"), (11, prose(3, 80) + " " + passage + " " + prose(4, 70)), (12, passage),
        (13, passage + "\n" + passage), (14, prose(5, 200)), (15, prose(5, 200).replace("alpha", "ALPHA", 1)), (None, prose(6, 120)),
        (16, prose(6, 120)), (17, "ab" * 600), (18, prose(7, 50) + " " + prose(7, 50)),
    ]
    base = prose(8, 150).split()
    for k in range(12):  # a group of near copies
        w = list(base)
        w[5 + 11 * k] = f"edit{k}"
        rows.append((100 + k, " ".join(w)))
    rows += [(20, prose(9, 90)), (20, prose(9, 90))]  # a row repeated as a whole
    return [(d, t, f"k{i % 3}", i) for i, (d, t) in enumerate(rows)]


SCHEMA = "doc_id long, text string, key string, pos int"


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def find(parent: dict, x):
    while parent[x] != x:
        x = parent[x]
    return x
