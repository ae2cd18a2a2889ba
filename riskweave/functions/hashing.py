"""Reproducible pseudo-random order and numbers from a row's key.

md5 is used because any engine can recompute it, which makes every seeded
sample, split and fold checkable outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.functions.columns import col_of


def hash_order(*key, seed: int = 42) -> Column:
    """32 hex digits; sorting by them shuffles the rows."""
    parts = [col_of(k).cast("string") for k in key]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def hash_uniform(*key, seed: int = 42) -> Column:
    """Number in [0, 1) with 32 random bits."""
    head = F.substring(hash_order(*key, seed=seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def hash_int(*key, modulus, seed: int = 42) -> Column:
    """Integer in [0, modulus)."""
    head = F.substring(hash_order(*key, seed=seed), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(modulus) if isinstance(modulus, int) else modulus)
