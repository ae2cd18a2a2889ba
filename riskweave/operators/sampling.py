"""Seeded samples, splits and folds that do not move the table.

All of them compare a row's key hash with exact cut values (see `hash_cuts`), so
row counts are exact and the selection itself is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import flag
from riskweave.functions.hashing import hash_order
from riskweave.operators.ordered import hash_cuts


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def sample_n(df: DataFrame, n: int, key, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, without replacement."""
    keys = _keys(key)
    row = hash_cuts(df, [], keys, seed, lambda total: F.array(F.least(total, F.lit(n)))).first()
    return df.where(hash_order(*keys, seed=seed) <= (row["cuts"][0] if row else ""))


def stratified_cap(df: DataFrame, label: str, n_neg: int, key, seed: int = 42) -> DataFrame:
    """All positives and at most `n_neg` negatives."""
    keys = _keys(key)
    negatives = df.where(F.col(label) == 0)
    row = hash_cuts(negatives, [], keys, seed, lambda total: F.array(F.least(total, F.lit(n_neg)))).first()
    kept = hash_order(*keys, seed=seed) <= (row["cuts"][0] if row else "")
    return df.where((F.col(label) == 1) | ((F.col(label) == 0) & kept))


def _with_cuts(df: DataFrame, label: str, keys: list[str], seed: int, ranks) -> DataFrame:
    cuts = hash_cuts(df, [label], keys, seed, ranks).select(F.col(label).alias("_l"), "cuts")
    return df.join(cuts, F.col(label).eqNullSafe(F.col("_l"))).drop("_l")


def stratified_split(df: DataFrame, label: str, key, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `is_test`: round(test * rows) rows of every class are 1."""
    keys = _keys(key)
    marked = _with_cuts(df, label, keys, seed, lambda total: F.array(F.round(total * F.lit(test)).cast("long")))
    return marked.withColumn("is_test", flag(hash_order(*keys, seed=seed) <= F.col("cuts")[0])).drop("cuts")


def kfold(df: DataFrame, label: str, key, k: int = 5, seed: int = 42) -> DataFrame:
    """Add `fold` 0..k-1; every class is spread evenly."""
    keys = _keys(key)
    ranks = lambda total: F.array(*[F.floor(total * i / k).cast("long") for i in range(1, k)])
    marked = _with_cuts(df, label, keys, seed, ranks)
    h = hash_order(*keys, seed=seed)
    below = F.aggregate("cuts", F.lit(0), lambda acc, cut: acc + F.when(h > cut, 1).otherwise(0))
    return marked.withColumn("fold", below).drop("cuts")


def batch_ids(df: DataFrame, n: int, size: int, key, seed: int = 42) -> DataFrame:
    """The first n*size rows in hash order, numbered into `n` batches of `size` rows."""
    keys = _keys(key)
    ranks = lambda total: F.array(*[F.least(total, F.lit(size * i)) for i in range(1, n + 1)])
    row = hash_cuts(df, [], keys, seed, ranks).first()
    cuts = F.array(*[F.lit(c) for c in (row["cuts"] if row else [""])])
    h = hash_order(*keys, seed=seed)
    batch = F.aggregate(cuts, F.lit(0), lambda acc, cut: acc + F.when(h > cut, 1).otherwise(0))
    return df.withColumn("batch_id", batch).where(F.col("batch_id") < n)


def split_by_class(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label) == 1), df.where(F.col(label) == 0)


def edge_filter(df: DataFrame, c: str, values: list) -> DataFrame:
    return df.where(F.col(c).isin(values))


def having(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)
