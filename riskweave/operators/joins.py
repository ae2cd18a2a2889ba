"""Equi-joins of the feature build. Strategy and skew splitting are left to adaptive execution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join(a: DataFrame, b: DataFrame, key: str | list[str]) -> DataFrame:
    return a.join(b, key, "left")


def flagged_accounts(df: DataFrame, src: str, dst: str, condition: Column) -> DataFrame:
    """Distinct accounts on either end of a flagged transaction; one pass over the table."""
    return (
        df.where(condition)
        .select(F.explode(F.array(F.col(src), F.col(dst))).alias("account"))
        .distinct()
    )


def mark_join(df: DataFrame, keys: DataFrame, c: str, out: str) -> DataFrame:
    """1 where `c` occurs in the first column of `keys`, else 0."""
    marked = keys.select(F.col(keys.columns[0]).alias("_k")).distinct().withColumn("_hit", F.lit(1))
    return (
        df.join(marked, F.col(c) == F.col("_k"), "left")
        .withColumn(out, F.coalesce("_hit", F.lit(0)))
        .drop("_k", "_hit")
    )


def join_features(vertices: DataFrame, key: str, *tables: DataFrame) -> DataFrame:
    """Left-join several feature tables that share one unique key."""
    return reduce(lambda a, b: a.join(b, key, "left"), tables, vertices)


def hconcat_by_id(frames: list[DataFrame], key: str) -> DataFrame:
    """Put score columns side by side by row id, never by position."""
    return reduce(lambda a, b: a.join(b, key), frames)


def rank_compare(a: DataFrame, b: DataFrame, item: str = "feature", rank: str = "rank") -> DataFrame:
    """Two ranked lists side by side."""
    left = a.select(rank, F.col(item).alias("left_item"))
    right = b.select(rank, F.col(item).alias("right_item"))
    return left.join(right, rank, "full").withColumns(
        {"left_item": F.coalesce("left_item", F.lit("N/A")), "right_item": F.coalesce("right_item", F.lit("N/A"))}
    )
