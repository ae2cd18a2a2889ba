"""From feature columns to model input."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_int, hash_order, hash_uniform
from riskweave.operators.neighbors import knn_join
from riskweave.operators.ordered import hash_cuts
from riskweave.session import materialize


def feature_names(df: DataFrame, prefix: str, extra: list[str]) -> list[str]:
    """Columns with the prefix, then those of the whitelist that exist."""
    return [c for c in df.columns if c.startswith(prefix)] + [c for c in extra if c in df.columns]


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Null becomes 0, then one vector column."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df.na.fill(0.0, cols))


def _apply(df: DataFrame, exprs: dict) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def standardize(train: DataFrame, test: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Zero mean and unit population deviation, fitted on `train`; constants are only centred."""
    row = train.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    exprs = {c: (F.col(c) - F.lit(row[f"m_{c}"])) / F.lit(row[f"s_{c}"] or 1.0) for c in cols}
    return _apply(train, exprs), _apply(test, exprs)


def minmax_features(train: DataFrame, test: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Scale to [0, 1] over `train`; test rows may fall outside."""
    row = train.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    exprs = {c: (F.col(c) - F.lit(row[f"lo_{c}"])) / F.lit((row[f"hi_{c}"] - row[f"lo_{c}"]) or 1.0) for c in cols}
    return _apply(train, exprs), _apply(test, exprs)


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """'balanced' weights rows / (2 * class rows)."""
    pos, n = df.agg(F.count_if(F.col(label) == 1), F.count(F.lit(1))).first()
    weight = lambda k: n / (2.0 * k) if k else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, weight(pos)).otherwise(weight(n - pos)))


def smote(df: DataFrame, label: str, cols: list[str], key: str, ratio: float = 0.1, k: int = 5, seed: int = 42, exact: bool = True) -> DataFrame:
    """Add synthetic positives until positives = ratio * negatives.

    Each synthetic row lies between a positive and one of its k nearest positives; with
    `exact=False` one of those that the approximate join finds (none: the positive itself).
    (`key`, `_copy`) identifies a row; `_copy` is 0 for the given rows. Only `key`,
    `label` and `cols` are returned.
    """
    base = df.select(key, label, *[F.col(c).cast("double").alias(c) for c in cols])
    given = base.withColumn("_copy", F.lit(0))
    pos, neg = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    new = int(neg * ratio) - pos
    if new <= 0:
        return given
    if pos < 2:
        raise ValueError("a synthetic positive needs two positives to lie between")
    minority = materialize(
        base.where(F.col(label) == 1).select(F.col(key).alias("_id"), F.array(*cols).alias("_x")), "minority"
    )
    each, rest = divmod(new, pos)
    cut = hash_cuts(minority, [], ["_id"], seed, lambda n: F.array(F.lit(rest))).first()["cuts"][0]
    copies = F.lit(each) + F.when(hash_order("_id", seed=seed) <= cut, 1).otherwise(0)
    reach = min(k, pos - 1)
    near = knn_join(minority, minority, "_x", reach, "_id", "_id", exclude_self=True, exact=exact).select(
        F.col("query_id").alias("_id"), F.col("rank").alias("_rank"), F.col("neighbor_id").alias("_n")
    )
    planned = (
        minority.withColumn("_copies", copies).where(F.col("_copies") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .withColumn("_rank", (hash_int("_id", "_copy", modulus=reach, seed=seed) + 1).cast("int"))
        .withColumn("_gap", hash_uniform("_id", "_copy", seed=seed + 1))
    )
    other = minority.select(F.col("_id").alias("_n"), F.col("_x").alias("_y"))
    if not exact:
        # Fewer than `reach` neighbours may have been found.
        seen = near.groupBy("_id").agg(F.max("_rank").alias("_seen"))
        planned = planned.join(seen, "_id", "left").withColumn("_rank", ((F.col("_rank") - 1) % F.coalesce("_seen", F.lit(1)) + 1).cast("int")).drop("_seen")
        lone = planned.select("_id").distinct().join(near, "_id", "left_anti").select("_id", F.lit(1).alias("_rank"), F.col("_id").alias("_n"))
        near = near.unionByName(lone)
    mixed = planned.join(near, ["_id", "_rank"]).join(other, "_n").withColumn(
        "_z", F.zip_with("_x", "_y", lambda x, y: x + (y - x) * F.col("_gap"))
    )
    synthetic = mixed.select(
        F.col("_id").alias(key), F.lit(1).cast(base.schema[label].dataType).alias(label),
        *[F.col("_z")[i].alias(c) for i, c in enumerate(cols)], "_copy",
    )
    return given.unionByName(synthetic)
