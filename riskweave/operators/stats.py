"""Two-sample tests, PCA."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from riskweave.functions.columns import flag
from riskweave.operators.ordered import prefix_sums


def unpivot(df: DataFrame, keep: list[str], cols: list[str]) -> DataFrame:
    """Columns to rows (feature, value) in one pass."""
    doubled = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return doubled.unpivot(keep, cols, "feature", "value")


def kolmogorov_p(statistic: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Two-sided p-value from the limiting Kolmogorov distribution."""
    lam = F.sqrt(n1.cast("double") * n2 / (n1 + n2)) * statistic
    k_terms = F.transform(
        F.sequence(F.lit(1), F.lit(terms)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    series = F.aggregate(k_terms, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), series)))


def ks_two_sample(df: DataFrame, side: str, cols: list[str], first: str = "ref", partitions: int | None = None) -> DataFrame:
    """Largest gap between the two empirical distributions, per feature, on all rows.

    `side` tells the samples apart; rows equal to `first` form sample 1.
    """
    long = unpivot(df, [side], cols).where(F.col("value").isNotNull())
    is_first = F.when(F.col(side) == first, 1).otherwise(0)
    sums = {"a": F.sum(is_first), "b": F.sum(1 - is_first)}
    c = prefix_sums(long, ["feature"], "value", sums, partitions)
    gap = F.abs((F.col("a_before") + F.col("a")) / F.col("a_total") - (F.col("b_before") + F.col("b")) / F.col("b_total"))
    return (
        c.groupBy("feature")
        .agg(F.max(gap).alias("ks_statistic"), F.max("a_total").alias("n1"), F.max("b_total").alias("n2"))
        .withColumn("p_value", kolmogorov_p(F.col("ks_statistic"), F.col("n1"), F.col("n2")))
    )


def ks_drift_report(ks: DataFrame, alpha: float = 0.05) -> DataFrame:
    return ks.withColumn("drift_detected", flag(F.col("p_value") < alpha))


@F.pandas_udf(DoubleType())
def two_sided_normal_p(z: pd.Series) -> pd.Series:
    """P(|N(0,1)| >= |z|); called on one row per test."""
    return z.abs().map(lambda x: math.erfc(x / math.sqrt(2.0)))


def mann_whitney(df: DataFrame, side: str, c: str, first, partitions: int | None = None) -> DataFrame:
    """U of sample `first` and the tie-corrected, continuity-corrected normal p-value."""
    is_first = F.when(F.col(side) == first, 1).otherwise(0)
    clean = df.where(F.col(c).isNotNull()).select(side, c)
    ranked = prefix_sums(clean, [], c, {"a": F.sum(is_first), "n": F.count(F.lit(1))}, partitions)
    mid_rank = F.col("n_before") + (F.col("n") + 1) / 2
    n = F.col("n").cast("double")
    u = F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2
    n1, n2, total = F.col("n1").cast("double"), F.col("n2").cast("double"), F.col("n1").cast("double") + F.col("n2")
    spread = F.sqrt(n1 * n2 / 12.0 * ((total + 1) - F.col("ties") / (total * (total - 1))))
    excess = F.greatest(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, F.lit(0.0))
    return (
        ranked.agg(
            F.sum(F.col("a") * mid_rank).alias("rank_sum"),
            F.sum("a").alias("n1"),
            (F.max("n_total") - F.sum("a")).alias("n2"),
            F.sum(n * n * n - n).alias("ties"),
        )
        .withColumn("u", u)
        .withColumn("z", excess / spread)
        .select("u", "z", "n1", "n2")
        .withColumn("p_value", two_sided_normal_p("z"))
        .withColumn("significant", flag(F.col("p_value") < 0.05))
    )


def pca_fit(df: DataFrame, cols: list[str], k: int = 2, out: str = "pca"):
    """Standardise, then project on `k` components fitted on all rows: (model, projected frame)."""
    assembled = VectorAssembler(inputCols=cols, outputCol="_raw").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True).fit(assembled)
    scaled = scaler.transform(assembled)
    model = PCA(k=k, inputCol="_scaled", outputCol=out).fit(scaled)
    return model, model.transform(scaled).drop("_raw", "_scaled")
