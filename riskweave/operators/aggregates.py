"""Exploratory aggregates and dashboard marts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import direction, hour_label, safe_ratio
from riskweave.operators.ordered import exact_quantiles
from riskweave.session import materialize, ship_package


def class_distribution(df: DataFrame, c: str) -> DataFrame:
    """Rows and share in percent per value."""
    counts = materialize(df.groupBy(c).agg(F.count(F.lit(1)).alias("rows")), "counts")
    total = counts.agg(F.sum("rows")).first()[0] or 0
    return counts.withColumn("share_pct", F.col("rows") * 100.0 / F.lit(float(total)))


def rate_by(df: DataFrame, group: str | Column, label: str, name: str | None = None) -> DataFrame:
    """Positives, rows and rate in percent per group."""
    key = F.col(group) if isinstance(group, str) else group
    name = name or group
    return (
        df.groupBy(key.alias(name))
        .agg(F.sum(label).alias("positives"), F.count(label).alias("rows"))
        .withColumn("rate_pct", safe_ratio(F.col("positives"), F.col("rows")) * 100)
    )


def rate_band_means(rates: DataFrame, key: str, bands: dict[str, tuple[int, int]]) -> DataFrame:
    """Unweighted mean of the group rates, over all groups and inside inclusive key bands."""
    return rates.agg(
        F.avg("rate_pct").alias("overall"),
        *[F.avg(F.when(F.col(key).between(lo, hi), F.col("rate_pct"))).alias(n) for n, (lo, hi) in bands.items()],
    )


def peak_group(rates: DataFrame, key: str, metric: str = "rate_pct") -> DataFrame:
    """Group with the highest metric; the smallest key wins ties."""
    return rates.orderBy(F.col(metric).desc(), F.col(key)).limit(1).select(key, metric)


def amount_by_class(df: DataFrame, c: str, label: str) -> DataFrame:
    moments = df.groupBy(label).agg(
        F.count(c).alias("rows"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")
    )
    medians = exact_quantiles(df.select(label, c), [label], c, {"median": 0.5})
    return moments.join(medians, label)


def histogram(df: DataFrame, c: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width density histogram over the column's whole range; the last bin is closed."""
    keys = [by] if by else []
    low, high = df.agg(F.min(c), F.max(c)).first()
    width = (high - low) / bins if high is not None and high > low else 1.0
    start = low if low is not None else 0.0
    index = F.least(F.floor((F.col(c) - F.lit(start)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    if by:
        totals = counts.groupBy(by).agg(F.sum("rows").alias("_n"))
        counts = counts.join(totals, by)
    else:
        counts = counts.withColumn("_n", F.lit(counts.agg(F.sum("rows")).first()[0]))
    return counts.select(
        *keys, "bin",
        (F.lit(start) + F.col("bin") * F.lit(width)).alias("bin_start"),
        "rows",
        (F.col("rows") / (F.col("_n") * F.lit(width))).alias("density"),
    )


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every pair (a, b, corr), each over the rows where both are present.

    A task multiplies the matrix of its rows with itself, once for the values and once for
    what is present, and passes on a few sums for each pair. Values are taken relative to
    the columns' means, so sums of large numbers lose nothing. A constant column gives null.
    """
    number = lambda c: F.col(c).cast("double")
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    wide = df.select(*[(number(c) - F.lit(float(means[c] or 0.0))).alias(f"c{i}") for i, c in enumerate(cols)])
    first, second = np.triu_indices(len(cols), 1)
    names = ["n", "x", "y", "xx", "yy", "xy"]

    def run(batches):
        sums = np.zeros((len(names), len(first)))
        for rows in batches:
            x = np.column_stack([rows.column(i).to_numpy(zero_copy_only=False) for i in range(len(cols))])
            there = ~np.isnan(x)
            x, m = np.where(there, x, 0.0), there.astype(np.float64)
            one, two = x.T @ m, (x * x).T @ m
            for k, full in enumerate((m.T @ m, one, one.T, two, two.T, x.T @ x)):
                sums[k] += full[first, second]
        yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second), *[pa.array(s) for s in sums]], names=["i", "j", *names])

    ship_package(df.sparkSession)
    parts = wide.mapInArrow(run, "i long, j long, " + ", ".join(f"{c} double" for c in names))
    n, x, y, xx, yy, xy = (F.col(c) for c in names)
    spread = lambda a, aa: F.when(aa * n - a * a > 1e-12 * aa * n, aa * n - a * a)
    name = F.array(*[F.lit(c) for c in cols])
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names]).select(
        F.get(name, F.col("i").cast("int")).alias("a"), F.get(name, F.col("j").cast("int")).alias("b"),
        ((xy * n - x * y) / F.sqrt(spread(x, xx) * spread(y, yy))).alias("corr"),
    )


def corr_with_label(df: DataFrame, cols: list[str], label: str, k: int = 10) -> DataFrame:
    wide = df.agg(*[F.corr(c, label).alias(c) for c in cols])
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr")) for c in cols])
    return (
        wide.select(F.inline(entries))
        .withColumn("direction", direction("corr"))
        .orderBy(F.abs("corr").desc(), "feature")
        .limit(k)
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Class counts, imbalance ratio, positive weight and 'balanced' class weights, in one row."""
    pos, neg = F.col("positives"), F.col("negatives")
    n = pos + neg
    return (
        df.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("positives"),
               F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("negatives"))
        .select(
            "positives", "negatives",
            F.floor(F.try_divide(neg, pos)).cast("long").alias("imbalance_ratio"),
            F.try_divide(neg, pos).alias("pos_weight"),
            F.try_divide(n, 2 * pos).alias("weight_1"),
            F.try_divide(n, 2 * neg).alias("weight_0"),
        )
    )


def top_tokens(df: DataFrame, token: str | Column, k: int = 5) -> DataFrame:
    """Most frequent values; ties in alphabetical order."""
    key = F.col(token) if isinstance(token, str) else token
    return (
        df.groupBy(key.alias("token")).agg(F.count(F.lit(1)).alias("uses"))
        .orderBy(F.col("uses").desc(), "token").limit(k)
    )


def top_k(df: DataFrame, c: str, k: int, tie: list[str], ascending: bool = False) -> DataFrame:
    first = F.col(c).asc() if ascending else F.col(c).desc()
    return df.orderBy(first, *tie).limit(k)


def mart_by_hour(df: DataFrame, ts: str, score: str, decision: str) -> DataFrame:
    return (
        df.groupBy(hour_label(ts).alias("time_window"))
        .agg(
            F.count(decision).alias("total_txns"),
            F.sum(decision).alias("fraud_txns"),
            F.avg(score).alias("avg_score"),
        )
        .withColumn("fraud_rate_pct", F.round(F.col("fraud_txns") / F.col("total_txns") * 100, 4))
    )


def mart_risk_summary(df: DataFrame, tier: str, label: str, score: str) -> DataFrame:
    """Only tiers that occur."""
    return df.groupBy(tier).agg(
        F.count(F.lit(1)).alias("count"), F.sum(label).alias("actual_fraud"), F.avg(score).alias("avg_score")
    )


def leaderboard_by_category(board: DataFrame, exclude: str | None = None) -> DataFrame:
    """Per category: models, best, mean, worst, and how many pass 0.97 and 0.95."""
    kept = board.where(F.col("category") != exclude) if exclude else board
    best = F.struct(F.col("auc_roc"), F.col("model"))
    return kept.groupBy("category").agg(
        F.count(F.lit(1)).alias("models"),
        F.max("auc_roc").alias("best"),
        F.max_by("model", best).alias("best_model"),
        F.avg("auc_roc").alias("mean"),
        F.min("auc_roc").alias("worst"),
        F.min_by("model", best).alias("worst_model"),
        F.count_if(F.col("auc_roc") >= 0.97).alias("above_97"),
        F.count_if(F.col("auc_roc") >= 0.95).alias("above_95"),
    )


def group_means(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), *[F.avg(c).alias(f"mean_{c}") for c in cols])


def _loaded(source) -> DataFrame | None:
    """The frame itself, or what a loader returns; None when loading fails."""
    if not callable(source):
        return source
    try:
        df = source()
        df.schema  # noqa: B018  resolves the path and the columns
        return df
    except PySparkException:
        return None


def health_check(spark: SparkSession, tables: dict, label: str | dict | None = None) -> DataFrame:
    """Rows, columns, positives and status per table, plus a TOTAL row.

    `tables` maps a name to a frame or to a function that loads it; a table that
    cannot be loaded is reported as ERROR instead of stopping the check.
    """
    labels = label if isinstance(label, dict) else {name: label for name in tables}
    report = spark.createDataFrame([], "table string, rows long, columns int, positives long, status string")
    for name, source in tables.items():
        df, c = _loaded(source), labels.get(name)
        if df is None:
            row = spark.range(1).select(F.lit(name).alias("table"), F.lit("ERROR").alias("status"))
        else:
            positives = F.sum(F.col(c).cast("long")) if c in df.columns else F.lit(None).cast("long")
            row = df.agg(F.count(F.lit(1)).alias("rows"), positives.alias("positives")).select(
                F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns"), "positives",
                F.lit("HEALTHY").alias("status"),
            )
        report = report.unionByName(row, allowMissingColumns=True)
    report = materialize(report, "health")
    total = report.agg(F.sum("rows").alias("rows"), F.sum("positives").alias("positives")).withColumn("table", F.lit("TOTAL"))
    return report.unionByName(total, allowMissingColumns=True).withColumn(
        "positive_pct", F.try_divide(F.col("positives") * 100.0, F.col("rows"))
    )
