"""Population stability between a reference and a current period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def psi(df: DataFrame, side: str, cols: list[str], first: str = "ref", bins: int = 10, eps: float = 1e-6) -> DataFrame:
    """Population stability index per feature, over equal-width bins of the pooled range.

    One aggregate finds all ranges; the second pass shuffles only bin counts.
    """
    bounds = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in cols for n, f in (("lo", F.min), ("hi", F.max))]).first()
    binned = []
    for c in cols:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        if lo is None or hi == lo:
            binned.append(F.when(F.col(c).isNotNull(), F.lit(0)).alias(c))
        else:
            place = F.floor((F.col(c) - F.lit(lo)) / F.lit((hi - lo) / bins))
            binned.append(F.least(place, F.lit(bins - 1)).cast("int").alias(c))
    is_first = F.when(F.col(side) == first, 1).otherwise(0)
    long = df.select(side, *binned).unpivot([side], cols, "feature", "bin").where(F.col("bin").isNotNull())
    counts = long.groupBy("feature", "bin").agg(F.sum(is_first).alias("r"), F.sum(1 - is_first).alias("p"))
    # Bins empty on both sides add (eps/n1' - eps/n2') * ln(n2'/n1') each; they are
    # counted instead of being generated as rows.
    totals = counts.groupBy("feature").agg(
        F.sum("r").alias("n1"), F.sum("p").alias("n2"), (F.lit(bins) - F.count(F.lit(1))).alias("empty")
    )
    d1, d2 = F.col("n1") + eps * bins, F.col("n2") + eps * bins
    r, p = (F.col("r") + eps) / d1, (F.col("p") + eps) / d2
    e1, e2 = F.lit(eps) / d1, F.lit(eps) / d2
    return (
        counts.join(totals, "feature")
        .groupBy("feature")
        .agg(
            (F.sum((p - r) * F.log(p / r)) + F.max(F.col("empty") * (e2 - e1) * F.log(e2 / e1))).alias("psi")
        )
    )


def psi_status(scores: DataFrame) -> DataFrame:
    return scores.withColumn(
        "status", F.when(F.col("psi") < 0.1, "Stable").when(F.col("psi") < 0.2, "Monitor").otherwise("RETRAIN")
    )


def drift_summary(ks: DataFrame, psi_scores: DataFrame, window_rates: DataFrame, ref_windows: int = 7) -> DataFrame:
    """One run-log row: drifted features by each test, and unweighted mean rates before and after."""
    drifted = ks.agg(F.coalesce(F.sum("drift_detected"), F.lit(0)).alias("n_ks_drift"))
    status = psi_scores.agg(
        F.count_if(F.col("status") == "RETRAIN").alias("n_psi_retrain"),
        F.count_if(F.col("status") == "Monitor").alias("n_psi_monitor"),
    )
    rates = window_rates.agg(
        F.avg(F.when(F.col("window") <= ref_windows, F.col("rate_pct"))).alias("ref_rate_pct"),
        F.avg(F.when(F.col("window") > ref_windows, F.col("rate_pct"))).alias("prod_rate_pct"),
    )
    names = [*drifted.columns, *status.columns, *rates.columns]
    parts = drifted.unionByName(status, allowMissingColumns=True).unionByName(rates, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in names])
