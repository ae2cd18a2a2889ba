"""Append-only run log: one row per metric, parameter or tag of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.layers import layer_path

RUN_SCHEMA = "run string, kind string, key string, value double, text string"


def run_rows(run: str, metrics: dict | None = None, params: dict | None = None, tags: dict | None = None) -> list[tuple]:
    rows = [(run, "metric", k, float(v), None) for k, v in (metrics or {}).items()]
    rows += [(run, "param", k, None, str(v)) for k, v in (params or {}).items()]
    return rows + [(run, "tag", k, None, str(v)) for k, v in (tags or {}).items()]


def append_run(spark: SparkSession, run: str, metrics=None, params=None, tags=None, name: str = "runs") -> None:
    rows = spark.createDataFrame(run_rows(run, metrics, params, tags), RUN_SCHEMA)
    append_rows(rows, name)


def append_rows(rows: DataFrame, name: str = "runs") -> None:
    rows.write.mode("append").parquet(layer_path(rows.sparkSession, "gold", name))


def read_runs(spark: SparkSession, name: str = "runs") -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(layer_path(spark, "gold", name))


def metrics_to_rows(suite: DataFrame, run: str, metrics: list[str]) -> DataFrame:
    """Wide metric table (one row per model) to run-log rows."""
    long = suite.select(F.col(run).alias("run"), *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["run"], metrics, "key", "value"
    )
    return long.select("run", F.lit("metric").alias("kind"), "key", "value", F.lit(None).cast("string").alias("text"))


def leaderboard_wide(runs: DataFrame, metrics: list[str], order: str = "auc_roc", k: int = 50, default: str = "—") -> DataFrame:
    """Best `k` runs by one metric, metrics as columns rounded to 4 digits.

    Metrics asked for but never logged appear as the default text column.
    """
    known = [order, *[m for m in metrics if m != order]]
    wide = (
        runs.where(F.col("kind") == "metric")
        .groupBy("run").pivot("key", known).agg(F.first("value", ignorenulls=True))
        .na.drop(subset=[order])
        .orderBy(F.col(order).desc(), "run").limit(k)
    )
    logged = wide.agg(*[F.count(m).alias(m) for m in known]).first()
    return wide.select(
        F.col("run").alias("model"),
        *[F.round(m, 4).alias(m) if logged[m] else F.lit(default).alias(m) for m in metrics],
    )
