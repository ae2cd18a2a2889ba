"""Scoring of arriving transaction files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from riskweave.functions.columns import TIERS_3, risk_tier, score_flag
from riskweave.operators.evaluate import confusion


class ExpressionModel:
    """A score given by a column expression."""

    def __init__(self, expression):
        self.expression = expression

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        return df.withColumn(out, self.expression)


def read_stream_dir(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1, **options) -> DataFrame:
    """Stream of Parquet files with a declared schema, `files_per_batch` at a time."""
    return spark.readStream.schema(schema).options(maxFilesPerTrigger=files_per_batch, **options).parquet(path)


def decide(df: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Score, decision, tier and time of scoring; the same for a batch and for a stream."""
    return model.transform(df, "fraud_score").withColumns({
        "fraud_flag": score_flag("fraud_score", threshold),
        "risk_tier": risk_tier("fraud_score", *TIERS_3),
        "scored_at": F.current_timestamp(),
    })


def batch_summary(df: DataFrame) -> DataFrame:
    """Rows, flagged rows and mean score per micro-batch."""
    return df.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("fraud_flag").alias("flagged"), F.avg("fraud_score").alias("avg_score")
    )


def score_stream(stream: DataFrame, model, out: str, checkpoint: str, summary: str | None = None, threshold: float = 0.5, trigger: dict | None = None) -> StreamingQuery:
    """Start a query that writes every scored micro-batch to its own `batch_id` folder.

    A batch replayed after a failure overwrites the same folder, so the output holds
    each input row once. The summary is taken from the rows already written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = decide(batch, model, threshold)
        target = f"{out}/batch_id={batch_id}"
        scored.write.mode("overwrite").parquet(target)
        if summary:
            written = batch.sparkSession.read.schema(scored.schema).parquet(target).withColumn("batch_id", F.lit(batch_id))
            batch_summary(written).write.mode("overwrite").parquet(f"{summary}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_stream_append(stream: DataFrame, model, out: str, checkpoint: str, threshold: float = 0.5, trigger: dict | None = None) -> StreamingQuery:
    """The plain append sink: one exactly-once Parquet table without batch numbers."""
    return (
        decide(stream, model, threshold).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", out)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def validate_stream(df: DataFrame, label: str) -> DataFrame:
    """Confusion counts, precision and recall of the scored output."""
    return confusion(df, label, "fraud_flag")


def hourly_rate(stream: DataFrame, ts: str, watermark: str = "1 hour", width: str = "1 hour") -> DataFrame:
    """Rows, flagged rows and rate per event-time window; a window is final once the watermark passes it."""
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("fraud_flag").alias("flagged"))
        .select(F.col("w.start").alias("hour"), "rows", "flagged", (F.col("flagged") * 100.0 / F.col("rows")).alias("rate_pct"))
    )
