"""A stream gives what the batch gives, once."""

from pyspark.sql import functions as F

from riskweave.session import stage_path
from riskweave.sources.exports import split_to_batches
from riskweave.streaming import scoring

SCHEMA = "id long, v double"


def source(spark):
    rows = spark.range(100).select("id", (F.col("id") / 99.0).alias("v"))
    return rows, split_to_batches(rows, 5, 20, "id")


def test_stream_equals_batch_and_resumes(spark):
    rows, path = source(spark)
    model = scoring.ExpressionModel(F.col("v"))
    out, summary, state = (stage_path(spark, t) for t in ("out", "sum", "state"))
    run = lambda: scoring.score_stream(scoring.read_stream_dir(spark, path, SCHEMA, recursiveFileLookup=True), model, out, state, summary).awaitTermination()
    run()
    cols = ["id", "fraud_score", "fraud_flag", "risk_tier"]
    batch = sorted(tuple(r) for r in scoring.decide(rows, model).select(*cols).collect())
    read = lambda: sorted(tuple(r) for r in spark.read.parquet(out).select(*cols).collect())
    assert read() == batch
    assert spark.read.parquet(summary).agg(F.sum("rows"), F.count("*")).first() == (100, 5)
    # New files are picked up by the same checkpoint; old ones are not scored again.
    spark.range(100, 120).select("id", F.lit(0.9).alias("v")).write.mode("append").parquet(f"{path}/batch_id=9")
    run()
    assert len(read()) == 120


def test_replayed_batch_overwrites_itself(spark):
    rows, path = source(spark)
    model = scoring.ExpressionModel(F.col("v"))
    out = stage_path(spark, "out")
    for attempt in range(2):
        # A lost checkpoint replays every file under the same batch numbers.
        stream = scoring.read_stream_dir(spark, path, SCHEMA, recursiveFileLookup=True)
        scoring.score_stream(stream, model, out, stage_path(spark, f"state{attempt}")).awaitTermination()
    assert spark.read.parquet(out).count() == 100


def test_validation(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 0), (0, 0)], "label int, fraud_flag int")
    r = scoring.validate_stream(df, "label").first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"], r["precision"], r["recall"]) == (1, 1, 1, 1, 0.5, 0.5)
