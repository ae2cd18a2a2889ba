"""Replayed files scored as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import flag, rounded
from riskweave.plans.registry import query
from riskweave.plans.views import rnd
from riskweave.session import stage_path
from riskweave.sources.exports import split_to_batches
from riskweave.streaming import scoring

SCORED = """(SELECT event_id, CAST(event_type = 'error' AS INT) AS label, value / 500.0::DOUBLE AS fraud_score,
  CAST(value / 500.0::DOUBLE >= 0.5 AS INT) AS fraud_flag, ts,
  CASE WHEN value / 500.0::DOUBLE <= 0.5 THEN 'LOW' WHEN value / 500.0::DOUBLE <= 0.8 THEN 'MEDIUM' WHEN value / 500.0::DOUBLE <= 1 THEN 'HIGH' ELSE 'nan' END AS risk_tier FROM events)"""


def value_model():
    return scoring.ExpressionModel(F.col("value") / 500.0)


def scored_stream(t, sink: str):
    """All events, cut into ten replay files, streamed through the scorer; returns the paths written."""
    n = t.events.count()
    size = -(-n // 10)
    events = t.events.select("event_id", "value", flag(F.col("event_type") == "error").alias("label"))
    source = split_to_batches(events, 10, size, "event_id")
    schema = "event_id long, value double, label int"
    stream = scoring.read_stream_dir(t.spark, source, schema, recursiveFileLookup=True)
    out, summary, state = (stage_path(t.spark, tag) for tag in ("scored", "summary", "state"))
    start = scoring.score_stream if sink == "batches" else scoring.score_stream_append
    options = {"summary": summary} if sink == "batches" else {}
    start(stream, value_model(), out, state, **options).awaitTermination()
    return out, summary


OUT_SCHEMA = "event_id long, value double, label int, fraud_score double, fraud_flag int, risk_tier string, scored_at timestamp"


@query("stream_score", f"SELECT event_id, label, {rnd('fraud_score')} AS fraud_score, fraud_flag, risk_tier FROM {SCORED}")
def stream_score(t):
    out, _ = scored_stream(t, "append")
    return t.spark.read.schema(OUT_SCHEMA).parquet(out).select("event_id", "label", rounded("fraud_score").alias("fraud_score"), "fraud_flag", "risk_tier")


@query("stream_batch_summary", f"""
SELECT count(*) AS rows, CAST(sum(fraud_flag) AS BIGINT) AS flagged, {rnd('avg(fraud_score)')} AS avg_score FROM (
  SELECT *, (row_number() OVER (ORDER BY md5(concat_ws('|', event_id, '42'))) - 1) // CAST(ceil((SELECT count(*) FROM events) / 10) AS BIGINT) AS b FROM {SCORED}) GROUP BY b""")
def stream_batch_summary(t):
    _, summary = scored_stream(t, "batches")
    rows = t.spark.read.schema("batch_id int, rows long, flagged long, avg_score double, batch int").parquet(summary)
    return rows.select("rows", "flagged", rounded("avg_score").alias("avg_score"))


@query("stream_validation", f"""
SELECT *, {rnd('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision, {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall,
  {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE 100.0 * tp / (tp + fn) END')} AS catch_rate_pct FROM (
  SELECT count(*) FILTER (label = 1 AND fraud_flag = 1) AS tp, count(*) FILTER (label = 0 AND fraud_flag = 1) AS fp,
    count(*) FILTER (label = 1 AND fraud_flag = 0) AS fn, count(*) FILTER (label = 0 AND fraud_flag = 0) AS tn FROM {SCORED})""")
def stream_validation(t):
    out, _ = scored_stream(t, "batches")
    scored = t.spark.read.schema(OUT_SCHEMA).parquet(out)
    valid = scoring.validate_stream(scored, "label")
    return valid.withColumns({c: rounded(c) for c in ("precision", "recall", "catch_rate_pct")})


@query("stream_hourly", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, count(*) AS rows, CAST(sum(fraud_flag) AS BIGINT) AS flagged,
  {rnd('sum(fraud_flag) * 100.0 / count(*)')} AS rate_pct FROM {SCORED}
GROUP BY date_trunc('hour', ts) HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_hourly(t):
    """Hours the watermark has closed, appended by a windowed stream over the events file."""
    out, state = stage_path(t.spark, "hourly"), stage_path(t.spark, "state")
    stream = scoring.read_stream_dir(t.spark, t.sf_dir, t.events.schema, pathGlobFilter="events.parquet")
    rates = scoring.hourly_rate(scoring.decide(stream, value_model()), "ts")
    query = rates.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).option("path", out)
    query.trigger(availableNow=True).start().awaitTermination()
    rows = t.spark.read.schema("hour timestamp, rows long, flagged long, rate_pct double").parquet(out)
    return rows.select(F.date_format("hour", "yyyy-MM-dd HH:00").alias("hour"), "rows", "flagged", rounded("rate_pct").alias("rate_pct"))
