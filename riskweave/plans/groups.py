"""Aggregates, marts and boards."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import TIERS_3, hour_of_seconds, risk_tier, rounded, score_flag
from riskweave.operators import aggregates as agg
from riskweave.plans.registry import query
from riskweave.plans.views import CARDS, V_NAMES, VECTORS, accounts, cards, rnd, vectors


@query("health_check", """
WITH p AS (
  SELECT 'orders' AS "table", count(*) AS rows, 6 AS columns, CAST(sum(CAST(o_orderstatus = 'P' AS INT)) AS BIGINT) AS positives, 'HEALTHY' AS status FROM orders
  UNION ALL SELECT 'labels', count(*), 3, CAST(sum(toxic) AS BIGINT), 'HEALTHY' FROM labels
  UNION ALL SELECT 'lineitem', count(*), 11, NULL, 'HEALTHY' FROM lineitem
  UNION ALL SELECT 'absent', NULL, NULL, NULL, 'ERROR')
SELECT *, round(positives * 100.0 / rows, 6) + 0.0 AS positive_pct FROM (
  SELECT * FROM p UNION ALL SELECT 'TOTAL', CAST(sum(rows) AS BIGINT), NULL, CAST(sum(positives) AS BIGINT), NULL FROM p)""")
def health_check(t):
    tables = {"orders": accounts(t), "labels": t.labels, "lineitem": t.lineitem, "absent": lambda: t.absent}
    report = agg.health_check(t.spark, tables, {"orders": "label", "labels": "toxic"})
    return report.withColumn("positive_pct", rounded("positive_pct"))


@query("class_distribution", f"""
SELECT event_type, count(*) AS rows, {rnd('count(*) * 100.0 / (SELECT count(*) FROM events)')} AS share_pct FROM events GROUP BY event_type""")
def class_distribution(t):
    return agg.class_distribution(t.events, "event_type").withColumn("share_pct", rounded("share_pct"))


@query("rate_by_category", f"""
SELECT o_orderpriority, CAST(sum(CAST(o_orderstatus = 'P' AS INT)) AS BIGINT) AS positives, count(*) AS rows,
  {rnd("sum(CAST(o_orderstatus = 'P' AS INT)) * 100.0 / count(*)")} AS rate_pct FROM orders GROUP BY o_orderpriority""")
def rate_by_category(t):
    return agg.rate_by(accounts(t), "o_orderpriority", "label").orderBy(F.col("rate_pct").desc()).withColumn("rate_pct", rounded("rate_pct"))


HOURLY = f"""SELECT CAST((time_s % 86400) // 3600 AS INT) AS hour, CAST(sum(label) AS BIGINT) AS positives, count(*) AS rows,
  sum(label) * 100.0::DOUBLE / count(*) AS rate_pct FROM {CARDS} GROUP BY 1"""


def hourly(t):
    return agg.rate_by(cards(t), hour_of_seconds("time_s"), "label", "hour")


@query("rate_by_hour", f"SELECT hour, positives, rows, {rnd('rate_pct')} AS rate_pct FROM ({HOURLY})")
def rate_by_hour(t):
    return hourly(t).withColumn("rate_pct", rounded("rate_pct"))


@query("rate_by_step", f"""
SELECT o_orderdate, CAST(sum(CAST(o_orderstatus = 'P' AS INT)) AS BIGINT) AS positives, count(*) AS rows,
  {rnd("sum(CAST(o_orderstatus = 'P' AS INT)) * 100.0 / count(*)")} AS rate_pct FROM orders GROUP BY o_orderdate""")
def rate_by_step(t):
    return agg.rate_by(accounts(t), "o_orderdate", "label").withColumn("rate_pct", rounded("rate_pct"))


@query("rate_band_means", f"""
SELECT {rnd('avg(rate_pct)')} AS overall, {rnd('avg(rate_pct) FILTER (hour BETWEEN 0 AND 6)')} AS night,
  {rnd('avg(rate_pct) FILTER (hour BETWEEN 9 AND 18)')} AS day FROM ({HOURLY})""")
def rate_band_means(t):
    out = agg.rate_band_means(hourly(t), "hour", {"night": (0, 6), "day": (9, 18)})
    return out.select(*[rounded(c).alias(c) for c in ("overall", "night", "day")])


@query("peak_hour", f"SELECT hour, {rnd('rate_pct')} AS rate_pct FROM ({HOURLY}) ORDER BY rate_pct DESC, hour LIMIT 1")
def peak_hour(t):
    return agg.peak_group(hourly(t), "hour").withColumn("rate_pct", rounded("rate_pct"))


@query("amount_by_class", f"""
SELECT label, count(*) AS rows, {rnd('avg(amount)')} AS mean, {rnd('stddev_samp(amount)')} AS std, {rnd('median(amount)')} AS median FROM {CARDS} GROUP BY label""")
def amount_by_class(t):
    out = agg.amount_by_class(cards(t), "amount", "label")
    return out.select("label", "rows", *[rounded(c).alias(c) for c in ("mean", "std", "median")])


@query("histogram", f"""
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
SELECT bin, {rnd('lo + bin * ((hi - lo) / 50)')} AS bin_start, n AS rows, {rnd('n / (total * ((hi - lo) / 50))', 9)} AS density
FROM (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS n FROM events, b GROUP BY 1), b,
  (SELECT count(*) AS total FROM events)""")
def histogram(t):
    out = agg.histogram(t.events, "value", 50)
    return out.select("bin", rounded("bin_start").alias("bin_start"), "rows", rounded("density", 9).alias("density"))


@query("histogram_by_class", f"""
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT o_orderstatus, CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 80)), 79) AS INT) AS bin, count(*) AS rows FROM orders, b GROUP BY 1, 2)
SELECT o_orderstatus, bin, {rnd('lo + bin * ((hi - lo) / 80)')} AS bin_start, rows,
  {rnd('rows / (sum(rows) OVER (PARTITION BY o_orderstatus) * ((hi - lo) / 80))', 12)} AS density FROM c, b""")
def histogram_by_class(t):
    out = agg.histogram(t.orders, "o_totalprice", 80, by="o_orderstatus")
    return out.select("o_orderstatus", "bin", rounded("bin_start").alias("bin_start"), "rows", rounded("density", 12).alias("density"))


_CORR = V_NAMES[:20] + ["label"]


@query("corr_matrix", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})')} AS corr FROM v" for i, a in enumerate(_CORR) for b in _CORR[i + 1:]
).join([f"WITH v AS (SELECT * FROM {VECTORS}) ", ")"]))
def corr_matrix(t):
    return agg.corr_matrix(vectors(t), _CORR).withColumn("corr", rounded("corr"))


@query("corr_with_label", f"WITH v AS (SELECT * FROM {VECTORS}), c AS (" + " UNION ALL ".join(
    f"SELECT '{v}' AS feature, corr({v}, label) AS corr FROM v" for v in V_NAMES
) + f") SELECT feature, {rnd('corr')} AS corr, CASE WHEN corr > 0 THEN 'up' ELSE 'down' END AS direction FROM c ORDER BY abs(c.corr) DESC LIMIT 10")
def corr_with_label(t):
    return agg.corr_with_label(vectors(t), V_NAMES, "label").withColumn("corr", rounded("corr"))


SCORED = f"(SELECT *, amount / 500.0::DOUBLE AS score, CAST(amount / 500.0::DOUBLE >= 0.5 AS INT) AS decision FROM {CARDS})"


def scored(t):
    return cards(t).withColumn("score", F.col("amount") / 500.0).withColumn("decision", score_flag("score"))


@query("mart_by_hour", f"""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS time_window, count(*) AS total_txns, CAST(sum(decision) AS BIGINT) AS fraud_txns,
  {rnd('avg(score)', 9)} AS avg_score, {rnd('sum(decision) * 100.0::DOUBLE / count(*)', 4)} AS fraud_rate_pct FROM {SCORED} GROUP BY 1""")
def mart_by_hour(t):
    out = agg.mart_by_hour(scored(t), "ts", "score", "decision")
    return out.withColumns({"avg_score": rounded("avg_score", 9), "fraud_rate_pct": rounded("fraud_rate_pct", 4)})


@query("mart_risk_summary", f"""
SELECT CASE WHEN score <= 0.5 THEN 'LOW' WHEN score <= 0.8 THEN 'MEDIUM' WHEN score <= 1 THEN 'HIGH' ELSE 'nan' END AS risk_tier, count(*) AS count,
  CAST(sum(label) AS BIGINT) AS actual_fraud, {rnd('avg(score)')} AS avg_score FROM {SCORED} GROUP BY 1""")
def mart_risk_summary(t):
    tiers = scored(t).withColumn("risk_tier", risk_tier("score", *TIERS_3))
    return agg.mart_risk_summary(tiers, "risk_tier", "label", "score").withColumn("avg_score", rounded("avg_score"))


@query("class_weights", f"""
SELECT CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives, CAST(floor(n / p) AS BIGINT) AS imbalance_ratio, {rnd('n / p')} AS pos_weight,
  {rnd('(n + p) / (2 * p)')} AS weight_1, {rnd('(n + p) / (2 * n)')} AS weight_0
FROM (SELECT CAST(sum(toxic) AS DOUBLE) AS p, CAST(sum(1 - toxic) AS DOUBLE) AS n FROM labels)""")
def class_weights(t):
    out = agg.class_weights(t.labels, "toxic")
    return out.select("positives", "negatives", "imbalance_ratio", *[rounded(c).alias(c) for c in ("pos_weight", "weight_1", "weight_0")])


@query("top_tokens", """
SELECT token, count(*) AS uses FROM (SELECT unnest(string_split_regex(text, '\\s+')) AS token FROM documents) WHERE token <> ''
GROUP BY token ORDER BY uses DESC, encode(token) LIMIT 20""")
def top_tokens(t):
    words = t.documents.select(F.explode(F.split("text", r"\s+")).alias("token")).where(F.col("token") != "")
    return agg.top_tokens(words, "token", 20)


@query("top_accounts", f"""
SELECT o_custkey, {rnd('sum(o_totalprice)', 3)} AS total_amount, count(*) AS orders FROM orders GROUP BY o_custkey ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 15""")
def top_accounts(t):
    totals = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total_amount"), F.count("*").alias("orders"))
    return agg.top_k(totals, "total_amount", 15, ["o_custkey"]).withColumn("total_amount", rounded("total_amount", 3))
