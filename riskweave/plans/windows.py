"""Rolling features, positions and the flagship feature build."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import rounded, safe_ratio
from riskweave.operators import aggregates as agg
from riskweave.operators import clean, rolling
from riskweave.plans.registry import query
from riskweave.plans.views import ACCOUNTS, CARDS, accounts, cards, rnd

ORDER = ["o_orderdate", "o_orderkey"]
EVENT = ["ts", "event_id"]


def over(part: str, order: str, n: int) -> str:
    part = f"PARTITION BY {part} " if part else ""
    return f"OVER ({part}ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


ACC10 = over("o_custkey", "o_orderdate, o_orderkey", 10)
ACC3 = over("o_custkey", "o_orderdate, o_orderkey", 3)
ALL10 = over("", "ts, event_id", 10)
CARD5 = over("user_id", "ts, event_id", 5)
CARD20 = over("user_id", "ts, event_id", 20)


@query("order_risk", f"""
WITH w AS (
  SELECT *, avg(amount) {ACC10} AS m, stddev_samp(amount) {ACC10} AS s, count(amount) {ACC3} AS c3 FROM (SELECT DISTINCT * FROM {ACCOUNTS}))
SELECT o_orderpriority, CAST(sum(label) AS BIGINT) AS positives, count(*) AS rows, {rnd('sum(label) * 100.0 / count(*)')} AS rate_pct,
  CAST(sum(CAST(amount > 3 * m AS INT)) AS BIGINT) AS spikes, {rnd('avg((amount - m) / (s + 1e-9))')} AS mean_zscore, {rnd('avg(c3)')} AS mean_velocity
FROM w GROUP BY o_orderpriority""")
def order_risk(t):
    """Clean, add per-account velocity features, then summarise risk by priority."""
    silver = clean.dropna_subset(clean.dedupe(accounts(t)), ["o_orderkey", "amount"])
    silver = clean.cast_columns(silver, {"amount": "double", "label": "int"})
    gold = rolling.velocity(silver, ["o_custkey"], ORDER, {
        "mean_10": ("avg", "amount", 10), "std_10": ("std", "amount", 10), "count_3": ("count", "amount", 3),
    })
    gold = gold.withColumns({"spike": rolling.spike("amount", "mean_10"), "z": rolling.zscore("amount", "mean_10", "std_10")})
    return gold.groupBy("o_orderpriority").agg(
        F.sum("label").alias("positives"), F.count(F.lit(1)).alias("rows"),
        rounded(safe_ratio(F.sum("label"), F.count(F.lit(1))) * 100).alias("rate_pct"),
        F.sum("spike").alias("spikes"), rounded(F.avg("z")).alias("mean_zscore"), rounded(F.avg("count_3")).alias("mean_velocity"),
    )


@query("rolling_global", f"""
SELECT event_id, {rnd(f'avg(value) {ALL10}')} AS amount_rolling_mean, {rnd(f'stddev_samp(value) {ALL10}')} AS amount_rolling_std,
  max(value) {ALL10} AS amount_rolling_max, count(value) {ALL10} AS tx_velocity_10 FROM events""")
def rolling_global(t):
    out = rolling.rolling_global(t.events.select("event_id", "ts", "value"), EVENT, 10, {
        "amount_rolling_mean": ("avg", "value"), "amount_rolling_std": ("std", "value"),
        "amount_rolling_max": ("max", "value"), "tx_velocity_10": ("count", "value"),
    })
    return out.select("event_id", rounded("amount_rolling_mean").alias("amount_rolling_mean"),
                      rounded("amount_rolling_std").alias("amount_rolling_std"), "amount_rolling_max", "tx_velocity_10")


@query("rolling_zscore", f"""
SELECT event_id, {rnd('(value - m) / (s + 1e-9)')} AS zscore FROM (SELECT event_id, value, avg(value) {ALL10} AS m, stddev_samp(value) {ALL10} AS s FROM events)""")
def rolling_zscore(t):
    out = rolling.rolling_zscore(t.events.select("event_id", "ts", "value"), [], EVENT, "value", 10)
    return out.select("event_id", rounded("zscore").alias("zscore"))


@query("amount_spike", f"SELECT event_id, CAST(value > 3 * avg(value) {CARD20} AS INT) AS amount_spike FROM events")
def amount_spike(t):
    out = rolling.amount_spike(t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], EVENT, "value", 20)
    return out.select("event_id", "amount_spike")


@query("velocity_account", f"""
SELECT o_orderkey, count(amount) {ACC3} AS tx_count_3, count(amount) {ACC10} AS tx_count_10, {rnd(f'avg(amount) {ACC10}', 5)} AS amount_mean_10,
  {rnd(f'stddev_samp(amount) {ACC10}', 4)} AS amount_std_10, max(amount) {ACC10} AS amount_max_10 FROM {ACCOUNTS}""")
def velocity_account(t):
    out = rolling.velocity(accounts(t), ["o_custkey"], ORDER, {
        "tx_count_3": ("count", "amount", 3), "tx_count_10": ("count", "amount", 10), "amount_mean_10": ("avg", "amount", 10),
        "amount_std_10": ("std", "amount", 10), "amount_max_10": ("max", "amount", 10),
    })
    return out.select("o_orderkey", "tx_count_3", "tx_count_10", rounded("amount_mean_10", 5).alias("amount_mean_10"),
                      rounded("amount_std_10", 4).alias("amount_std_10"), "amount_max_10")


@query("velocity_card", f"""
SELECT event_id, count(amount) {CARD5} AS card_tx_count_5, count(amount) {CARD20} AS card_tx_count_20, {rnd(f'sum(amount) {CARD5}')} AS card_amount_sum_5,
  {rnd(f'sum(amount) {CARD20}')} AS card_amount_sum_20, {rnd(f'avg(amount) {CARD5}')} AS amount_rolling_mean, {rnd(f'stddev_samp(amount) {CARD5}')} AS amount_rolling_std,
  {rnd(f'(amount - avg(amount) {CARD20}) / (stddev_samp(amount) {CARD20} + 1e-9)')} AS amount_zscore FROM {CARDS}""")
def velocity_card(t):
    out = rolling.velocity(cards(t), ["user_id"], EVENT, {
        "card_tx_count_5": ("count", "amount", 5), "card_tx_count_20": ("count", "amount", 20),
        "card_amount_sum_5": ("sum", "amount", 5), "card_amount_sum_20": ("sum", "amount", 20),
        "amount_rolling_mean": ("avg", "amount", 5), "amount_rolling_std": ("std", "amount", 5),
        "mean_20": ("avg", "amount", 20), "std_20": ("std", "amount", 20),
    }).withColumn("amount_zscore", rolling.zscore("amount", "mean_20", "std_20"))
    exact = ["card_tx_count_5", "card_tx_count_20"]
    near = ["card_amount_sum_5", "card_amount_sum_20", "amount_rolling_mean", "amount_rolling_std", "amount_zscore"]
    return out.select("event_id", *exact, *[rounded(c).alias(c) for c in near])


HOT = "(SELECT event_id, ts, value AS amount, CASE WHEN user_id % 10 = 0 THEN user_id ELSE -1 END AS account FROM events)"
HOT5, HOT40 = over("account", "ts, event_id", 5), over("account", "ts, event_id", 40)


@query("velocity_hot_key", f"""
SELECT event_id, count(amount) {HOT5} AS tx_count_5, max(amount) {HOT40} AS amount_max_40, {rnd(f'sum(amount) {HOT40}', 2)} AS amount_sum_40, {rnd(f'stddev_samp(amount) {HOT5}', 4)} AS amount_std_5 FROM {HOT}""")
def velocity_hot_key(t):
    """Recent rows of each account where one account holds nine tenths of the table: it is cut into overlapping blocks."""
    account = F.when(F.col("user_id") % 10 == 0, F.col("user_id")).otherwise(F.lit(-1))
    events = t.events.select("event_id", "ts", F.col("value").alias("amount"), account.alias("account"))
    frames = {"tx_count_5": ("count", "amount", 5), "amount_max_40": ("max", "amount", 40), "amount_sum_40": ("sum", "amount", 40), "amount_std_5": ("std", "amount", 5)}
    out = rolling.velocity(events, ["account"], ["ts", "event_id"], frames, hot_rows=500, block_rows=200)
    return out.select("event_id", "tx_count_5", "amount_max_40", rounded("amount_sum_40", 2).alias("amount_sum_40"), rounded("amount_std_5", 4).alias("amount_std_5"))


@query("rate_moving_avg", f"""
WITH r AS (SELECT o_orderdate, sum(label) * 100.0::DOUBLE / count(*) AS rate FROM {ACCOUNTS} GROUP BY o_orderdate)
SELECT o_orderdate, {rnd('CASE WHEN count(*) OVER w = 10 THEN avg(rate) OVER w END')} AS moving_avg FROM r
WINDOW w AS (ORDER BY o_orderdate ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def rate_moving_avg(t):
    rates = agg.rate_by(accounts(t), "o_orderdate", "label").select("o_orderdate", "rate_pct")
    return rolling.moving_avg_full(rates, ["o_orderdate"], "rate_pct", 10).select("o_orderdate", rounded("moving_avg").alias("moving_avg"))


@query("positional_split", """
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(0.7 * (SELECT count(*) FROM events)) THEN 'ref' ELSE 'cur' END AS side FROM events""")
def positional_split(t):
    return rolling.positional_split(t.events.select("event_id", "ts"), EVENT, 0.7).select("event_id", "side")


WINDOW_RATES = f"""SELECT CAST((r - 1) // size + 1 AS INT) AS window, count(*) AS rows, avg(label) * 100 AS rate_pct FROM (
  SELECT label, row_number() OVER (ORDER BY ts, event_id) AS r, (SELECT count(*) // 10 FROM events) AS size FROM {CARDS}) WHERE r <= 10 * size GROUP BY 1"""


@query("rate_by_window", f'SELECT "window", rows, {rnd("rate_pct")} AS rate_pct FROM ({WINDOW_RATES})')
def rate_by_window(t):
    return rolling.rate_by_window(cards(t), EVENT, "label", 10).withColumn("rate_pct", rounded("rate_pct"))


@query("global_rank", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS rank FROM orders""")
def global_rank(t):
    return rolling.rank_by(t.orders, [F.col("o_totalprice").desc(), "o_orderkey"]).select("o_orderkey", "rank")
