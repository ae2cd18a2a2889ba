"""The layered build on the supplied tables, given the column names of the raw data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import epoch_seconds, flag, rounded
from riskweave.plans import medallion
from riskweave.plans.registry import query
from riskweave.plans.views import VECTORS, rnd, vectors
from riskweave.plans.windows import over


def cards(t):
    raw = t.events.select(
        "event_id", epoch_seconds("ts").alias("Time"), F.col("value").alias("Amount"), flag(F.col("event_type") == "error").alias("Class")
    )
    return medallion.gold_cards(medallion.to_silver(raw, medallion.RULES["creditcard"]), tie="event_id", anonymous=False)


C10 = over("", "time, event_id", 10)
CARDS = f"""(SELECT event_id, amount, class, avg(amount) {C10} AS m, stddev_samp(amount) {C10} AS s, max(amount) {C10} AS mx, count(amount) {C10} AS n,
  CAST((time % 86400) // 3600 AS INT) AS h
  FROM (SELECT DISTINCT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS time, value AS amount, CAST(event_type = 'error' AS INT) AS class FROM events))"""


@query("gold_cards", f"""
SELECT event_id, {rnd('ln(1 + amount)')} AS amount_log, {rnd('(amount - m) / (s + 1e-9)')} AS amount_zscore, mx AS amount_rolling_max,
  CAST(amount > 3 * m AS INT) AS amount_spike, h AS hour_of_day, CAST(h < 6 OR h > 22 AS INT) AS is_night, n AS tx_velocity_10,
  CAST(amount > 500 AS INT) AS high_amount_flag, class = 1 AS _is_fraud FROM {CARDS}""")
def gold_cards(t):
    out = cards(t)
    return out.select("event_id", rounded("amount_log").alias("amount_log"), rounded("amount_zscore").alias("amount_zscore"), "amount_rolling_max",
                      "amount_spike", "hour_of_day", "is_night", "tx_velocity_10", "high_amount_flag", "_is_fraud")


V28 = [f"V{i}" for i in range(1, 29)]
DATED = "(SELECT vec_id, label, " + ", ".join(V28) + f" FROM {VECTORS})"


@query("gold_cards_anonymous", f"""SELECT vec_id, {rnd('V1 * V2')} AS v1_v2_interaction, {rnd('V3 * V4')} AS v3_v4_interaction, {rnd('V14 * V17')} AS v14_v17_interaction,
  {rnd(' + '.join(V28[:5]))} AS v_sum_top5, {rnd(' + '.join(f'abs({v})' for v in V28))} AS v_abs_sum, label = 1 AS _is_fraud FROM {DATED}""")
def gold_cards_anonymous(t):
    """The features of card payments that are built from the anonymous columns."""
    raw = vectors(t).select("vec_id", F.col("vec_id").cast("double").alias("Time"), F.abs(F.col("V1") * 100).alias("Amount"), *V28, F.col("label").alias("Class"))
    out = medallion.gold_cards(medallion.to_silver(raw, medallion.RULES["creditcard"]), tie="vec_id")
    names = ["v1_v2_interaction", "v3_v4_interaction", "v14_v17_interaction", "v_sum_top5", "v_abs_sum"]
    return out.select("vec_id", *[rounded(c).alias(c) for c in names], "_is_fraud")


# Order priorities stand for payment types and mail domains.
_KIND = {"1-URGENT": "TRANSFER", "2-HIGH": "CASH_OUT", "3-MEDIUM": "PAYMENT", "4-NOT SPECIFIED": "CASH_IN", "5-LOW": "DEBIT"}
_MAIL = {"1-URGENT": "gmail.com", "2-HIGH": "yahoo.com", "3-MEDIUM": "hotmail.com", "5-LOW": "post.example"}


def _mapped(c: str, names: dict[str, str]):
    return F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(c)]


def _case(c: str, names: dict[str, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items()) + " END"


def mobile(t):
    accounts = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal")
    raw = t.orders.join(accounts, "o_custkey").select(
        "o_orderkey", F.datediff("o_orderdate", F.lit("1970-01-01")).alias("step"), _mapped("o_orderpriority", _KIND).alias("type"),
        F.col("o_totalprice").alias("amount"), F.col("o_custkey").cast("string").alias("nameOrig"), F.col("c_acctbal").alias("oldbalanceOrg"),
        (F.col("c_acctbal") - F.col("o_totalprice")).alias("newbalanceOrig"), F.lit("bank").alias("nameDest"), F.lit(0.0).alias("oldbalanceDest"),
        F.col("o_totalprice").alias("newbalanceDest"), flag(F.col("o_orderstatus") == "P").alias("isFraud"), F.lit(0).alias("isFlaggedFraud"),
    )
    return medallion.gold_mobile(medallion.to_silver(raw, medallion.RULES["paysim"]), tie="o_orderkey")


M10, M3 = over("o_custkey", "o_orderdate, o_orderkey", 10), over("o_custkey", "o_orderdate, o_orderkey", 3)
MOBILE = f"""(SELECT o_orderkey, o_totalprice AS amount, c_acctbal AS bal, CAST(o_orderstatus = 'P' AS INT) AS class, {_case('o_orderpriority', _KIND)} AS type,
  count(o_totalprice) {M3} AS c3, count(o_totalprice) {M10} AS c10, avg(o_totalprice) {M10} AS m, stddev_samp(o_totalprice) {M10} AS s
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("gold_mobile", f"""
SELECT o_orderkey, {rnd('(bal - amount) - bal', 3)} AS balance_diff_orig, {rnd('amount - 0.0', 3)} AS balance_diff_dest, CAST(bal = 0 AS INT) AS orig_balance_zero,
  1 AS dest_balance_zero, c3 AS tx_count_3steps, c10 AS tx_count_10steps, {rnd('m', 5)} AS amount_mean_10steps, {rnd('(amount - m) / (s + 1e-9)')} AS amount_zscore,
  CAST(type = 'TRANSFER' AS INT) AS is_transfer, CAST(type IN ('TRANSFER', 'CASH_OUT') AS INT) AS high_risk_type, CAST(amount > 3 * m AS INT) AS sudden_large_tx,
  CAST((bal - amount) - bal < -1000 AND bal <> 0 AS INT) AS account_drain, class AS "Class" FROM {MOBILE}""")
def gold_mobile(t):
    return mobile(t).select(
        "o_orderkey", rounded("balance_diff_orig", 3).alias("balance_diff_orig"), rounded("balance_diff_dest", 3).alias("balance_diff_dest"),
        "orig_balance_zero", "dest_balance_zero", "tx_count_3steps", "tx_count_10steps", rounded("amount_mean_10steps", 5).alias("amount_mean_10steps"),
        rounded("amount_zscore").alias("amount_zscore"), "is_transfer", "high_risk_type", "sudden_large_tx", "account_drain", "Class",
    )


def transactions(t):
    raw = t.orders.select(
        F.col("o_orderkey").alias("TransactionID"), epoch_seconds("o_orderdate").alias("TransactionDT"), F.col("o_totalprice").alias("TransactionAmt"),
        flag(F.col("o_orderstatus") == "P").alias("isFraud"), F.col("o_custkey").alias("card1"), _mapped("o_orderpriority", _MAIL).alias("P_emaildomain"),
        F.lit(None).cast("string").alias("R_emaildomain"), F.nullif(F.col("o_totalprice"), F.col("o_totalprice")).alias("V1"),
    )
    devices = t.lineitem.groupBy(F.col("l_orderkey").alias("TransactionID")).agg(
        F.sum("l_quantity").alias("id_01"), F.when(F.count_if(F.col("l_returnflag") == "R") > 0, "mobile").otherwise("desktop").alias("DeviceType")
    )
    silver = lambda d, n: medallion.to_silver(d, medallion.RULES[n])
    return medallion.gold_transactions(silver(raw, "ieee_transaction"), silver(devices, "ieee_identity"))


T5, T20 = over("o_custkey", "o_orderdate, o_orderkey", 5), over("o_custkey", "o_orderdate, o_orderkey", 20)
TRANSACTIONS = f"""(SELECT o_orderkey AS id, o_totalprice AS amount, CAST(o_orderstatus = 'P' AS INT) AS class, {_case('o_orderpriority', _MAIL)} AS mail, device,
  CAST(floor(epoch(o_orderdate)) AS BIGINT) // 86400 AS day, count(o_totalprice) {T5} AS c5, count(o_totalprice) {T20} AS c20, sum(o_totalprice) {T5} AS s5,
  avg(o_totalprice) {T20} AS m, stddev_samp(o_totalprice) {T20} AS s FROM orders LEFT JOIN (
    SELECT l_orderkey, CASE WHEN count(*) FILTER (l_returnflag = 'R') > 0 THEN 'mobile' ELSE 'desktop' END AS device FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"""


@query("gold_transactions", f"""
SELECT id AS "TransactionID", 0 AS tx_hour, CAST(day AS INT) AS tx_day, 1 AS is_night, CAST(day % 7 AS INT) AS tx_day_of_week, CAST(day % 7 >= 5 AS INT) AS is_weekend,
  c5 AS card_tx_count_5, c20 AS card_tx_count_20, {rnd('s5', 3)} AS card_amount_sum_5, {rnd('(amount - m) / (s + 1e-9)')} AS amount_zscore,
  CAST(amount > 3 * m AS INT) AS amount_spike, CASE WHEN mail IN ('gmail.com', 'yahoo.com', 'hotmail.com') THEN 0 WHEN mail IS NULL THEN 1 ELSE 2 END AS p_email_domain_risk,
  1 AS r_email_domain_risk, CAST(device IS NOT NULL AS INT) AS has_identity, CAST(device = 'mobile' AS INT) AS device_type_mobile, 0.0::DOUBLE AS "V1", class AS "Class"
FROM {TRANSACTIONS}""")
def gold_transactions(t):
    return transactions(t).select(
        "TransactionID", "tx_hour", "tx_day", "is_night", "tx_day_of_week", "is_weekend", "card_tx_count_5", "card_tx_count_20",
        rounded("card_amount_sum_5", 3).alias("card_amount_sum_5"), rounded("amount_zscore").alias("amount_zscore"), "amount_spike",
        "p_email_domain_risk", "r_email_domain_risk", "has_identity", "device_type_mobile", "V1", "Class",
    )


@query("gold_master", f"""
SELECT 'creditcard' AS dataset_source, count(*) AS rows, CAST(sum(class) AS BIGINT) AS positives, {rnd('sum(ln(1 + amount))', 3)} AS amount_log,
  CAST(sum(CAST(amount > 3 * m AS INT)) AS DOUBLE) AS amount_spike, CAST(sum(CAST(amount > 500 AS INT)) AS DOUBLE) AS high_amount_flag, CAST(sum(n) AS DOUBLE) AS tx_velocity_10 FROM {CARDS}
UNION ALL SELECT 'paysim', count(*), CAST(sum(class) AS BIGINT), {rnd('sum(ln(1 + amount))', 3)}, 0, 0, 0 FROM {MOBILE}
UNION ALL SELECT 'ieee_cis', count(*), CAST(sum(class) AS BIGINT), {rnd('sum(ln(1 + amount))', 3)}, CAST(sum(CAST(amount > 3 * m AS INT)) AS DOUBLE),
  CAST(sum(CAST(amount > 500 AS INT)) AS DOUBLE), CAST(sum(c20) AS DOUBLE) FROM {TRANSACTIONS}""")
def gold_master(t):
    """The master table, summed up by source."""
    master = medallion.build_master([cards(t), mobile(t), transactions(t)])
    total = lambda c: F.sum(F.col(c).cast("double")).alias(c)
    return master.groupBy("dataset_source").agg(
        F.count("*").alias("rows"), F.sum("Class").cast("long").alias("positives"), rounded(F.sum("amount_log"), 3).alias("amount_log"),
        total("amount_spike"), total("high_amount_flag"), total("tx_velocity_10"),
    )
