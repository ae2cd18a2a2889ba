"""The supplied tables seen as transaction data sets, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import epoch_seconds, flag, sliced

V_NAMES = [f"V{i}" for i in range(1, 65)]


def cards(t) -> DataFrame:
    """Time-ordered card transactions without an account: events."""
    return t.events.select(
        "event_id", "ts", "user_id", "event_type",
        epoch_seconds("ts").alias("time_s"),
        F.col("value").alias("amount"),
        flag(F.col("event_type") == "error").alias("label"),
    )


CARDS = """(SELECT event_id, ts, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS time_s,
  value AS amount, CAST(event_type = 'error' AS INT) AS label FROM events)"""


def accounts(t) -> DataFrame:
    """Account transactions: orders."""
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
        F.col("o_totalprice").alias("amount"),
        flag(F.col("o_orderstatus") == "P").alias("label"),
    )


ACCOUNTS = """(SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_totalprice AS amount,
  CAST(o_orderstatus = 'P' AS INT) AS label FROM orders)"""


def balances(t) -> DataFrame:
    """Balance before and after a transaction: list price and discounted price of a line item."""
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").alias("amount"),
        F.col("l_extendedprice").alias("old_balance"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("new_balance"),
        "l_discount",
    )


BALANCES = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity AS amount,
  l_extendedprice AS old_balance, l_extendedprice * (1.0::DOUBLE - l_discount) AS new_balance, l_discount FROM lineitem)"""


def vectors(t, positive: int = 0) -> DataFrame:
    """Anonymous numeric features V1..V64 with a rare class: embeddings."""
    return t.embeddings.select("vec_id", flag(F.col("label") == positive).alias("label"), *sliced("embedding", V_NAMES))


VECTORS = (
    "(SELECT vec_id, CAST(label = 0 AS INT) AS label, "
    + ", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS V{i}" for i in range(1, 65))
    + " FROM embeddings)"
)


def order_scores(t) -> DataFrame:
    """Four deterministic scores in [0, 1] per order, with a label."""
    price = F.col("o_totalprice")
    return t.orders.select(
        F.col("o_orderkey").alias("row_id"),
        flag(F.col("o_orderstatus") == "P").alias("label"),
        (price / 600000.0).alias("s_stack"),
        ((price % 1000.0) / 1000.0).alias("s_seq"),
        ((F.col("o_custkey") % 97) / 97.0).alias("s_boost"),
        (F.length("o_orderpriority") / 20.0).alias("s_iso"),
    )


ORDER_SCORES = """(SELECT o_orderkey AS row_id, CAST(o_orderstatus = 'P' AS INT) AS label,
  o_totalprice / 600000.0::DOUBLE AS s_stack, (o_totalprice % 1000.0::DOUBLE) / 1000.0::DOUBLE AS s_seq,
  (o_custkey % 97) / 97.0::DOUBLE AS s_boost, length(o_orderpriority) / 20.0::DOUBLE AS s_iso FROM orders)"""

SCORE_NAMES = ["s_stack", "s_seq", "s_boost", "s_iso"]
# Published fusion weights of the four components.
FUSION = {"s_stack": 0.35, "s_seq": 0.25, "s_boost": 0.20, "s_iso": 0.20}


def model_scores(t) -> DataFrame:
    """Long form (model, row_id, label, score)."""
    return order_scores(t).unpivot(["row_id", "label"], SCORE_NAMES, "model", "score")


MODEL_SCORES = "(" + " UNION ALL ".join(
    f"SELECT '{s}' AS model, row_id, label, {s} AS score FROM {ORDER_SCORES}" for s in SCORE_NAMES
) + ")"


def rnd(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"
