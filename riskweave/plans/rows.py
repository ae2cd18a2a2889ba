"""Row-level operators: layers, types, nulls, features, flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskweave.functions.columns import (
    TIERS_3, TIERS_4, clean_feature_name, fused, risk_tier, rounded, score_flag,
)
from riskweave.operators import clean, features, joins, sampling
from riskweave.plans.registry import query
from riskweave.plans.views import (
    BALANCES, CARDS, FUSION, ORDER_SCORES, V_NAMES, VECTORS, balances, cards, order_scores, rnd, vectors,
)
from riskweave.session import stage_path
from riskweave.sources import exports, layers
from riskweave.sources.layers import from_rows, read_csv


@query("csv_roundtrip", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_roundtrip(t):
    path = stage_path(t.spark, "csv")
    t.orders.write.option("header", True).csv(path)
    return read_csv(t.spark, path, t.orders.schema)


@query("layer_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def layer_roundtrip(t):
    name = stage_path(t.spark, "supplier").rsplit("/", 1)[1]
    layers.write_layer(t.supplier, "bronze", name)
    return layers.read_layer(t.spark, "bronze", name)


@query("bronze_stamp", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer_csv' AS _source FROM customer")
def bronze_stamp(t):
    return layers.stamp_ingest(t.customer, "customer_csv").drop("_ingested_at", "_ingestion_date")


@query("export_roundtrip", """
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty, 'csv' AS fmt FROM lineitem GROUP BY ALL
UNION ALL
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_quantity) AS DOUBLE) AS qty, 'parquet' AS fmt FROM lineitem GROUP BY ALL""")
def export_roundtrip(t):
    mart = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    paths = exports.export_table(mart, stage_path(t.spark, "export"), single_file=True)
    back = read_csv(t.spark, paths["csv"], mart.schema).withColumn("fmt", F.lit("csv"))
    return back.unionByName(t.spark.read.schema(mart.schema).parquet(paths["parquet"]).withColumn("fmt", F.lit("parquet")))


@query("summary_json", """
SELECT '{"volume":{"records":' || count(*) || ',"flagged":' || sum(CAST(o_orderstatus = 'P' AS INT))
  || '},"span":{"first":"' || strftime(min(o_orderdate), '%Y-%m-%d') || '","last":"' || strftime(max(o_orderdate), '%Y-%m-%d') || '"}}' AS summary
FROM orders""")
def summary_json(t):
    facts = t.orders.agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("flagged"),
        F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"),
    )
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return exports.summary_json(facts, {
        "volume": F.struct(F.col("n").alias("records"), "flagged"),
        "span": F.struct(day("a").alias("first"), day("b").alias("last")),
    })


@query("typed_rows", """SELECT o_orderpriority, kind, count(*) AS orders FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 1), ('5-LOW', NULL)) r(o_orderpriority, kind)
USING (o_orderpriority) GROUP BY ALL""")
def typed_rows(t):
    """Orders by a short typed list of priorities."""
    kinds = from_rows(t.spark, [("1-URGENT", 1), ("2-HIGH", 1), ("5-LOW", None)], "o_orderpriority string not null, kind int")
    return t.orders.join(kinds, "o_orderpriority").groupBy("o_orderpriority", "kind").agg(F.count(F.lit(1)).alias("orders"))


@query("cast_columns", """
SELECT o_orderkey, CAST(round(o_totalprice, 2) AS VARCHAR) IS NOT NULL AS has_text,
  TRY_CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority,
  TRY_CAST(substr(o_orderpriority, 3) AS DOUBLE) AS not_a_number,
  CAST(o_custkey AS INT) AS custkey FROM orders""")
def cast_columns(t):
    raw = t.orders.select(
        "o_orderkey", F.col("o_totalprice").isNotNull().alias("has_text"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
        F.expr("substring(o_orderpriority, 3)").alias("not_a_number"),
        F.col("o_custkey").alias("custkey"),
    )
    return clean.cast_columns(raw, {"priority": "int", "not_a_number": "double", "custkey": "int"})


@query("coerce_numeric", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS kind FROM events""")
def coerce_numeric(t):
    text = t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("kind"))
    return clean.coerce_numeric(text, ["k", "kind"])


@query("rename_std", 'SELECT event_id AS "TransactionID", value AS "Amount", ts AS "Time" FROM events')
def rename_std(t):
    raw = t.events.select("event_id", F.col("value").alias("amount"), "ts")
    return clean.rename_std(raw, {"event_id": "TransactionID", "amount": "Amount", "ts": "Time"})


@query("bool_label", "SELECT doc_id, toxic, toxic = 1 AS _is_fraud FROM labels")
def bool_label(t):
    return clean.label_flag(t.labels.select("doc_id", "toxic"), "toxic")


NULLED = "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, nullif(l_discount, 0.0) AS l_discount, nullif(l_tax, 0.0) AS l_tax, nullif(l_returnflag, 'N') AS l_returnflag FROM lineitem"


def with_nulls(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"), F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
    )


@query("fill_prefix", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(l_discount, 0.0) AS "V1", coalesce(l_tax, 0.0) AS "V2", l_returnflag FROM ({NULLED})""")
def fill_prefix(t):
    return clean.fill_prefix(with_nulls(t).withColumnsRenamed({"l_discount": "V1", "l_tax": "V2"}), "V", 0.0)


@query("fill_by_type", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, coalesce(l_discount, 0.0) AS l_discount, l_tax,
  coalesce(l_returnflag, 'UNKNOWN') AS l_returnflag FROM ({NULLED})""")
def fill_by_type(t):
    return clean.fill_by_type(with_nulls(t), skip=("l_orderkey", "l_tax"))


@query("dropna_subset", f"SELECT * FROM ({NULLED}) WHERE l_discount IS NOT NULL AND l_returnflag IS NOT NULL")
def dropna_subset(t):
    return clean.dropna_subset(with_nulls(t), ["l_discount", "l_returnflag"])


@query("dedupe_rows", """
WITH d AS (SELECT text, lang, source, n_chars FROM documents), k AS (SELECT DISTINCT * FROM d)
SELECT (SELECT count(*) FROM d) AS rows_before, (SELECT count(*) FROM k) AS rows_after, (SELECT count(*) FROM d) - (SELECT count(*) FROM k) AS removed""")
def dedupe_report(t):
    return clean.dedupe_with_report(t.documents.drop("doc_id"))[1].select(*[F.col(c).cast("long").alias(c) for c in ("rows_before", "rows_after", "removed")])


@query("dedupe_kept", "SELECT DISTINCT * FROM lineitem")
def dedupe_kept(t):
    return clean.dedupe(t.lineitem)


@query("amount_log", f"SELECT event_id, {rnd('ln(1 + value)')} AS amount_log FROM events")
def amount_log(t):
    return features.amount_math(t.events, "value").select("event_id", rounded("amount_log").alias("amount_log"))


@query("amount_math", f"SELECT o_orderkey, {rnd('ln(1 + o_totalprice)')} AS amount_log, {rnd('pow(o_totalprice, 2)', 2)} AS amount_squared FROM orders")
def amount_math(t):
    out = features.amount_math(t.orders, "o_totalprice")
    return out.select("o_orderkey", rounded("amount_log").alias("amount_log"), rounded("amount_squared", 2).alias("amount_squared"))


@query("interactions", f"""
SELECT vec_id, {rnd('V1 * V2', 9)} AS v1_v2_interaction, {rnd('V3 * V4', 9)} AS v3_v4_interaction,
  {rnd('V14 * V17', 9)} AS v14_v17_interaction, {rnd('V1 + V2 + V3 + V4 + V5', 9)} AS v_sum_top5 FROM {VECTORS}""")
def interactions(t):
    out = features.interactions(vectors(t), [("V1", "V2"), ("V3", "V4"), ("V14", "V17")])
    out = features.row_sum(out, V_NAMES[:5], "v_sum_top5")
    names = ["v1_v2_interaction", "v3_v4_interaction", "v14_v17_interaction", "v_sum_top5"]
    return out.select("vec_id", *[rounded(n, 9).alias(n) for n in names])


@query("abs_sum", f"SELECT vec_id, {rnd(' + '.join(f'abs(V{i})' for i in range(1, 65)))} AS v_abs_sum FROM {VECTORS}")
def abs_sum(t):
    return features.abs_sum(vectors(t), V_NAMES).select("vec_id", rounded("v_abs_sum").alias("v_abs_sum"))


@query("time_features", f"""
SELECT event_id, tx_hour, tx_day, CAST(tx_hour < 6 OR tx_hour > 22 AS INT) AS is_night,
  tx_day % 7 AS tx_day_of_week, CAST(tx_day % 7 >= 5 AS INT) AS is_weekend
FROM (SELECT event_id, CAST((time_s % 86400) // 3600 AS INT) AS tx_hour, CAST(time_s // 86400 AS INT) AS tx_day FROM {CARDS})""")
def time_features(t):
    out = features.time_features(cards(t), "time_s")
    return out.select("event_id", "tx_hour", "tx_day", "is_night", "tx_day_of_week", "is_weekend")


@query("amount_flags", """
SELECT event_id, CAST(value > 100 AS INT) AS high_amount_flag, CAST(value > 300 AS INT) AS very_high_amount FROM events""")
def amount_flags(t):
    out = features.amount_flags(t.events, "value", {"high_amount_flag": 100, "very_high_amount": 300})
    return out.select("event_id", "high_amount_flag", "very_high_amount")


BALANCE_SQL = f"""SELECT *, new_balance - old_balance AS balance_diff_orig, amount / (old_balance + 1e-9) AS balance_ratio_orig,
  CAST(old_balance = 0 AS INT) AS orig_balance_zero FROM {BALANCES}"""
LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
LINE_COLS = LINE.split(", ")


@query("balance_features", f"""
SELECT {LINE}, {rnd('balance_diff_orig')} AS balance_diff_orig, {rnd('balance_ratio_orig', 9)} AS balance_ratio_orig, orig_balance_zero FROM ({BALANCE_SQL})""")
def balance_features(t):
    out = features.balance_features(balances(t), "old_balance", "new_balance", "amount")
    return out.select(*LINE_COLS, rounded("balance_diff_orig").alias("balance_diff_orig"),
                      rounded("balance_ratio_orig", 9).alias("balance_ratio_orig"), "orig_balance_zero")


@query("rule_flags", f"""
SELECT {LINE}, CAST(balance_diff_orig < -1000 AND orig_balance_zero = 0 AS INT) AS account_drain,
  CAST(amount >= 50 AND l_discount = 0 AS INT) AS full_price_bulk FROM ({BALANCE_SQL})""")
def rule_flags(t):
    base = features.balance_features(balances(t), "old_balance", "new_balance", "amount")
    out = features.rule_flags(base, {
        "account_drain": features.account_drain("balance_diff_orig", "orig_balance_zero"),
        "full_price_bulk": (F.col("amount") >= 50) & (F.col("l_discount") == 0),
    })
    return out.select(*LINE_COLS, "account_drain", "full_price_bulk")


@query("one_hot", """
SELECT event_id, CAST(event_type = 'view' AS INT) AS is_view, CAST(event_type = 'click' AS INT) AS is_click,
  CAST(event_type = 'purchase' AS INT) AS is_purchase, CAST(event_type = 'signup' AS INT) AS is_signup,
  CAST(event_type = 'error' AS INT) AS is_error, CAST(event_type IN ('purchase', 'error') AS INT) AS high_risk_type FROM events""")
def one_hot(t):
    kinds = ["view", "click", "purchase", "signup", "error"]
    out = features.one_hot(t.events, "event_type", {f"is_{k}": k for k in kinds})
    out = features.group_flag(out, "event_type", ["purchase", "error"], "high_risk_type")
    return out.select("event_id", *[f"is_{k}" for k in kinds], "high_risk_type")


@query("case_risk", """
SELECT o_orderkey, CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 0 WHEN p IS NULL THEN 1 ELSE 2 END AS domain_risk
FROM (SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders)""")
def case_risk(t):
    raw = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("p"))
    return features.case_risk(raw, "p", ["1-URGENT", "2-HIGH"], "domain_risk").drop("p")


JOINED_LABELS = "SELECT d.doc_id, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)"


@query("left_join", JOINED_LABELS)
def left_join(t):
    right = clean.drop_meta(layers.stamp_ingest(t.labels, "labels"), ["_source", "_ingested_at", "_ingestion_date"])
    return joins.left_join(t.documents.select("doc_id", "n_chars"), right, "doc_id")


@query("presence_flag", f"""
SELECT doc_id, CAST(quality IS NOT NULL AS INT) AS has_identity, CAST(toxic = 1 AS INT) AS is_toxic FROM ({JOINED_LABELS})""")
def presence_flag(t):
    joined = joins.left_join(t.documents.select("doc_id"), t.labels, "doc_id")
    out = features.presence_flag(joined, "quality", "has_identity")
    return features.equality_flag(out, "toxic", 1, "is_toxic").select("doc_id", "has_identity", "is_toxic")


MASTER = ["amount", "amount_log", "high_amount_flag", "tx_hour", "dataset_source", "label"]


def master_parts(t):
    c = features.amount_flags(features.time_features(cards(t), "time_s"), "amount", {"high_amount_flag": 100})
    o = t.orders.select(F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").eqNullSafe("P").cast("int").alias("label"))
    l = t.lineitem.select(F.col("l_extendedprice").alias("amount"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    named = lambda d, n: features.amount_math(d, "amount").withColumn("dataset_source", F.lit(n))
    return [named(c, "cards"), named(o, "accounts"), named(l, "lines")]


MASTER_SQL = f"""
SELECT amount, {rnd('ln(1 + amount)')} AS amount_log, CAST(amount > 100 AS DOUBLE) AS high_amount_flag,
  CAST((time_s % 86400) // 3600 AS DOUBLE) AS tx_hour, 'cards' AS dataset_source, label FROM {CARDS}
UNION ALL SELECT o_totalprice, {rnd('ln(1 + o_totalprice)')}, 0.0::DOUBLE, 0.0::DOUBLE, 'accounts', CAST(o_orderstatus = 'P' AS INT) FROM orders
UNION ALL SELECT l_extendedprice, {rnd('ln(1 + l_extendedprice)')}, 0.0::DOUBLE, 0.0::DOUBLE, 'lines', CAST(l_returnflag = 'R' AS INT) FROM lineitem"""


@query("union_master", MASTER_SQL)
def union_master(t):
    return clean.union_master(master_parts(t), MASTER).withColumn("amount_log", rounded("amount_log"))


@query("unify_schema", f"""
SELECT o_totalprice AS amount, {rnd('ln(1 + o_totalprice)')} AS amount_log, 0.0::DOUBLE AS high_amount_flag, 0.0::DOUBLE AS tx_hour,
  'accounts' AS dataset_source, CAST(o_orderstatus = 'P' AS INT) AS label FROM orders""")
def unify_schema(t):
    return clean.align(master_parts(t)[1], MASTER).withColumn("amount_log", rounded("amount_log"))


ID_COLS = [*LINE_COLS, "l_extendedprice", "l_quantity", "l_shipdate"]


@query("row_id", f"SELECT count(*) AS rows, count(DISTINCT ({LINE}, l_extendedprice, l_quantity, l_shipdate)) AS ids FROM lineitem")
def row_id(t):
    out = clean.row_id(t.lineitem, ID_COLS)
    return out.agg(F.count("*").alias("rows"), F.countDistinct("row_id").alias("ids"))


@query("row_id_values", """SELECT o_orderkey, md5(concat_ws('|', coalesce(length(a) || ':' || a, '-'), coalesce(length(b) || ':' || b, '-'), coalesce(length(c) || ':' || c, '-'))) AS row_id
FROM (SELECT o_orderkey, o_orderkey::VARCHAR AS a, nullif(o_orderpriority, '4-NOT SPECIFIED') AS b, o_orderstatus AS c FROM orders)""")
def row_id_values(t):
    """The id of every order, from a key with nulls."""
    keyed = t.orders.withColumn("b", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')"))
    return clean.row_id(keyed, ["o_orderkey", "b", "o_orderstatus"]).select("o_orderkey", "row_id")


@query("number_repeats", "SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS nth FROM orders")
def number_repeats(t):
    """Numbers of the orders within their priority, five values for all rows."""
    return clean.number_repeats(t.orders.select("o_orderpriority"), "o_orderpriority")


@query("winsorize", f"""
SELECT o_orderkey, {rnd('greatest(0, least(o_totalprice, cap))')} AS clipped FROM orders, (SELECT quantile_cont(o_totalprice, 0.99) AS cap FROM orders)""")
def winsorize(t):
    return features.winsorize(t.orders, "o_totalprice", 0.99, out="clipped").select("o_orderkey", rounded("clipped").alias("clipped"))


@query("winsorize_by_class", f"""
SELECT event_id, label, {rnd('greatest(0, least(amount, cap))')} AS clipped FROM {CARDS}
JOIN (SELECT label, quantile_cont(amount, 0.99) AS cap FROM {CARDS} GROUP BY label) USING (label)""")
def winsorize_by_class(t):
    out = features.winsorize(cards(t), "amount", 0.99, by=["label"], out="clipped")
    return out.select("event_id", "label", rounded("clipped").alias("clipped"))


@query("risk_tier3", """
SELECT event_id, CASE WHEN s >= 0 AND s <= 0.5 THEN 'LOW' WHEN s > 0.5 AND s <= 0.8 THEN 'MEDIUM' WHEN s > 0.8 AND s <= 1 THEN 'HIGH' ELSE 'nan' END AS risk_tier
FROM (SELECT event_id, value / 450.0::DOUBLE AS s FROM events)""")
def risk_tier3(t):
    return t.events.select("event_id", risk_tier(F.col("value") / 450.0, *TIERS_3).alias("risk_tier"))


@query("risk_tier4", """
SELECT o_orderkey, CASE WHEN s >= 0 AND s <= 0.3 THEN 'VERY LOW' WHEN s > 0.3 AND s <= 0.5 THEN 'LOW' WHEN s > 0.5 AND s <= 0.8 THEN 'MEDIUM'
  WHEN s > 0.8 AND s <= 1 THEN 'HIGH' ELSE 'nan' END AS risk_tier
FROM (SELECT o_orderkey, o_totalprice / 480000.0::DOUBLE AS s FROM orders)""")
def risk_tier4(t):
    return t.orders.select("o_orderkey", risk_tier(F.col("o_totalprice") / 480000.0, *TIERS_4).alias("risk_tier"))


@query("score_flag", "SELECT event_id, CAST(value / 100.0::DOUBLE >= 0.5 AS INT) AS fraud_flag FROM events")
def score_flags(t):
    return t.events.select("event_id", score_flag(F.col("value") / 100.0).alias("fraud_flag"))


@query("minmax_score", f"""
SELECT event_id, {rnd('1 - (value - lo) / (hi - lo)', 9)} AS iso_score FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events)""")
def minmax_score(t):
    out = features.minmax_score(t.events, "value", "iso_score", invert=True)
    return out.select("event_id", rounded("iso_score", 9).alias("iso_score"))


@query("score_fusion", f"""
SELECT row_id, label, {rnd('0.35 * s_stack + 0.25 * s_seq + 0.2 * s_boost + 0.2 * s_iso', 9)} AS fused_score FROM {ORDER_SCORES}""")
def score_fusion(t):
    return order_scores(t).select("row_id", "label", rounded(fused(FUSION), 9).alias("fused_score"))


@query("clean_feature_name", """
SELECT doc_id, translate(split_part(text, ' ', 1), '<>=', '') AS token FROM documents""")
def clean_names(t):
    return t.documents.select("doc_id", clean_feature_name("text").alias("token"))


@query("edge_filter", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')")
def edge_filter(t):
    return sampling.edge_filter(t.lineitem, "l_returnflag", ["R", "A"]).select(*LINE_COLS, "l_returnflag")


HASHED = "md5(concat_ws('|', {key}, '42'))"


@query("sample_n", f"SELECT event_id, user_id, value FROM events ORDER BY {HASHED.format(key='event_id')} LIMIT 1000")
def sample_n(t):
    return sampling.sample_n(t.events, 1000, "event_id").select("event_id", "user_id", "value")


@query("stratified_cap", f"""
SELECT event_id, label FROM {CARDS} WHERE label = 1
UNION ALL (SELECT event_id, label FROM {CARDS} WHERE label = 0 ORDER BY {HASHED.format(key='event_id')} LIMIT 2000)""")
def stratified_cap(t):
    return sampling.stratified_cap(cards(t), "label", 2000, "event_id").select("event_id", "label")


@query("stratified_split", f"""
SELECT event_id, label, CAST(r <= round(0.2 * n) AS INT) AS is_test FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {HASHED.format(key='event_id')}) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM {CARDS})""")
def stratified_split(t):
    return sampling.stratified_split(cards(t), "label", "event_id").select("event_id", "label", "is_test")


@query("kfold", f"""
SELECT event_id, label, CAST((SELECT count(*) FROM range(1, 5) g(i) WHERE r > floor(n * i / 5)) AS INT) AS fold FROM (
  SELECT event_id, label, row_number() OVER (PARTITION BY label ORDER BY {HASHED.format(key='event_id')}) AS r,
    count(*) OVER (PARTITION BY label) AS n FROM {CARDS})""")
def kfold(t):
    return sampling.kfold(cards(t), "label", "event_id").select("event_id", "label", "fold")


@query("stream_batches", f"""
SELECT CAST((r - 1) // 500 AS INT) AS batch_id, event_id, value FROM (
  SELECT event_id, value, row_number() OVER (ORDER BY {HASHED.format(key='event_id')}) AS r FROM events) WHERE r <= 5000""")
def stream_batches(t):
    path = exports.split_to_batches(t.events.select("event_id", "value"), 10, 500, "event_id")
    return t.spark.read.schema("event_id long, value double, batch_id int").parquet(path)
