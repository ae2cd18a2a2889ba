"""Bronze, silver and gold builds of the four transaction data sets and their master table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import flag
from riskweave.operators import aggregates, clean, features, joins, rolling
from riskweave.sources import layers

# Column names that the layers add.
STAMPS = ["_source", "_ingested_at", "_ingestion_date", "_silver_processed_at", "_gold_processed_at"]


@dataclass(frozen=True)
class SilverRules:
    """What makes a raw table of one data set clean."""

    required: list[str]
    types: dict[str, str]
    label: str | None = None
    zero_prefix: str | None = None
    fill_all_but: tuple = field(default=())


# Critical columns and types per data set.
RULES = {
    "creditcard": SilverRules(["Time", "Amount", "Class"], {"Time": "double", "Amount": "double", "Class": "int"}, "Class"),
    "paysim": SilverRules(
        ["type", "amount", "isFraud"],
        {
            "step": "int", "amount": "double", "oldbalanceOrg": "double", "newbalanceOrig": "double",
            "oldbalanceDest": "double", "newbalanceDest": "double", "isFraud": "int", "isFlaggedFraud": "int",
        },
        "isFraud",
    ),
    "ieee_transaction": SilverRules(
        ["TransactionID", "TransactionAmt", "isFraud"],
        {"TransactionID": "long", "TransactionDT": "long", "TransactionAmt": "double", "isFraud": "int"},
        "isFraud", "V",
    ),
    "ieee_identity": SilverRules(["TransactionID"], {"TransactionID": "long"}, fill_all_but=("TransactionID",)),
}

# Features the three gold tables share.
MASTER_FEATURES = [
    "Amount", "amount_log", "amount_zscore", "amount_spike", "is_night", "is_weekend", "high_amount_flag",
    "tx_velocity_10", "dataset_source", "Class",
]
# Mail providers counted as low risk.
COMMON_MAIL = ["gmail.com", "yahoo.com", "hotmail.com"]


def to_silver(bronze: DataFrame, rules: SilverRules) -> DataFrame:
    """Distinct rows by their data columns, complete, typed, filled and labelled."""
    df = clean.drop_meta(bronze, [c for c in STAMPS if c in bronze.columns])
    df = clean.dropna_subset(clean.dedupe(df), rules.required)
    df = clean.cast_columns(df, {c: t for c, t in rules.types.items() if c in df.columns})
    if rules.zero_prefix:
        df = clean.fill_prefix(df, rules.zero_prefix)
    if rules.fill_all_but:
        df = clean.fill_by_type(df, skip=rules.fill_all_but)
    if rules.label:
        df = clean.label_flag(clean.rename_std(df, {rules.label: "Class"}), "Class")
    return df.withColumn("_silver_processed_at", F.current_timestamp())


def _finish(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_gold_processed_at": F.current_timestamp(), "dataset_source": F.lit(source)})


def _with_tie(df: DataFrame, tie: str | None) -> tuple[DataFrame, str]:
    """Rows of equal time need a fixed order; silver rows are distinct, so their hash gives one."""
    return (df, tie) if tie else (clean.row_id(df, df.columns, "_tie"), "_tie")


def gold_cards(silver: DataFrame, tie: str | None = None, anonymous: bool = True) -> DataFrame:
    """Card transactions without accounts: rolling features over the whole stream of payments.

    `anonymous` adds the features built from V1 to V28; a table without them must say so.
    """
    df, tie = _with_tie(silver, tie)
    frame = lambda fn: (fn, "Amount")
    df = rolling.rolling_global(df, ["Time", tie], 10, {
        "amount_rolling_mean": frame("avg"), "amount_rolling_std": frame("std"),
        "amount_rolling_max": frame("max"), "tx_velocity_10": frame("count"),
    })
    df = features.amount_math(df, "Amount").withColumns({
        "amount_zscore": rolling.zscore("Amount", "amount_rolling_mean", "amount_rolling_std"),
        "amount_spike": rolling.spike("Amount", "amount_rolling_mean"),
    })
    df = features.time_features(df, "Time").drop("tx_day", "tx_day_of_week").withColumnRenamed("tx_hour", "hour_of_day")
    df = features.amount_flags(df.withColumn("is_weekend", F.lit(0)), "Amount", {"high_amount_flag": 500, "very_high_amount": 2000})
    v = [f"V{i}" for i in range(1, 29)]
    if anonymous:
        df = features.interactions(df, [("V1", "V2"), ("V3", "V4"), ("V14", "V17")])
        df = features.abs_sum(features.row_sum(df, v[:5], "v_sum_top5"), v)
    return _finish(df, "creditcard").drop("_tie")


def gold_mobile(silver: DataFrame, tie: str | None = None, **options) -> DataFrame:
    """Mobile money transfers: balances, per-account velocity, types and rules."""
    df, tie = _with_tie(silver, tie)
    df = features.balance_features(df, "oldbalanceOrg", "newbalanceOrig", "amount", "orig")
    df = features.balance_features(df, "oldbalanceDest", "newbalanceDest", None, "dest")
    df = rolling.velocity(df, ["nameOrig"], ["step", tie], {
        "tx_count_3steps": ("count", "amount", 3), "tx_count_10steps": ("count", "amount", 10),
        "amount_mean_10steps": ("avg", "amount", 10), "amount_std_10steps": ("std", "amount", 10),
        "amount_max_10steps": ("max", "amount", 10),
    }, **options)
    df = df.withColumns({
        "amount_log": F.log1p("amount"),
        "amount_zscore": rolling.zscore("amount", "amount_mean_10steps", "amount_std_10steps"),
        "sudden_large_tx": rolling.spike("amount", "amount_mean_10steps"),
    })
    kinds = ["TRANSFER", "CASH_OUT", "PAYMENT", "CASH_IN", "DEBIT"]
    df = features.one_hot(df, "type", {f"is_{k.lower()}": k for k in kinds})
    df = features.group_flag(df, "type", ["TRANSFER", "CASH_OUT"], "high_risk_type")
    df = features.rule_flags(df, {"account_drain": features.account_drain("balance_diff_orig", "orig_balance_zero")})
    return _finish(clean.rename_std(df, {"amount": "Amount"}), "paysim").drop("_tie")


def gold_transactions(transactions: DataFrame, identity: DataFrame, **options) -> DataFrame:
    """Card-not-present transactions with device identity: per-card velocity, mail and device risk.

    Identity nulls were filled in silver, so `has_identity` says whether a row was joined.
    """
    meta = [c for c in STAMPS if c in identity.columns]
    df = joins.left_join(clean.drop_meta(transactions, meta), clean.drop_meta(identity, meta), "TransactionID")
    df = features.time_features(df, "TransactionDT")
    df = rolling.velocity(df, ["card1"], ["TransactionDT", "TransactionID"], {
        "amount_rolling_mean": ("avg", "TransactionAmt", 5), "amount_rolling_std": ("std", "TransactionAmt", 5),
        "card_tx_count_5": ("count", "TransactionAmt", 5), "card_tx_count_20": ("count", "TransactionAmt", 20),
        "card_amount_sum_5": ("sum", "TransactionAmt", 5), "card_amount_sum_20": ("sum", "TransactionAmt", 20),
        "_mean_20": ("avg", "TransactionAmt", 20), "_std_20": ("std", "TransactionAmt", 20),
    }, **options)
    df = df.withColumns({
        "amount_log": F.log1p("TransactionAmt"), "Amount": F.col("TransactionAmt"),
        "amount_zscore": rolling.zscore("TransactionAmt", "_mean_20", "_std_20"),
        "amount_spike": rolling.spike("TransactionAmt", "_mean_20"),
        "high_amount_flag": flag(F.col("TransactionAmt") > 500),
        # The shared schema asks for a 10-row velocity; this data set supplies its 20-row count.
        "tx_velocity_10": F.col("card_tx_count_20"),
    }).drop("_mean_20", "_std_20")
    df = features.case_risk(df, "P_emaildomain", COMMON_MAIL, "p_email_domain_risk")
    df = features.case_risk(df, "R_emaildomain", COMMON_MAIL, "r_email_domain_risk")
    df = features.presence_flag(df, "id_01", "has_identity")
    return _finish(features.equality_flag(df, "DeviceType", "mobile", "device_type_mobile"), "ieee_cis")


def build_master(gold: list[DataFrame]) -> DataFrame:
    """Union of the gold tables on the shared features, stamped and numbered.

    The id is a hash of the row's own columns and of its place among rows equal in all of
    them, so it does not depend on the plan that computes it.
    """
    master = clean.union_master(gold, MASTER_FEATURES)
    placed = clean.row_id(clean.number_equal_rows(master, "_nth"), master.columns, "_same")
    return clean.row_id(placed, ["_same", "_nth"]).drop("_same", "_nth").withColumn("_gold_processed_at", F.current_timestamp())


def build_layers(spark: SparkSession, sources: dict[str, str], schemas: dict | None = None) -> DataFrame:
    """CSV files to bronze, silver, gold and master; returns the health report of all tables written.

    `sources` maps the data set names of `RULES` to CSV paths. Every step reads the table
    written before it, so no step is computed twice.
    """
    schemas = schemas or {}
    silver = {}
    for name, path in sources.items():
        raw = layers.stamp_ingest(layers.read_csv(spark, path, schemas.get(name)), name)
        layers.write_layer(raw, "bronze", name)
        layers.write_layer(to_silver(layers.read_layer(spark, "bronze", name), RULES[name]), "silver", name)
        silver[name] = layers.read_layer(spark, "silver", name)
    layers.write_layer(gold_cards(silver["creditcard"]), "gold", "creditcard")
    layers.write_layer(gold_mobile(silver["paysim"]), "gold", "paysim")
    layers.write_layer(gold_transactions(silver["ieee_transaction"], silver["ieee_identity"]), "gold", "ieee")
    gold = {n: layers.read_layer(spark, "gold", n) for n in ("creditcard", "paysim", "ieee")}
    layers.write_layer(build_master(list(gold.values())), "gold", "master")
    written = {f"silver/{n}": d for n, d in silver.items()} | {f"gold/{n}": d for n, d in gold.items()}
    written["gold/master"] = layers.read_layer(spark, "gold", "master")
    return aggregates.health_check(spark, written, "Class")
