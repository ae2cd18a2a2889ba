"""From scored rows to dashboard tables and their files, in one call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import TIERS_4, fused, hour_label, risk_tier, rounded, score_flag
from riskweave.operators import aggregates, evaluate
from riskweave.plans.registry import query
from riskweave.plans.views import FUSION, ORDER_SCORES, SCORE_NAMES, order_scores, rnd
from riskweave.session import materialize, stage_path, write_stage
from riskweave.sources import exports
from riskweave.sources.layers import read_csv

# Phase of each scored component and whether the fusion uses it.
COMPONENTS = {"s_stack": ("Ensemble", 1), "s_seq": ("DL", 1), "s_boost": ("ML", 1), "s_iso": ("Unsup", 1), "fused_score": ("Ensemble", 0)}


def mart_scored(df: DataFrame, keep: list[str], weights: dict[str, float], ts: str, threshold: float = 0.5, out: str = "fused_score") -> DataFrame:
    """`keep`, the component scores, their weighted sum, decision, tier and hour of every row."""
    scored = df.withColumn(out, fused(weights))
    return scored.select(
        *keep, *weights, out, score_flag(out, threshold).alias("decision"), risk_tier(out, *TIERS_4).alias("risk_tier"), hour_label(ts).alias("time_window")
    )


def mart_models(scored: DataFrame, label: str, components: dict[str, tuple[str, int]]) -> DataFrame:
    """model, auc_roc, phase, is_component, rank by AUC of each score column (ties: by name)."""
    long = scored.unpivot([label], list(components), "model", "score")
    info = F.create_map(*[F.lit(x) for name, (phase, _) in components.items() for x in (name, phase)])
    used = F.create_map(*[F.lit(x) for name, (_, use) in components.items() for x in (name, use)])
    board = evaluate.auc_roc(long, label, "score", ["model"])


    order = Window.orderBy(F.col("auc_roc").desc_nulls_last(), "model")
    return board.select("model", "auc_roc", info[F.col("model")].alias("phase"), used[F.col("model")].alias("is_component"), F.row_number().over(order).alias("rank"))


def mart_importance(scored: DataFrame, label: str, names: list[str], weights: dict[str, float]) -> DataFrame:
    """feature, mean_abs, rank: mean distance of each component's weighted score from its mean, its share in the fused score."""

    means = scored.agg(*[F.avg(n).alias(n) for n in names]).first()
    sums = scored.agg(*[F.avg(F.abs(F.lit(float(weights[n])) * (F.col(n) - F.lit(means[n])))).alias(n) for n in names])
    long = sums.unpivot([], names, "feature", "mean_abs")
    return long.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), "feature")))


def build_marts(df: DataFrame, path: str, key: str, label: str, weights: dict[str, float], ts: str, components: dict[str, tuple[str, int]], sample: int = 10_000, seed: int = 42) -> dict[str, dict[str, str]]:
    """Score, fuse, decide and tier every row; write all marts as CSV and Parquet, a sample of the scored
    rows, and a JSON summary. Returns the paths by mart and format.

    The scored rows are written once and every mart is an aggregate of that table. Rows with
    a null component have no fused score: tier `nan`, no decision.
    """
    scored, _ = write_stage(mart_scored(df, [key, label], weights, ts), "scored")
    by_hour = scored.groupBy("time_window").agg(
        F.count("decision").alias("total_txns"), F.sum("decision").alias("fraud_txns"), F.avg("fused_score").alias("avg_score")
    ).withColumn("fraud_rate_pct", F.round(F.try_divide(F.col("fraud_txns"), F.col("total_txns")) * 100, 4))
    models = materialize(mart_models(scored, label, components), "models")
    tiers = materialize(aggregates.mart_risk_summary(scored, "risk_tier", label, "fused_score"), "tiers")
    importance = materialize(mart_importance(scored, label, list(weights), weights), "importance")
    paths = {}
    for name, mart in {"fraud_by_time": by_hour, "model_comparison": models, "risk_summary": tiers, "importance": importance}.items():
        # One row per hour, model, tier or feature: small, so one file for a dashboard.
        paths[name] = exports.export_table(mart, f"{path}/{name}", single_file=True)
    paths["scored_sample"] = exports.sample_export(scored, sample, key, f"{path}/scored_sample", seed)
    best = models.agg(F.min_by("model", "rank").alias("name"), F.min_by("auc_roc", "rank").alias("auc"), F.count(F.lit(1)).alias("models")).first()
    facts = scored.agg(F.count(F.lit(1)).alias("records"), F.sum("decision").alias("flagged"))
    top = [r.feature for r in importance.orderBy("rank").limit(5).collect()]
    summary = exports.summary_json(facts, {
        "pipeline": F.struct("records", "flagged"),
        "best_model": F.struct(F.lit(best.name).alias("name"), F.round(F.lit(best.auc), 6).alias("auc_roc")),
        "top_features": F.array(*[F.lit(x) for x in top]),
        "risk_tiers": F.array(*[F.lit(x) for x in TIERS_4[1]]),
        "model_count": F.lit(best.models),
    })
    paths["summary"] = {"json": exports.export_summary_json(summary, f"{path}/summary")}
    return paths


def dated_scores(t) -> DataFrame:
    return order_scores(t).join(t.orders.select(F.col("o_orderkey").alias("row_id"), "o_orderdate"), "row_id")


WEIGHTED = " + ".join(f"{w} * {s}" for s, w in FUSION.items())
SCORED = f"""(SELECT row_id, label, {', '.join(SCORE_NAMES)}, {WEIGHTED} AS fused_score, strftime(date_trunc('hour', o_orderdate), '%Y-%m-%d %H:00') AS time_window
  FROM {ORDER_SCORES} JOIN orders ON o_orderkey = row_id)"""
TIER = "CASE WHEN fused_score BETWEEN 0 AND 0.3 THEN 'VERY LOW' WHEN fused_score <= 0.5 THEN 'LOW' WHEN fused_score <= 0.8 THEN 'MEDIUM' WHEN fused_score <= 1 THEN 'HIGH' ELSE 'nan' END"
AUCS = f"""(SELECT model, (sum(r) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * n) AS auc_roc FROM (
  SELECT model, label, count(*) FILTER (label = 1) OVER (PARTITION BY model) AS p, count(*) FILTER (label <> 1) OVER (PARTITION BY model) AS n,
    rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r
  FROM ({' UNION ALL '.join(f"SELECT label, '{c}' AS model, {c} AS score FROM {SCORED}" for c in COMPONENTS)})) GROUP BY model, p, n)"""
INFO = ", ".join(f"('{c}', '{phase}', {use})" for c, (phase, use) in COMPONENTS.items())
MODELS = f"(SELECT model, auc_roc, phase, is_component, CAST(row_number() OVER (ORDER BY auc_roc DESC, model) AS INT) AS rank FROM {AUCS} JOIN (VALUES {INFO}) i(model, phase, is_component) USING (model))"


@query("mart_scored", f"SELECT row_id, label, {', '.join(SCORE_NAMES)}, {rnd('fused_score', 9)} AS fused_score, CAST(fused_score >= 0.5 AS INT) AS decision, {TIER} AS risk_tier, time_window FROM {SCORED}")
def scored_rows(t):
    return mart_scored(dated_scores(t), ["row_id", "label"], FUSION, "o_orderdate").withColumn("fused_score", rounded("fused_score", 9))


@query("mart_models", f"SELECT model, {rnd('auc_roc')} AS auc_roc, phase, is_component, rank FROM {MODELS}")
def models(t):
    scored = mart_scored(dated_scores(t), ["row_id", "label"], FUSION, "o_orderdate")
    return mart_models(scored, "label", COMPONENTS).withColumn("auc_roc", rounded("auc_roc"))


def _back(spark, paths: dict[str, str], fmt: str) -> DataFrame:
    schema = spark.read.parquet(paths["parquet"]).schema
    return read_csv(spark, paths["csv"], schema) if fmt == "csv" else spark.read.schema(schema).parquet(paths["parquet"])


def _mart_sql(name: str, rows: str, check: str) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS mart, '{fmt}' AS fmt, {rows} AS rows, {check} AS checksum" for fmt in ("csv", "parquet"))


IMPORTANCE = ", ".join(f"avg(abs({w} * ({s} - m_{s}))) AS {s}" for s, w in FUSION.items())
MEANS = ", ".join(f"avg({s}) AS m_{s}" for s in SCORE_NAMES)


@query("build_marts", f"""WITH s AS MATERIALIZED (SELECT *, CAST(fused_score >= 0.5 AS INT) AS decision, {TIER} AS risk_tier FROM {SCORED}), i AS (SELECT {IMPORTANCE} FROM s, (SELECT {MEANS} FROM s)),
h AS (SELECT time_window, count(*) AS n, sum(decision) AS f FROM s GROUP BY time_window)
{_mart_sql('fraud_by_time', '(SELECT count(*) FROM h)', f"(SELECT {rnd('sum(f * 1.0 + n)', 3)} FROM h)")}
UNION ALL {_mart_sql('model_comparison', f'(SELECT count(*) FROM {MODELS})', f"(SELECT {rnd('sum(auc_roc * rank)')} FROM {MODELS})")}
UNION ALL {_mart_sql('risk_summary', '(SELECT count(DISTINCT risk_tier) FROM s)', f"(SELECT {rnd('count(*) + 1.0 * sum(label)', 3)} FROM s)")}
UNION ALL {_mart_sql('importance', str(len(SCORE_NAMES)), f"(SELECT {rnd(' + '.join(SCORE_NAMES))} FROM i)")}
UNION ALL {_mart_sql('scored_sample', '(SELECT least(count(*), 10000) FROM s)', f"(SELECT {rnd('sum(fused_score)', 3)} FROM (SELECT fused_score FROM s ORDER BY md5(concat_ws('|', row_id, '42')), row_id LIMIT 10000))")}
UNION ALL SELECT 'summary', 'json', (SELECT count(*) FROM s), (SELECT CAST(sum(decision) AS DOUBLE) FROM s)""")
def marts(t):
    """All marts written and read back: rows and a checksum of each file set."""
    paths = build_marts(dated_scores(t), stage_path(t.spark, "marts"), "row_id", "label", FUSION, "o_orderdate", COMPONENTS)
    checks: dict[str, Column] = {
        "fraud_by_time": rounded(F.sum(F.col("fraud_txns") * 1.0 + F.col("total_txns")), 3), "model_comparison": rounded(F.sum(F.col("auc_roc") * F.col("rank"))),
        "risk_summary": rounded(F.sum("count") + F.sum("actual_fraud") * 1.0, 3), "importance": rounded(F.sum("mean_abs")), "scored_sample": rounded(F.sum("fused_score"), 3),
    }
    parts = [
        _back(t.spark, paths[name], fmt).agg(F.count(F.lit(1)).alias("rows"), check.alias("checksum")).select(F.lit(name).alias("mart"), F.lit(fmt).alias("fmt"), "rows", "checksum")
        for name, check in checks.items() for fmt in ("csv", "parquet")
    ]
    text = t.spark.read.text(paths["summary"]["json"])
    number = lambda p: F.get_json_object("value", f"$.pipeline.{p}")
    parts.append(text.select(F.lit("summary").alias("mart"), F.lit("json").alias("fmt"), number("records").cast("long").alias("rows"), number("flagged").cast("double").alias("checksum")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
