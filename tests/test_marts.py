"""Marts and their files, stable row ids, pairwise correlations."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import aggregates, clean
from riskweave.plans import marts, medallion
from riskweave.session import stage_path

WEIGHTS = {"a": 0.5, "b": 0.5}
COMPONENTS = {"a": ("ML", 1), "b": ("DL", 1), "fused_score": ("Ensemble", 0)}


def test_marts_with_null_scores(spark):
    """A row without a component has no fused score: tier nan, no decision; it still counts in its tier."""
    rows = [(1, 1, 0.9, 0.9, "2024-01-01 00:10:00"), (2, 0, 0.1, 0.2, "2024-01-01 00:50:00"), (3, 0, None, 0.5, "2024-01-01 01:00:00"), (4, 1, 0.3, 0.9, "2024-01-01 01:59:59")]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, ts string").withColumn("ts", F.to_timestamp("ts"))
    paths = marts.build_marts(df, stage_path(spark, "marts"), "id", "y", WEIGHTS, "ts", COMPONENTS, sample=3)
    read = lambda name: spark.read.parquet(paths[name]["parquet"])
    hours = {r.time_window: (r.total_txns, r.fraud_txns) for r in read("fraud_by_time").collect()}
    assert hours == {"2024-01-01 00:00": (2, 1), "2024-01-01 01:00": (1, 1)}
    tiers = {r.risk_tier: (r["count"], r.actual_fraud) for r in read("risk_summary").collect()}
    assert tiers == {"HIGH": (1, 1), "VERY LOW": (1, 0), "nan": (1, 0), "MEDIUM": (1, 1)}
    models = {r.model: r for r in read("model_comparison").collect()}
    assert models["fused_score"].auc_roc == 1.0 and models["fused_score"].phase == "Ensemble" and models["b"].auc_roc == 1.0
    assert read("scored_sample").count() == 3 and read("importance").count() == 2
    summary = json.loads(spark.read.text(paths["summary"]["json"]).first()[0])
    assert summary["pipeline"] == {"records": 4, "flagged": 2} and summary["model_count"] == 3 and summary["best_model"]["auc_roc"] == 1.0


def test_row_ids_do_not_depend_on_the_plan(spark):
    rows = [(i % 3, None if i % 2 else "x") for i in range(60)] + [(9, "only")]
    df = spark.createDataFrame(rows, "k int, s string")
    ids = []
    for parts in (1, 7):
        placed = clean.number_repeats(clean.row_id(df.repartition(parts), ["k", "s"], "same"), "same", "nth")
        ids.append(sorted(r.id for r in clean.row_id(placed, ["same", "nth"], "id").collect()))
    assert ids[0] == ids[1] and len(set(ids[0])) == 61 and all(len(i) == 32 for i in ids[0])
    # Values that would meet when simply joined stay apart, and null differs from the text of a dash.
    pairs = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "-"), ("-", None), ("", "")], "x string, y string")
    assert clean.row_id(pairs, ["x", "y"]).select("row_id").distinct().count() == 5
    assert clean.number_repeats(df.limit(0), "k").count() == 0


def test_master_ids_are_the_same_on_any_partitioning(spark):
    columns = {c: F.lit(1.0) for c in medallion.MASTER_FEATURES}
    gold = spark.range(20).withColumns(columns).withColumn("Amount", (F.col("id") % 4).cast("double")).drop("id")
    got = [sorted(r.row_id for r in medallion.build_master([gold.repartition(p)]).select("row_id").collect()) for p in (1, 5)]
    assert got[0] == got[1] and len(set(got[0])) == 20


def test_correlations_of_present_pairs(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) + 1e6
    x[:, 1] += x[:, 0]
    rows = [tuple(None if rng.random() < 0.2 else float(v) for v in r) + (5.0,) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    got = {(r.a, r.b): r["corr"] for r in aggregates.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    data = df.toPandas()
    for (i, j), value in got.items():
        if "d" in (i, j):
            assert value is None
        else:
            assert value == pytest.approx(data[i].corr(data[j]), abs=1e-9)
    assert len(got) == 6 and all(r["corr"] is None for r in aggregates.corr_matrix(df.limit(0), ["a", "b"]).collect())


def test_equal_rows_are_numbered_by_their_counts(spark):
    """Many equal rows are counted, not moved; zeros of both signs, nulls and NaN keep their rows and ids."""
    nan = float("nan")
    rows = [(0.0, "x", 1)] * 30 + [(-0.0, "x", 1)] * 3 + [(None, None, None)] * 2 + [(nan, "x", 1)] * 2 + [(1.5, "y", 2)]
    df = spark.createDataFrame(rows, "a double, b string, c int")
    want = sorted((str(r), n) for r in set(map(str, df.collect())) for n in range([str(q) for q in df.collect()].count(r)))
    for parts, block in ((1, 100), (7, 4)):
        got = clean.number_equal_rows(df.repartition(parts), "nth", block_rows=block)
        assert sorted((str(r).replace(f", nth={r.nth}", ""), r.nth) for r in got.collect()) == want
    # The ids are those of rows numbered by windows, and numbering is no part of a plan that asks for no id.
    old = clean.row_id(clean.number_repeats(clean.row_id(df, df.columns, "same"), "same", "nth"), ["same", "nth"], "id")
    new = clean.row_id(clean.row_id(clean.number_equal_rows(df, "nth"), df.columns, "same"), ["same", "nth"], "id")
    assert sorted(r.id for r in old.collect()) == sorted(r.id for r in new.collect())
    gold = df.withColumns({c: F.lit(1.0) for c in medallion.MASTER_FEATURES})
    plan = medallion.build_master([gold]).groupBy("Class").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "md5" not in plan
