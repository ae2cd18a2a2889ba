"""Metrics and tests against direct definitions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import drift, evaluate, stats


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = [(m, int(rng.random() < 0.2), rng.randrange(8) / 8 if m == "tied" else rng.random()) for m in ("tied", "free") for _ in range(400)]
    return rows, spark.createDataFrame(rows, "model string, label int, score double")


def brute_auc(pairs):
    pos, neg = [s for y, s in pairs if y], [s for y, s in pairs if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("n", [1, 4, 16])
def test_auc(scored, n):
    rows, df = scored
    for r in evaluate.auc_roc(df, "label", "score", ["model"], n).collect():
        assert r["auc_roc"] == pytest.approx(brute_auc([(y, s) for m, y, s in rows if m == r["model"]]))


def test_auc_of_negated_score(scored):
    _, df = scored
    auc = lambda d: evaluate.auc_roc(d, "label", "score").first()[0]
    assert auc(df) == pytest.approx(1 - auc(df.withColumn("score", -F.col("score"))))


def test_single_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.2)], "label int, score double")
    assert evaluate.auc_roc(df, "label", "score").first()[0] is None


@pytest.mark.parametrize("n", [1, 6])
def test_average_precision(scored, n):
    rows, df = scored
    for r in evaluate.average_precision(df, "label", "score", ["model"], n).collect():
        mine = [(y, s) for m, y, s in rows if m == r["model"]]
        total, ap, before = sum(y for y, _ in mine), 0.0, 0
        for t in sorted({s for _, s in mine}, reverse=True):
            tp, all_ = sum(y for y, s in mine if s >= t), sum(s >= t for _, s in mine)
            ap += (tp - before) / total * tp / all_
            before = tp
        assert r["avg_precision"] == pytest.approx(ap)


def test_curve_ends(scored):
    _, df = scored
    first = evaluate.roc_points(df, "label", "score").orderBy("threshold").first()
    assert (first["tpr"], first["fpr"]) == (1.0, 1.0)


def test_report_with_unpredicted_class(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, pred int")
    rows = {r["row"]: r for r in evaluate.classification_report(df, "label", "pred").collect()}
    assert (rows["1"]["precision"], rows["1"]["recall"], rows["1"]["support"]) == (0.0, 0.0, 1)
    assert rows["accuracy"]["f1"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("n", [1, 5])
def test_ks(spark, n):
    rng = random.Random(1)
    a, b = [rng.gauss(0, 1) for _ in range(150)], [rng.gauss(0.4, 1) for _ in range(200)]
    df = spark.createDataFrame([("ref", x) for x in a] + [("cur", x) for x in b], "side string, x double")
    got = stats.ks_two_sample(df, "side", ["x"], partitions=n).first()
    gap = max(abs(sum(v <= t for v in a) / 150 - sum(v <= t for v in b) / 200) for t in a + b)
    lam = math.sqrt(150 * 200 / 350) * gap
    assert got["ks_statistic"] == pytest.approx(gap)
    assert got["p_value"] == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 60)), abs=1e-9)


def test_mann_whitney(spark):
    rng = random.Random(2)
    a, b = [rng.randrange(20) for _ in range(60)], [rng.randrange(3, 23) for _ in range(90)]
    df = spark.createDataFrame([(1, float(x)) for x in a] + [(0, float(x)) for x in b], "y int, x double")
    got = stats.mann_whitney(df, "y", "x", 1, partitions=4).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n1, n2, n = 60, 90, 150
    ties = sum(c**3 - c for c in ((a + b).count(v) for v in set(a + b)))
    z = (abs(u - n1 * n2 / 2) - 0.5) / math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    assert got["u"] == pytest.approx(u) and got["z"] == pytest.approx(z)
    assert got["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_psi_properties(spark):
    rows = [(s, float(i % 37), 5.0) for s in ("ref", "cur") for i in range(300)]
    df = spark.createDataFrame(rows, "side string, x double, c double")
    assert all(abs(r["psi"]) < 1e-9 for r in drift.psi(df, "side", ["x", "c"]).collect())
    moved = df.withColumn("x", F.when(F.col("side") == "cur", F.col("x") + 30).otherwise(F.col("x")))
    got = {r["feature"]: r for r in drift.psi_status(drift.psi(moved, "side", ["x", "c"])).collect()}
    assert got["x"]["status"] == "RETRAIN" and got["c"]["status"] == "Stable"


def test_psi_counts_bins_empty_on_both_sides(spark):
    """The reference sum over all ten bins, written out."""
    a, b = [0.0, 0.0, 10.0], [0.0, 10.0, 10.0, 10.0, 10.0]
    df = spark.createDataFrame([("ref", x) for x in a] + [("cur", x) for x in b], "side string, x double")
    counts = lambda v: [v.count(0.0)] + [0] * 8 + [v.count(10.0)]
    want = sum(
        (q - p) * math.log(q / p)
        for p, q in zip([(c + 1e-6) / (3 + 1e-5) for c in counts(a)], [(c + 1e-6) / (5 + 1e-5) for c in counts(b)])
    )
    assert drift.psi(df, "side", ["x"]).first()["psi"] == pytest.approx(want)
