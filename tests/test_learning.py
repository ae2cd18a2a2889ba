"""Neighbours, oversampling, forests, stacking and explanations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.functions.columns import TIERS_3, TIERS_4, risk_tier
from riskweave.ml import explain, isolation, models, stacking
from riskweave.operators import aggregates, clean, evaluate, neighbors, prep, sampling

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def points(spark):
    """Two blobs; a third of the rows are copies of one point."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(360):
        y = int(i % 6 == 0)
        x = [0.5, 0.5, 0.5] if i % 3 == 1 else rng.normal(2.0 * y, 1.0, 3).tolist()
        rows.append((i, y, *map(float, x)))
    return rows, spark.createDataFrame(rows, "id long, y int, a double, b double, c double").repartition(6)


def with_vector(df):
    return df.withColumn("x", F.array(*COLS))


@pytest.mark.parametrize("pivots, block", [(None, 1000), (1, 100), (8, 20), (40, 7)])
def test_knn_is_exact_with_copies(points, pivots, block):
    rows, df = points
    df = with_vector(df)
    got = neighbors.knn_join(df, df, "x", 4, "id", "id", exclude_self=True, pivots=pivots, block_rows=block).collect()
    found = {}
    for r in got:
        found.setdefault(r["query_id"], {})[r["rank"]] = r["neighbor_id"]
    x = np.array([r[2:] for r in rows])
    for i in range(len(rows)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        want = [j for _, j in sorted((d[j], j) for j in range(len(rows)) if j != i)][:4]
        assert [found[i][r] for r in (1, 2, 3, 4)] == want


def test_knn_with_fewer_rows_than_k(points):
    _, df = points
    df = with_vector(df.where("id < 3"))
    assert neighbors.knn_join(df, df, "x", 5, "id", "id", exclude_self=True).count() == 6
    assert neighbors.knn_join(df, df.limit(0), "x", 5, "id", "id").count() == 0


def test_smote_counts_and_convexity(points):
    rows, df = points
    out = prep.smote(df, "y", COLS, "id", ratio=0.5).collect()
    new = [r for r in out if r["_copy"] > 0]
    assert len(out) - len(new) == 360 and len(new) == 150 - 60
    x = {r[0]: np.array(r[2:]) for r in rows if r[1] == 1}
    for r in new[:40]:
        p, z = x[r["id"]], np.array([r[c] for c in COLS])
        # z lies on the segment from p to some other positive.
        assert any(abs(np.linalg.norm(z - p) + np.linalg.norm(q - z) - np.linalg.norm(q - p)) < 1e-9 for q in x.values())
    assert prep.smote(df, "y", COLS, "id", ratio=0.1).count() == 360


def test_models_separate_the_blobs(points):
    _, df = points
    split = sampling.stratified_split(df.where("id % 3 <> 1"), "y", "id", 0.3)
    train, test = prep.standardize(split.where("is_test = 0"), split.where("is_test = 1"), COLS)
    auc = lambda m: evaluate.auc_roc(m.transform(test), "y", "score").first()[0]
    assert auc(models.fit_logreg(train, COLS, "y", C=1.0, max_iter=50)) > 0.9
    assert auc(models.fit_adaboost(train, COLS, "y", rounds=6, rate=0.5, write_every=2)) > 0.8
    assert auc(models.fit_linear_svm(train, COLS, "y", "id", C=1.0, max_iter=30)) > 0.9
    assert auc(models.fit_random_forest(train, COLS, "y", trees=10, depth=4)) > 0.8


def test_isolation_forest_finds_outliers(spark):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(0, 1, 3))) for i in range(500)] + [(1000 + i, 9.0 + i, -9.0, 9.0) for i in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    model = isolation.IsolationForest(40, 128, contamination=0.01).fit(df, COLS, "id")
    scored = model.transform(df)
    top = {r["id"] for r in scored.orderBy(F.col("iso_anomaly_score").desc()).limit(5).collect()}
    assert top == {1000, 1001, 1002, 1003, 1004}
    assert scored.where("iso_prediction = -1").count() in (5, 6)
    again = isolation.IsolationForest(40, 128).fit(df.repartition(3), COLS, "id").transform(df)
    assert scored.agg(F.sum("iso_anomaly_score")).first()[0] == pytest.approx(again.agg(F.sum("iso_anomaly_score")).first()[0])


def test_average_path():
    assert [isolation.average_path(n) for n in (1, 2)] == [0.0, 1.0]
    assert isolation.average_path(256) == pytest.approx(10.244770920116851)


def test_oof_never_scores_synthetic_rows(points):
    _, df = points
    folded = sampling.kfold(df, "y", "id", 3)
    fits = {"m": lambda d: models.fit_gaussian_nb(d, COLS, "y")}
    out = stacking.oof(folded, fits, "fold", ["id", "y"], oversample=lambda d: prep.smote(d, "y", COLS, "id", ratio=0.5))
    assert out.scores.count() == 360 and out.scores.select("id").distinct().count() == 360
    assert len(out.models["m"]) == 3
    assert out.score_test(df.limit(5)).where(F.col("m").between(0, 1)).count() == 5


def test_weight_candidates_and_grid(spark):
    grid = stacking.weight_candidates()
    assert len(grid) == 254 and all(abs(sum(w) - 1) < 0.006 for w in grid)
    rng = np.random.default_rng(2)
    rows = [(int(i % 4 == 0), *(float(v) for v in rng.integers(0, 6, 2))) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, s double, t double")
    cands = [(1.0, 0.0), (0.5, 0.5), (0.0, 1.0)]
    for r in stacking.weight_grid(df, ["s", "t"], "y", cands).collect():
        f = [(y, r["weights"][0] * s + r["weights"][1] * t) for y, s, t in rows]
        pos, neg = [v for y, v in f if y], [v for y, v in f if not y]
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
        assert r["auc_roc"] == pytest.approx(want)
    flat = spark.createDataFrame([(0, 1.0, 1.0), (1, 1.0, 1.0)], "y int, s double, t double")
    assert stacking.best_weights(stacking.weight_grid(flat, ["s", "t"], "y", cands)).first()["weight_id"] == 0


class Linear:
    def transform(self, df, out="score"):
        return df.withColumn(out, 2.0 * F.col("a") - F.col("b") + 0.0 * F.col("c"))


def test_shapley_of_linear_model_is_exact(points):
    _, df = points
    cases, background = df.where("id < 5"), df.where("id >= 5")
    got = explain.shapley_sampled(cases, Linear(), COLS, "id", background, n=30).collect()
    means = background.orderBy(F.xxhash64(F.lit(42), F.col("id")), "id").limit(30).agg(*[F.avg(c).alias(c) for c in COLS]).first()
    beta = {"a": 2.0, "b": -1.0, "c": 0.0}
    rows = {r["id"]: r for r in cases.collect()}
    assert len(got) == 15
    for r in got:
        f = r["feature"]
        assert r["phi"] == pytest.approx(beta[f] * (rows[r["id"]][f] - means[f]), abs=1e-9)


def test_lime_finds_the_used_features(points):
    _, df = points
    got = explain.lime_local(df.where("id in (0, 2)"), Linear(), df, COLS, "id", n=400, k=3).collect()
    assert len(got) == 6
    for key in (0, 2):
        weights = {r["feature"]: abs(r["weight"]) for r in got if r["id"] == key}
        assert weights["c"] < max(weights["a"], weights["b"])


def test_score_udf_handles_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (0.0, 2.0)], "a double, b double")
    got = [r[0] for r in df.select(models.linear_score_udf({"a": 1.0, "b": 0.5}, 0.1)).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-1.1)), 1 / (1 + math.exp(-1.1))])


def test_tiers_are_right_closed(spark):
    df = spark.createDataFrame([(s,) for s in (0.0, 0.3, 0.5, 0.50001, 0.8, 0.81, 1.0, 1.1, -0.1)], "s double")
    got = [tuple(r) for r in df.select(risk_tier("s", *TIERS_3), risk_tier("s", *TIERS_4)).collect()]
    assert [a for a, _ in got] == ["LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "nan", "nan"]
    assert [b for _, b in got] == ["VERY LOW", "VERY LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "nan", "nan"]


def test_health_check_reports_missing_table(spark):
    tables = {"ok": spark.range(5), "gone": lambda: spark.read.parquet("/tmp/no-such-table-here")}
    got = {r["table"]: (r["rows"], r["status"]) for r in aggregates.health_check(spark, tables).collect()}
    assert got == {"ok": (5, "HEALTHY"), "gone": (None, "ERROR"), "TOTAL": (5, None)}


def test_dedupe_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    kept, report = clean.dedupe_with_report(df)
    assert tuple(report.first()) == (4, 2, 2) and kept.count() == 2


def test_adaboost_in_one_pass_is_the_chain_of_trees(points):
    train = points[1]
    boosted = models.fit_adaboost(train, COLS, "y", rounds=5, rate=0.5, write_every=2)
    data = prep.assemble(train, COLS, "_features").withColumn("votes", F.lit(0.0))
    for tree, alpha in zip(boosted.trees, boosted.weights):
        data = tree.transform(data).withColumn("votes", F.col("votes") + alpha * F.col("prediction")).drop("rawPrediction", "probability", "prediction")
    total = sum(boosted.weights)
    want = sorted(1 / (1 + math.exp(-(2 * r.votes - total) / total)) for r in data.select("votes").collect())
    got = boosted.transform(train)
    assert got.columns == [*train.columns, "score"]
    assert sorted(r.score for r in got.collect()) == pytest.approx(want)


@pytest.mark.parametrize("name, place, fitter", [
    ("ml_adaboost", models, "fit_adaboost"), ("ml_gbt", models, "fit_gbt"), ("ml_gbt_early_stop", models, "fit_boosted"),
    ("ml_stack_two_layer", stacking, "fit_meta"), ("shapley_sampled", explain, "shapley_sampled"),
])
def test_registered_learners_keep_the_reference_parameters(spark, monkeypatch, name, place, fitter):
    from riskweave.plans import QUERIES

    class Called(Exception):
        pass

    def called(*args, **parameters):
        raise Called(parameters)

    monkeypatch.setattr(place, fitter, called)
    with pytest.raises(Called) as seen:
        QUERIES[name](spark, "/root/testdata/sf0.001")
    assert seen.value.args == ({},)


def test_shapley_of_a_logistic_model_is_walked_as_it_is_scored(points):
    """The walk along each order gives what scoring every row with and without a feature gives."""
    _, df = points
    model = models.fit_logreg(df, COLS, "y", C=1.0)
    plain = type("Plain", (), {"transform": lambda self, d, out="score": model.transform(d, out)})()
    cases, background = df.where("id < 5"), df.where("id >= 5")
    values = lambda m: {(r.id, r.feature): r.phi for r in explain.shapley_sampled(cases, m, COLS, "id", background, n=10).collect()}
    got, want = values(model), values(plain)
    assert len(got) == 15 and got == pytest.approx(want, abs=1e-12)
    assert model.linear() and models.RiskModel(None, COLS).linear() is None
    rows = explain.shapley_sampled(cases, model, COLS, "id", background, n=10)
    assert "posexplode" not in rows._jdf.queryExecution().toString()


def test_adaboost_rounds_read_kept_rows(points):
    """A round asks for the prediction alone, and what the rounds have kept is given back."""
    train, kept = points[1], len(points[1].sparkSession.sparkContext._jsc.getPersistentRDDs())
    boosted = models.fit_adaboost(train, COLS, "y", rounds=3, rate=0.5, write_every=2)
    assert [(t.getRawPredictionCol(), t.getProbabilityCol()) for t in boosted.trees] == [("", "")] * 3
    assert len(train.sparkSession.sparkContext._jsc.getPersistentRDDs()) == kept


def test_boosting_computes_its_rows_once(spark):
    """The learner goes over its input several times; what makes the rows runs once."""
    made, before = spark.sparkContext.accumulator(0), spark.sparkContext._jsc.getPersistentRDDs().size()

    @F.udf("double")
    def counted(v):
        made.add(1)
        return float(v)

    rows = spark.range(60).select("id", counted.asNondeterministic()("id").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 7 > 3).cast("int").alias("y"))
    model = models.fit_gbt(rows, ["a", "b"], "y", rounds=3, depth=2)
    assert made.value == 60 and len(model.model.trees) == 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_neighbours_where_cells_rule_nothing_out(spark, monkeypatch):
    """In many dimensions rows meet in a grid of blocks; cells and grid find the same, ties by id included."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 40))
    x[250:] = x[:50]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>").repartition(3)
    routed = []
    monkeypatch.setattr(neighbors, "materialize", lambda d, tag, write=neighbors.materialize: routed.append(tag) or write(d, tag))
    find = lambda **options: sorted(map(tuple, neighbors.knn_join(df, df, "x", 4, "id", "id", exclude_self=True, **options).collect()))
    grid = find(grid_rows=64)
    assert "routed" not in routed
    assert grid == find(pivots=5, block_rows=40) and "routed" in routed
    assert grid == find() and len(grid) == 1200
    # Far clusters on a line: most cells are ruled out, and the cells are used.
    routed.clear()
    line = df.select("id", F.array((F.col("id") * 1000).cast("double")).alias("x"))
    near = neighbors.knn_join(line, line, "x", 1, "id", "id", exclude_self=True, grid_rows=64).collect()
    assert "routed" in routed and all(abs(r.query_id - r.neighbor_id) == 1 for r in near) and len(near) == 300
