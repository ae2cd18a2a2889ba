"""Preparation, training, stacking and attributions on the supplied vectors and tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.functions.columns import rounded
from riskweave.ml import explain, extra, models, perceptron, stacking
from riskweave.ml.isolation import IsolationForest
from riskweave.operators import aggregates, approx, evaluate, joins, neighbors, prep, sampling
from riskweave.plans.registry import query
from riskweave.plans.views import V_NAMES, VECTORS, rnd, vectors
from riskweave.session import materialize

SPLIT = f"""(SELECT *, CAST(r <= round(0.2 * n) AS INT) AS is_test FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', vec_id, '42'))) AS r, count(*) OVER (PARTITION BY label) AS n FROM {VECTORS}))"""


def split(t):
    """Stratified train and test part of the vectors."""
    marked = sampling.stratified_split(vectors(t), "label", "vec_id")
    return marked.where(F.col("is_test") == 0).drop("is_test"), marked.where(F.col("is_test") == 1).drop("is_test")


def scaled(t):
    train, test = split(t)
    return prep.standardize(train, test, V_NAMES)


def held_out(test, model):
    """Metrics of a fitted model on the held-out part; the scores are written once for all of them."""
    scores = materialize(model.transform(test).select("label", "score"), "scores")
    return evaluate.metric_suite(scores, "label", "score", ())


@query("assemble_features", f"""
SELECT vec_id, {len(V_NAMES) + 1} AS width, {rnd(' + '.join(f'coalesce({v}, 0)' for v in V_NAMES) + ' + coalesce(extra, 0)')} AS checksum
FROM (SELECT *, CASE WHEN V1 > 0 THEN V1 * V2 END AS extra FROM {VECTORS})""")
def assemble_features(t):
    df = vectors(t).withColumn("extra", F.when(F.col("V1") > 0, F.col("V1") * F.col("V2")))
    names = prep.feature_names(df, "V", ["extra", "not_there"])
    array = vector_to_array("features")
    out = prep.assemble(df, names)
    return out.select("vec_id", F.size(array).alias("width"), rounded(F.aggregate(array, F.lit(0.0), lambda a, x: a + x)).alias("checksum"))


@query("standardize", f"""
WITH d AS (SELECT * FROM {SPLIT}), s AS (SELECT {', '.join(f'avg({v}) AS m{v}, stddev_pop({v}) AS s{v}' for v in V_NAMES)} FROM d WHERE is_test = 0)
SELECT vec_id, {', '.join(f'{rnd(f"({v} - m{v}) / s{v}")} AS {v}' for v in V_NAMES)} FROM d, s WHERE is_test = 1""")
def standardize(t):
    return scaled(t)[1].select("vec_id", *[rounded(v).alias(v) for v in V_NAMES])


@query("minmax_features", f"""
WITH d AS (SELECT * FROM {SPLIT}), s AS (SELECT {', '.join(f'min({v}) AS m{v}, max({v}) - min({v}) AS s{v}' for v in V_NAMES)} FROM d WHERE is_test = 0)
SELECT vec_id, {', '.join(f'{rnd(f"({v} - m{v}) / s{v}")} AS {v}' for v in V_NAMES)} FROM d, s WHERE is_test = 1""")
def minmax_features(t):
    return prep.minmax_features(*split(t), V_NAMES)[1].select("vec_id", *[rounded(v).alias(v) for v in V_NAMES])


PAIRS = "SELECT q.vec_id AS query_id, b.vec_id AS neighbor_id, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance"


@query("knn_join", f"""
SELECT query_id, neighbor_id, {rnd('distance')} AS distance, CAST(r AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS r FROM (
    {PAIRS} FROM embeddings q, embeddings b WHERE q.vec_id <> b.vec_id)) WHERE r <= 5""")
def knn_join(t):
    out = neighbors.knn_join(t.embeddings, t.embeddings, "embedding", 5, "vec_id", "vec_id", exclude_self=True)
    return out.withColumn("distance", rounded("distance"))


VEC28 = "[" + ", ".join(V_NAMES) + "]"


@query("ml_knn", f"""
WITH d AS MATERIALIZED (SELECT vec_id, label, is_test, {VEC28} AS x FROM {SPLIT}),
n AS (SELECT q.vec_id, b.label, list_distance(q.x, b.x) AS dist, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, b.x), b.vec_id) AS r
  FROM d q, d b WHERE q.is_test = 1 AND b.is_test = 0)
SELECT vec_id, {rnd('CASE WHEN count(*) FILTER (dist = 0) > 0 THEN (count(*) FILTER (dist = 0 AND label = 1)) / (count(*) FILTER (dist = 0)) ELSE coalesce(sum(1 / dist) FILTER (label = 1 AND dist > 0), 0) / sum(1 / nullif(dist, 0)) END')} AS score
FROM n WHERE r <= 5 GROUP BY vec_id""")
def ml_knn(t):
    train, test = split(t)
    return models.knn_scores(train, test, V_NAMES, "label", "vec_id").withColumn("score", rounded("score"))


def h(*parts: str) -> str:
    """First 32 bits of md5 as an integer."""
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


@query("knn_approx_recall", "SELECT count(*) AS queries, 5 * count(*) AS neighbors, true AS enough FROM embeddings")
def knn_approx_recall(t):
    """The five approximate neighbours of every vector against the exact ones: at least nine in ten are found."""
    args = t.embeddings, t.embeddings, "embedding", 5, "vec_id", "vec_id"
    found = neighbors.knn_join(*args, exclude_self=True, exact=False)
    seen = approx.recall(found, neighbors.knn_join(*args, exclude_self=True))
    return seen.select("queries", "neighbors", (F.col("recall") >= 0.9).alias("enough"))


@query("smote", f"""
WITH m AS MATERIALIZED (SELECT vec_id, {VEC28} AS x, row_number() OVER (ORDER BY md5(concat_ws('|', vec_id, '42'))) AS r FROM {VECTORS} WHERE label = 1),
c AS (SELECT count(*) AS pos, CAST(floor((SELECT count(*) FROM {VECTORS} WHERE label = 0) * 0.5) AS BIGINT) - count(*) AS new FROM m),
p AS (SELECT vec_id, x, unnest(range(1, new // pos + CASE WHEN r <= new % pos THEN 1 ELSE 0 END + 1)) AS copy FROM m, c WHERE new > 0),
n AS (SELECT q.vec_id, b.x AS y, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.x, b.x), b.vec_id) AS rank FROM m q, m b WHERE q.vec_id <> b.vec_id),
s AS (SELECT vec_id, copy, x, y, {h('vec_id', 'copy', "'43'")} / 4294967296.0::DOUBLE AS gap FROM p JOIN n USING (vec_id) WHERE rank = {h('vec_id', 'copy', "'42'")} % 5 + 1)
SELECT vec_id, label, 0 AS "_copy", {', '.join(f'{rnd(v)} AS {v}' for v in V_NAMES)} FROM {VECTORS}
UNION ALL SELECT vec_id, 1, CAST(copy AS INT), {', '.join(rnd(f'x[{i}] + (y[{i}] - x[{i}]) * gap') for i in range(1, len(V_NAMES) + 1))} FROM s""")
def smote(t):
    out = prep.smote(vectors(t), "label", V_NAMES, "vec_id", ratio=0.5)
    return out.select("vec_id", "label", "_copy", *[rounded(v).alias(v) for v in V_NAMES])


@query("ml_logreg")
def ml_logreg(t):
    train, test = scaled(t)
    return held_out(test, models.fit_logreg(train, V_NAMES, "label"))


def descent_sql(steps: int = 400, rate: float = 0.6, penalty: float = 0.01) -> str:
    """Balanced logistic regression by plain gradient descent on the standardised training rows; w (weights), b."""
    d = f"""s AS (SELECT {', '.join(f'avg({v}) AS m{v}, stddev_pop({v}) AS s{v}' for v in V_NAMES)} FROM d WHERE is_test = 0),
  x AS MATERIALIZED (SELECT vec_id, label, is_test, [{', '.join(f'({v} - m{v}) / s{v}' for v in V_NAMES)}] AS x,
    count(*) FILTER (is_test = 0) OVER () / (2.0 * count(*) FILTER (is_test = 0) OVER (PARTITION BY label)) AS c, count(*) FILTER (is_test = 0) OVER () AS n FROM d, s)"""
    move = ", ".join(f"w[{j}] - {rate} * (sum(e * x[{j}]) / any_value(n) + w[{j}] / ({penalty} * any_value(n)))" for j in range(1, len(V_NAMES) + 1))
    return f"""WITH RECURSIVE d AS MATERIALIZED (SELECT * FROM {SPLIT}), {d},
  g(i, w, b) AS (SELECT 0, [{', '.join(['0.0::DOUBLE'] * len(V_NAMES))}], 0.0::DOUBLE UNION ALL
    SELECT i + 1, [{move}], b - {rate} * sum(e) / any_value(n) FROM (SELECT i, w, b, x, n, c * (1 / (1 + exp(-(list_inner_product(w, x) + b))) - label) AS e FROM g, x WHERE is_test = 0 AND i < {steps}) GROUP BY i, w, b)"""


@query("ml_logreg_scores", f"{descent_sql()} SELECT vec_id, {rnd('1 / (1 + exp(-(list_inner_product(w, x) + b)))', 4)} AS score FROM x, g WHERE is_test = 1 AND i = 400")
def ml_logreg_scores(t):
    """Scores of the logistic regression, fitted closely enough to compare each of them."""
    train, test = scaled(t)
    model = models.fit_logreg(train, V_NAMES, "label", tol=1e-12)
    return model.transform(test).select("vec_id", rounded("score", 4).alias("score"))


@query("ml_linear_svm")
def ml_linear_svm(t):
    train, test = scaled(t)
    return held_out(test, models.fit_linear_svm(train, V_NAMES, "label", "vec_id", max_iter=2000))


NB_TERM = "ln(2 * pi() * (v + eps)) / 2 + pow(value - m, 2) / (2 * (v + eps))"


@query("ml_gaussian_nb", f"""
WITH d AS MATERIALIZED (SELECT * FROM {SPLIT}), u AS MATERIALIZED (SELECT vec_id, label, is_test, name, value FROM (UNPIVOT d ON {', '.join(V_NAMES)} INTO NAME name VALUE value)),
g AS (SELECT label, name, avg(value) AS m, var_pop(value) AS v FROM u WHERE is_test = 0 GROUP BY label, name),
e AS (SELECT 1e-9 * max(x) AS eps FROM (SELECT var_pop(value) AS x FROM u WHERE is_test = 0 GROUP BY name)),
p AS (SELECT label, ln(count(*) / (SELECT count(*)::DOUBLE FROM d WHERE is_test = 0)) AS prior FROM d WHERE is_test = 0 GROUP BY label),
l AS (SELECT vec_id, g.label, any_value(prior) - sum({NB_TERM}) AS ll FROM u JOIN g USING (name) JOIN p ON p.label = g.label, e WHERE u.is_test = 1 GROUP BY vec_id, g.label)
SELECT vec_id, {rnd('1 / (1 + exp(max(ll) FILTER (label = 0) - max(ll) FILTER (label = 1)))', 5)} AS score FROM l GROUP BY vec_id""")
def ml_gaussian_nb(t):
    train, test = split(t)
    return models.fit_gaussian_nb(train, V_NAMES, "label").transform(test).select("vec_id", rounded("score", 5).alias("score"))


@query("ml_random_forest")
def ml_random_forest(t):
    train, test = split(t)
    return held_out(test, models.fit_random_forest(train, V_NAMES, "label"))


@query("ml_extra_trees")
def ml_extra_trees(t):
    train, test = split(t)
    return held_out(test, extra.fit_extra_trees(train, V_NAMES, "label"))


@query("ml_adaboost")
def ml_adaboost(t):
    train, test = split(t)
    return held_out(test, models.fit_adaboost(train, V_NAMES, "label"))


@query("ml_gbt")
def ml_gbt(t):
    train, test = split(t)
    return held_out(test, models.fit_gbt(train, V_NAMES, "label"))


@query("ml_gbt_early_stop")
def ml_gbt_early_stop(t):
    train, test = split(t)
    inner = sampling.stratified_split(train, "label", "vec_id", 0.2, seed=7)
    fit, valid = inner.where(F.col("is_test") == 0).drop("is_test"), inner.where(F.col("is_test") == 1).drop("is_test")
    return held_out(test, models.fit_boosted(fit, valid, V_NAMES, "label", "xgb"))


@query("ml_mlp")
def ml_mlp(t):
    train, test = scaled(t)
    return held_out(test, perceptron.fit_perceptron(train, V_NAMES, "label", "vec_id"))


@query("ml_isolation_forest")
def ml_isolation_forest(t):
    data = vectors(t)
    model = IsolationForest(n_trees=200, contamination=0.1).fit(data, V_NAMES, "vec_id")
    return model.transform(data).select("vec_id", "iso_anomaly_score", "iso_prediction", F.col("label").alias("true_label"))


@query("ml_importance")
def ml_importance(t):
    train, _ = split(t)
    return models.importance(models.fit_random_forest(train, V_NAMES, "label"), 20)


def fitters(names=V_NAMES):
    return {
        "p_logreg": lambda d: models.fit_logreg(d, names, "label"),
        "p_bayes": lambda d: models.fit_gaussian_nb(d, names, "label"),
    }


def fold_scores(train, layer, k=5, **options):
    folded = sampling.kfold(train, "label", "vec_id", k)
    return stacking.oof(folded, layer, "fold", ["vec_id", "label", "fold"], **options)


@query("ml_oof")
def ml_oof(t):
    """Out-of-fold scores with oversampling inside each training part."""
    train, _ = scaled(t)
    grow = lambda d: prep.smote(d, "label", V_NAMES, "vec_id", ratio=0.3)
    return fold_scores(train, fitters(), oversample=grow).scores


OOF_BAYES = f"""
WITH d AS MATERIALIZED (SELECT *, CAST((SELECT count(*) FROM range(1, 5) x(i) WHERE r2 > floor(n2 * i / 5)) AS INT) AS fold FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', vec_id, '42'))) AS r2, count(*) OVER (PARTITION BY label) AS n2 FROM {SPLIT} WHERE is_test = 0)),
u AS MATERIALIZED (SELECT vec_id, label, fold, name, value FROM (UNPIVOT d ON {', '.join(V_NAMES)} INTO NAME name VALUE value)),
k AS (SELECT i AS held FROM range(0, 5) x(i)),
g AS (SELECT held, label, name, avg(value) AS m, var_pop(value) AS v FROM u JOIN k ON fold <> held GROUP BY held, label, name),
e AS (SELECT held, 1e-9 * max(x) AS eps FROM (SELECT held, var_pop(value) AS x FROM u JOIN k ON fold <> held GROUP BY held, name) GROUP BY held),
p AS (SELECT held, label, ln(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY held)) AS prior FROM d JOIN k ON fold <> held GROUP BY held, label),
l AS (SELECT vec_id, u.fold, g.label, any_value(prior) - sum({NB_TERM}) AS ll FROM u JOIN g ON g.held = u.fold AND g.name = u.name
  JOIN p ON p.held = g.held AND p.label = g.label JOIN e ON e.held = g.held GROUP BY vec_id, u.fold, g.label)
SELECT vec_id, fold, {rnd('1 / (1 + exp(max(ll) FILTER (label = 0) - max(ll) FILTER (label = 1)))', 5)} AS p_bayes FROM l GROUP BY vec_id, fold"""


@query("ml_oof_bayes", OOF_BAYES)
def ml_oof_bayes(t):
    """Out-of-fold scores of one model whose fit has a closed form."""
    train, _ = split(t)
    out = fold_scores(train, {"p_bayes": fitters()["p_bayes"]}).scores
    return out.select("vec_id", "fold", rounded("p_bayes", 5).alias("p_bayes"))


@query("oof_join", f"SELECT vec_id, label, p_bayes, p_bayes AS q_bayes FROM ({OOF_BAYES}) JOIN {SPLIT} USING (vec_id)")
def oof_join(t):
    """Scores of two layers put side by side by row id; both layers have the closed form here."""
    train, _ = split(t)
    first = fold_scores(train, {"p_bayes": fitters()["p_bayes"]}).scores.select("vec_id", "label", "p_bayes")
    second = fold_scores(train, {"q_bayes": fitters()["p_bayes"]}).scores.select("vec_id", "q_bayes")
    both = joins.hconcat_by_id([first, second], "vec_id")
    return both.withColumns({c: rounded(c, 5) for c in ("p_bayes", "q_bayes")}).select("vec_id", "label", "p_bayes", "q_bayes")


@query("ml_stack_meta")
def ml_stack_meta(t):
    train, test = scaled(t)
    base = fold_scores(train, fitters())
    names = list(base.models)
    meta_train, meta_test = stacking.scale_scores(base.scores, base.score_test(test), names)
    return held_out(meta_test, stacking.fit_meta(meta_train, names, "label"))


@query("ml_stack_two_layer")
def ml_stack_two_layer(t):
    """Layer 2 sees the scores of layer 1; the meta model sees both, joined by row id."""
    train, test = scaled(t)
    one = fold_scores(train, fitters())
    wide_train = joins.hconcat_by_id([train, one.scores.select("vec_id", *one.models)], "vec_id")
    wide_test = one.score_test(test)
    stacked = V_NAMES + list(one.models)
    two = fold_scores(wide_train, {"p_second": lambda d: models.fit_logreg(d, stacked, "label", C=0.1)})
    both = joins.hconcat_by_id([one.scores.select("vec_id", "label", *one.models), two.scores.select("vec_id", "p_second")], "vec_id")
    names = [*one.models, "p_second"]
    meta_train, meta_test = stacking.scale_scores(both, two.score_test(wide_test), names)
    return held_out(meta_test, stacking.fit_meta(meta_train, names, "label", "gbt"))


SLOPES = f"s AS (SELECT {', '.join(f'regr_slope(label, {v}) AS b{v}, avg({v}) AS m{v}' for v in V_NAMES)} FROM {VECTORS})"
PHI = "WITH " + SLOPES + ", p AS (" + " UNION ALL ".join(
    f"SELECT vec_id, label, '{v}' AS feature, {v} AS value, b{v} * ({v} - m{v}) AS phi FROM {VECTORS}, s" for v in V_NAMES
) + ")"
RANKED = f"{PHI}, r AS (SELECT feature, avg(abs(phi)) AS mean_abs, row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS rank FROM p GROUP BY feature)"


def slopes(df):
    """Marginal regression slope of the label on each feature, as a simple linear model."""
    return df.agg(*[F.regr_slope("label", v).alias(v) for v in V_NAMES]).first().asDict()


def attributions(t):
    data = vectors(t)
    return explain.linear_attribution(data, slopes(data), ["vec_id", "label"])


@query("ml_score_udf", f"WITH {SLOPES} SELECT vec_id, {rnd('1 / (1 + exp(-(' + ' + '.join(f'b{v} * {v}' for v in V_NAMES) + ')))')} AS score FROM {VECTORS}, s")
def ml_score_udf(t):
    data = vectors(t)
    return data.select("vec_id", rounded(models.linear_score_udf(slopes(data))).alias("score"))


@query("attribution_rank", f"{RANKED} SELECT feature, {rnd('mean_abs', 9)} AS mean_abs, CAST(rank AS INT) AS rank FROM r")
def attribution_rank(t):
    return explain.attribution_rank(attributions(t)).withColumn("mean_abs", rounded("mean_abs", 9))


@query("local_attribution", f"""{PHI}
SELECT vec_id, feature, {rnd('phi', 9)} AS phi, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(phi) DESC, feature) AS r FROM p WHERE label = 1) WHERE r <= 10""")
def local_attribution(t):
    out = explain.local_attribution(attributions(t).where(F.col("label") == 1), "vec_id", 10)
    return out.select("vec_id", "feature", rounded("phi", 9).alias("phi"), "rank")


@query("dependence_points", f"{RANKED} SELECT vec_id, label, feature, {rnd('value')} AS value, {rnd('phi', 9)} AS phi FROM p WHERE feature = (SELECT feature FROM r WHERE rank = 1)")
def dependence_points(t):
    out = explain.dependence_points(attributions(t), ["vec_id", "label"])
    return out.withColumns({"value": rounded("value"), "phi": rounded("phi", 9)})


CASES = f"""SELECT vec_id, label, CAST(r AS INT) AS case_no FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM {SPLIT} WHERE is_test = 1)
  WHERE r <= CASE WHEN label = 1 THEN 3 ELSE 2 END"""


@query("pick_cases", CASES)
def pick_cases(t):
    return explain.pick_cases(split(t)[1], "label", ["vec_id"]).select("vec_id", "label", "case_no")


@query("rank_compare", f"""{RANKED},
v AS (SELECT * FROM {VECTORS}), c AS ({' UNION ALL '.join(f"SELECT '{v}' AS feature, abs(corr({v}, label)) AS c FROM v" for v in V_NAMES)}),
k AS (SELECT feature, row_number() OVER (ORDER BY c DESC, feature) AS rank FROM c)
SELECT CAST(rank AS INT) AS rank, r.feature AS left_item, k.feature AS right_item FROM r JOIN k USING (rank) WHERE rank <= 5""")
def rank_compare(t):
    left = explain.attribution_rank(attributions(t), 5)
    top = aggregates.corr_with_label(vectors(t), V_NAMES, "label", 5)
    right = top.withColumn("mean_abs", F.abs("corr")).select("feature", F.col("mean_abs").alias("phi"))
    return joins.rank_compare(left, explain.attribution_rank(right, 5))


@query("shapley_sampled")
def shapley_sampled(t):
    train, test = scaled(t)
    model = models.fit_logreg(train, V_NAMES, "label")
    return explain.shapley_sampled(test, model, V_NAMES, "vec_id", train)


@query("lime_local")
def lime_local(t):
    train, test = scaled(t)
    model = models.fit_logreg(train, V_NAMES, "label")
    return explain.lime_local(explain.pick_cases(test, "label", ["vec_id"]), model, train, V_NAMES, "vec_id")

