"""Evaluation, tests, drift, boards."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskweave.functions.columns import rounded, score_flag
from riskweave.ml import stacking
from riskweave.operators import aggregates, drift, evaluate, rolling, stats
from riskweave.plans.registry import query
from riskweave.plans.views import CARDS, MODEL_SCORES, ORDER_SCORES, SCORE_NAMES, V_NAMES, VECTORS, cards, model_scores, order_scores, rnd, vectors
from riskweave.plans.windows import EVENT, WINDOW_RATES
from riskweave.session import stage_path
from riskweave.sources import runlog

# Ascending ranks of every score in one pass per model: ties share the running counts of the value.
COUNTS = f"""c AS (SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg FROM {MODEL_SCORES} GROUP BY model, score),
  k AS (SELECT *, sum(pos) OVER w - pos AS pb, sum(neg) OVER w - neg AS nb, sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
    FROM c WINDOW w AS (PARTITION BY model ORDER BY score))"""
AUC = "sum(pos * (nb + neg / 2.0::DOUBLE)) / max(p::DOUBLE * n)"
AP = "sum(pos / p::DOUBLE * ((p - pb) / (p - pb + n - nb)::DOUBLE))"


@query("auc_roc", f"""
SELECT model, {rnd('(sum(r) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * n)')} AS auc_roc FROM (
  SELECT model, label, sum(label) OVER (PARTITION BY model) AS p, sum(1 - label) OVER (PARTITION BY model) AS n,
    rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r FROM {MODEL_SCORES})
GROUP BY model, p, n""")
def auc_roc(t):
    return evaluate.auc_roc(model_scores(t), "label", "score", ["model"]).withColumn("auc_roc", rounded("auc_roc"))


@query("average_precision", f"WITH {COUNTS} SELECT model, {rnd(AP)} AS avg_precision FROM k GROUP BY model")
def average_precision(t):
    return evaluate.average_precision(model_scores(t), "label", "score", ["model"]).withColumn("avg_precision", rounded("avg_precision"))


@query("roc_points", f"WITH {COUNTS} SELECT model, score AS threshold, {rnd('(p - pb) / p')} AS tpr, {rnd('(n - nb) / n')} AS fpr FROM k")
def roc_points(t):
    out = evaluate.roc_points(model_scores(t), "label", "score", ["model"])
    return out.withColumns({"tpr": rounded("tpr"), "fpr": rounded("fpr")})


@query("pr_points", f"WITH {COUNTS} SELECT model, score AS threshold, {rnd('(p - pb) / (p - pb + n - nb)')} AS precision, {rnd('(p - pb) / p')} AS recall FROM k")
def pr_points(t):
    out = evaluate.pr_points(model_scores(t), "label", "score", ["model"])
    return out.withColumns({"precision": rounded("precision"), "recall": rounded("recall")})


FLAGGED_SCORES = f"(SELECT *, CAST(score >= 0.5 AS INT) AS pred FROM {MODEL_SCORES})"
CONFUSION = f"""SELECT model, count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
  count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn FROM {FLAGGED_SCORES} GROUP BY model"""


@query("confusion", f"""
SELECT *, {rnd('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision, {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall,
  {rnd('CASE WHEN tp + fn = 0 THEN 0 ELSE 100.0 * tp / (tp + fn) END')} AS catch_rate_pct FROM ({CONFUSION})""")
def confusion(t):
    out = evaluate.confusion(model_scores(t).withColumn("pred", score_flag("score")), "label", "pred", ["model"])
    return out.withColumns({c: rounded(c) for c in ("precision", "recall", "catch_rate_pct")})


@query("classification_report", f"""
WITH d AS (SELECT label, CAST(s_stack >= 0.5 AS INT) AS pred FROM {ORDER_SCORES}),
c AS (SELECT k, (SELECT count(*) FROM d WHERE label = k) AS support, (SELECT count(*) FROM d WHERE pred = k) AS predicted,
  (SELECT count(*) FROM d WHERE pred = k AND label = k) AS hit FROM (SELECT label AS k FROM d UNION SELECT pred FROM d)),
m AS (SELECT k, support, hit, coalesce(hit / nullif(predicted, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r FROM c),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM m)
SELECT CAST(k AS VARCHAR) AS "row", {rnd('p')} AS precision, {rnd('r')} AS recall, {rnd('f1')} AS f1, support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, {rnd('sum(hit) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', {rnd('avg(p)')}, {rnd('avg(r)')}, {rnd('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', {rnd('sum(p * support) / sum(support)')}, {rnd('sum(r * support) / sum(support)')}, {rnd('sum(f1 * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM f""")
def classification_report(t):
    out = evaluate.classification_report(order_scores(t).withColumn("pred", score_flag("s_stack")), "label", "pred")
    return out.withColumns({c: rounded(c) for c in ("precision", "recall", "f1")})


SUITE = f"""WITH {COUNTS}, s AS (SELECT model, {AUC} AS auc_roc, {AP} AS avg_precision, sum(pos) FILTER (score >= 0.5) AS tp,
  sum(neg) FILTER (score >= 0.5) AS fp, max(p) AS p FROM k GROUP BY model),
  suite AS (SELECT model, auc_roc, avg_precision, coalesce(2 * tp / (tp + fp + p), 0) AS f1, coalesce(tp / (tp + fp), 0) AS precision, coalesce(tp / p, 0) AS recall FROM s)"""
METRICS = ["auc_roc", "avg_precision", "f1", "precision", "recall"]


def suite(t):
    return evaluate.metric_suite(model_scores(t))


@query("metric_suite", f"{SUITE} SELECT model, {', '.join(f'{rnd(m)} AS {m}' for m in METRICS)} FROM suite")
def metric_suite(t):
    return suite(t).withColumns({m: rounded(m) for m in METRICS})


@query("benchmark_delta", f"""{SUITE}
SELECT {rnd("max(auc_roc) FILTER (model = 's_stack')")} AS proposed, {rnd("max(auc_roc) FILTER (model <> 's_stack')")} AS best_baseline,
  arg_max(model, auc_roc) FILTER (model <> 's_stack') AS baseline_model,
  {rnd("(max(auc_roc) FILTER (model = 's_stack') - max(auc_roc) FILTER (model <> 's_stack')) * 100")} AS delta_points FROM suite""")
def benchmark_delta(t):
    out = evaluate.benchmark_delta(suite(t), "s_stack")
    return out.withColumns({c: rounded(c) for c in ("proposed", "best_baseline", "delta_points")})


def logged(t):
    """Metrics of the four scores, appended to a fresh run log and read back."""
    name = stage_path(t.spark, "runs").rsplit("/", 1)[1]
    runlog.append_rows(runlog.metrics_to_rows(suite(t), "model", METRICS), name)
    runlog.append_run(t.spark, "s_stack", params={"threshold": 0.5}, tags={"phase": "evaluation"}, name=name)
    return runlog.read_runs(t.spark, name)


@query("run_log", f"""{SUITE}
SELECT model AS run, 'metric' AS kind, key, {rnd('value')} AS value, NULL AS text FROM (UNPIVOT suite ON {', '.join(METRICS)} INTO NAME key VALUE value)
UNION ALL SELECT 's_stack', 'param', 'threshold', NULL, '0.5' UNION ALL SELECT 's_stack', 'tag', 'phase', NULL, 'evaluation'""")
def run_log(t):
    return logged(t).withColumn("value", rounded("value"))


@query("leaderboard_wide", f"""{SUITE}
SELECT model, {', '.join(f'{rnd(m, 4)} AS {m}' for m in METRICS)}, '—' AS accuracy FROM suite""")
def leaderboard_wide(t):
    return runlog.leaderboard_wide(logged(t), [*METRICS, "accuracy"])


@query("leaderboard", f"""{SUITE}
SELECT CAST(row_number() OVER (ORDER BY auc_roc DESC, model) AS INT) AS rank, model, {rnd('auc_roc')} AS auc_roc FROM suite""")
def leaderboard(t):
    return rolling.rank_by(suite(t).select("model", "auc_roc"), [F.col("auc_roc").desc(), "model"]).withColumn("auc_roc", rounded("auc_roc"))


# Scores of single features as one-column models: |corr| families by vector block.
_FAMILY = {"early": V_NAMES[:10], "middle": V_NAMES[10:20], "late": V_NAMES[20:]}
FAMILY_SCORES = "(" + " UNION ALL ".join(
    f"SELECT '{v}' AS model, '{fam}' AS category, label, {v} AS score FROM v" for fam, vs in _FAMILY.items() for v in vs
) + ")"


@query("leaderboard_by_category", f"""
WITH v AS (SELECT * FROM {VECTORS}), r AS (
  SELECT model, category, label, sum(label) OVER (PARTITION BY model) AS p, sum(1 - label) OVER (PARTITION BY model) AS n,
    rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2.0::DOUBLE AS r FROM {FAMILY_SCORES}),
b AS (SELECT model, category, (sum(r) FILTER (label = 1) - p * (p + 1) / 2.0::DOUBLE) / (p::DOUBLE * n) AS auc_roc FROM r GROUP BY model, category, p, n)
SELECT category, count(*) AS models, {rnd('max(auc_roc)')} AS best, arg_max(model, auc_roc) AS best_model, {rnd('avg(auc_roc)')} AS mean,
  {rnd('min(auc_roc)')} AS worst, arg_min(model, auc_roc) AS worst_model, count(*) FILTER (auc_roc >= 0.97) AS above_97, count(*) FILTER (auc_roc >= 0.95) AS above_95
FROM b WHERE category <> 'late' GROUP BY category""")
def leaderboard_by_category(t):
    category = F.create_map(*[F.lit(x) for fam, vs in _FAMILY.items() for v in vs for x in (v, fam)])
    long = stats.unpivot(vectors(t), ["vec_id", "label"], V_NAMES).withColumnsRenamed({"feature": "model", "value": "score"})
    board = evaluate.auc_roc(long, "label", "score", ["model"]).withColumn("category", category[F.col("model")])
    out = aggregates.leaderboard_by_category(board, exclude="late")
    return out.withColumns({c: rounded(c) for c in ("best", "mean", "worst")})


GRID = ", ".join(f"({i}, {w[0]!r}::DOUBLE, {w[1]!r}::DOUBLE, {w[2]!r}::DOUBLE, {w[3]!r}::DOUBLE)" for i, w in enumerate(stacking.weight_candidates()))
WEIGHTED = f"""g(id, w1, w2, w3, w4) AS (VALUES {GRID}), d AS (SELECT label, s_stack, s_seq, s_boost, s_iso FROM {ORDER_SCORES}),
  c AS (SELECT id, w1 * s_stack + w2 * s_seq + w3 * s_boost + w4 * s_iso AS score, sum(label) AS pos, sum(1 - label) AS neg FROM d, g GROUP BY 1, 2),
  k AS (SELECT *, sum(neg) OVER (PARTITION BY id ORDER BY score) - neg AS nb, sum(pos) OVER (PARTITION BY id) AS p, sum(neg) OVER (PARTITION BY id) AS n FROM c),
  a AS (SELECT id, {AUC} AS auc FROM k GROUP BY id)"""


@query("weight_grid", f"""WITH {WEIGHTED}
SELECT id AS weight_id, round(w1, 2) AS w1, round(w2, 2) AS w2, round(w3, 2) AS w3, round(w4, 2) AS w4, {rnd('auc')} AS auc_roc FROM a JOIN g USING (id)""")
def weight_grid(t):
    grid = stacking.weight_grid(order_scores(t), SCORE_NAMES, "label")
    return grid.select("weight_id", *[F.round(F.col("weights")[i], 2).alias(f"w{i + 1}") for i in range(4)], rounded("auc_roc").alias("auc_roc"))


@query("best_weights", f"""WITH {WEIGHTED}
SELECT id AS weight_id, round(w1, 2) AS w1, round(w2, 2) AS w2, round(w3, 2) AS w3, round(w4, 2) AS w4, {rnd('auc')} AS auc_roc FROM a JOIN g USING (id) ORDER BY auc DESC, id LIMIT 1""")
def best_weights(t):
    """The first of the weight vectors with the highest AUC."""
    best = stacking.best_weights(stacking.weight_grid(order_scores(t), SCORE_NAMES, "label"))
    return best.select("weight_id", *[F.round(F.col("weights")[i], 2).alias(f"w{i + 1}") for i in range(4)], rounded("auc_roc").alias("auc_roc"))


SIDES = f"""(SELECT *, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(0.7 * (SELECT count(*) FROM events)) THEN 'ref' ELSE 'cur' END AS side
  FROM (SELECT *, ln(1 + amount) AS amount_log, (time_s % 86400) / 3600.0::DOUBLE AS hour, CAST(user_id AS DOUBLE) AS user_no FROM {CARDS}))"""
DRIFT_COLS = ["amount", "amount_log", "hour", "user_no"]


def sides(t):
    c = cards(t).withColumns({
        "amount_log": F.log1p("amount"), "hour": (F.col("time_s") % 86400) / 3600.0, "user_no": F.col("user_id").cast("double"),
    })
    return rolling.positional_split(c, EVENT, 0.7)


LONG = "s AS MATERIALIZED (SELECT * FROM " + SIDES + "), u AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, side, {c} AS v FROM s" for c in DRIFT_COLS
) + ")"
KS_STEPS = """c AS (SELECT feature, v, count(*) FILTER (side = 'ref') AS a, count(*) FILTER (side = 'cur') AS b FROM u GROUP BY feature, v),
  e AS (SELECT feature, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY feature) AS n1, sum(b) OVER (PARTITION BY feature) AS n2
    FROM c WINDOW w AS (PARTITION BY feature ORDER BY v)),
  k AS (SELECT feature, max(abs(ca / n1 - cb / n2)) AS d, CAST(max(n1) AS BIGINT) AS n1, CAST(max(n2) AS BIGINT) AS n2 FROM e GROUP BY feature),
  l AS (SELECT *, sqrt(n1::DOUBLE * n2 / (n1 + n2)) * d AS lam FROM k),
  q AS (SELECT feature, d, n1, n2, CASE WHEN lam < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, (
    SELECT sum(CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * j * j * lam * lam)) FROM range(1, 101) x(j)))) END AS p FROM l)"""
PSI_STEPS = """r AS (SELECT feature, min(v) AS lo, max(v) AS hi, count(*) FILTER (side = 'ref') AS n1, count(*) FILTER (side = 'cur') AS n2 FROM u GROUP BY feature),
  b AS (SELECT feature, CAST(least(floor((v - lo) / ((hi - lo) / 10)), 9) AS INT) AS bin, side FROM u JOIN r USING (feature)),
  h AS (SELECT feature, i AS bin, n1, n2 FROM r, range(0, 10) x(i)),
  f AS (SELECT feature, h.bin, (count(side) FILTER (side = 'ref') + 1e-6) / (n1 + 1e-5) AS rp, (count(side) FILTER (side = 'cur') + 1e-6) / (n2 + 1e-5) AS pp
    FROM h LEFT JOIN b USING (feature, bin) GROUP BY feature, h.bin, n1, n2),
  psi AS (SELECT feature, sum((pp - rp) * ln(pp / rp)) AS psi FROM f GROUP BY feature)"""
KS = f"WITH {LONG}, {KS_STEPS}"
PSI = f"WITH {LONG}, {PSI_STEPS}"


@query("ks_two_sample", f"{KS} SELECT feature, {rnd('d')} AS ks_statistic, n1, n2, {rnd('p')} AS p_value FROM q")
def ks_two_sample(t):
    out = stats.ks_two_sample(sides(t), "side", DRIFT_COLS)
    return out.withColumns({"ks_statistic": rounded("ks_statistic"), "p_value": rounded("p_value")})


@query("ks_drift_report", f"{KS} SELECT feature, {rnd('d')} AS ks_statistic, CAST(p < 0.05 AS INT) AS drift_detected FROM q")
def ks_drift_report(t):
    out = stats.ks_drift_report(stats.ks_two_sample(sides(t), "side", DRIFT_COLS))
    return out.select("feature", rounded("ks_statistic").alias("ks_statistic"), "drift_detected")


@query("mann_whitney", f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY amount) + (count(*) OVER (PARTITION BY amount) - 1) / 2.0::DOUBLE AS r FROM {CARDS}),
t AS (SELECT sum(pow(c, 3) - c) AS ties FROM (SELECT count(*)::DOUBLE AS c FROM {CARDS} GROUP BY amount)),
s AS (SELECT sum(r) FILTER (label = 1) AS r1, (count(*) FILTER (label = 1))::DOUBLE AS n1, (count(*) FILTER (label = 0))::DOUBLE AS n2 FROM r),
z AS (SELECT r1 - n1 * (n1 + 1) / 2 AS u, n1, n2, greatest(abs(r1 - n1 * (n1 + 1) / 2 - n1 * n2 / 2) - 0.5, 0)
  / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM s, t),
p AS (SELECT *, 2 * (SELECT sum(exp(-0.5 * pow(z.z + (i + 0.5) * 0.0005, 2)) * 0.0005 / sqrt(2 * pi())) FROM range(0, 40000) x(i)) AS p FROM z)
SELECT {rnd('u')} AS u, {rnd('z')} AS z, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {rnd('p', 5)} AS p_value, CAST(p < 0.05 AS INT) AS significant FROM p""")
def mann_whitney(t):
    out = stats.mann_whitney(cards(t), "label", "amount", 1)
    return out.withColumns({"u": rounded("u"), "z": rounded("z"), "p_value": rounded("p_value", 5)})


STATUS = "CASE WHEN psi < 0.1 THEN 'Stable' WHEN psi < 0.2 THEN 'Monitor' ELSE 'RETRAIN' END"


@query("psi", f"{PSI} SELECT feature, {rnd('psi')} AS psi FROM psi")
def psi(t):
    return drift.psi(sides(t), "side", DRIFT_COLS).withColumn("psi", rounded("psi"))


# Orders before and after a date: prices stay alike, the date itself moves.
@query("psi_status", f"""
WITH o AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'ref' ELSE 'cur' END AS side, o_totalprice AS price, epoch(o_orderdate) / 86400 AS day FROM orders),
  u AS (SELECT 'price' AS feature, side, price AS v FROM o UNION ALL SELECT 'day', side, day FROM o), {PSI_STEPS}, s AS (SELECT {STATUS} AS status FROM psi)
SELECT status, count(*) AS features, {rnd('count(*) * 100.0 / (SELECT count(*) FROM s)')} AS share_pct FROM s GROUP BY status""")
def psi_status(t):
    frame = t.orders.select(
        F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), "ref").otherwise("cur").alias("side"),
        F.col("o_totalprice").alias("price"), F.datediff("o_orderdate", F.lit("1970-01-01")).cast("double").alias("day"),
    )
    status = drift.psi_status(drift.psi(frame, "side", ["price", "day"]))
    return aggregates.class_distribution(status, "status").withColumnRenamed("rows", "features").withColumn("share_pct", rounded("share_pct"))


@query("drift_summary", f"""WITH {LONG}, {KS_STEPS}, {PSI_STEPS}, w AS ({WINDOW_RATES})
SELECT (SELECT count(*) FROM q WHERE p < 0.05) AS n_ks_drift, (SELECT count(*) FROM psi WHERE psi >= 0.2) AS n_psi_retrain,
  (SELECT count(*) FROM psi WHERE psi >= 0.1 AND psi < 0.2) AS n_psi_monitor,
  (SELECT {rnd('avg(rate_pct)')} FROM w WHERE "window" <= 7) AS ref_rate_pct, (SELECT {rnd('avg(rate_pct)')} FROM w WHERE "window" > 7) AS prod_rate_pct""")
def drift_summary(t):
    split = sides(t)
    ks = stats.ks_drift_report(stats.ks_two_sample(split, "side", DRIFT_COLS))
    scores = drift.psi_status(drift.psi(split, "side", DRIFT_COLS))
    rates = rolling.rate_by_window(cards(t), EVENT, "label", 10)
    out = drift.drift_summary(ks, scores, rates)
    return out.withColumns({"ref_rate_pct": rounded("ref_rate_pct"), "prod_rate_pct": rounded("prod_rate_pct")})


def _leading(matrix: str, tag: str, squarings: int = 16) -> str:
    """Parts of a query that square a matrix until only its first eigenvector is left: v{tag} (j, v), l{tag} (the eigenvalue)."""
    parts = [f"{tag}0 AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM {matrix} WHERE i = j) AS x FROM {matrix})"]
    for k in range(squarings):
        parts += [
            f"q{tag}{k} AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {tag}{k} a JOIN {tag}{k} b ON a.j = b.i GROUP BY a.i, b.j)",
            f"{tag}{k + 1} AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM q{tag}{k} WHERE i = j) AS x FROM q{tag}{k})",
        ]
    last = f"{tag}{squarings}"
    parts += [
        f"v{tag} AS MATERIALIZED (SELECT j, x / sqrt(sum(x * x) OVER ()) AS v FROM {last} WHERE i = (SELECT i FROM {last} WHERE i = j ORDER BY x DESC LIMIT 1))",
        f"l{tag} AS MATERIALIZED (SELECT sum(a.v * m.x * b.v) AS l FROM {matrix} m JOIN v{tag} a ON a.j = m.i JOIN v{tag} b ON b.j = m.j)",
    ]
    return ", ".join(parts)


PCA = f"""WITH u AS (SELECT vec_id, label, name AS j, (value - avg(value) OVER w) / stddev_samp(value) OVER w AS z
    FROM (UNPIVOT (SELECT * FROM {VECTORS}) ON {', '.join(V_NAMES)} INTO NAME name VALUE value) WINDOW w AS (PARTITION BY name)),
  m AS MATERIALIZED (SELECT a.j AS i, b.j AS j, sum(a.z * b.z) / ((SELECT count(*) FROM {VECTORS}) - 1) AS x FROM u a JOIN u b USING (vec_id) GROUP BY a.j, b.j),
  {_leading('m', 'a')}, n AS MATERIALIZED (SELECT i, m.j, x - l * p.v * q.v AS x FROM m JOIN va p ON p.j = m.i JOIN va q ON q.j = m.j, la), {_leading('n', 'b')},
  xy AS (SELECT vec_id, any_value(label) AS label, sum(z * va.v) AS a, sum(z * vb.v) AS b FROM u JOIN va USING (j) JOIN vb USING (j) GROUP BY vec_id)"""


@query("pca_variance", f"""{PCA} SELECT label, count(*) AS rows, {rnd('stddev_samp(a)', 4)} AS spread_1, {rnd('stddev_samp(b)', 4)} AS spread_2,
  {rnd(f'any_value(la.l) / {len(V_NAMES)}')} AS share_1, {rnd(f'any_value(lb.l) / {len(V_NAMES)}')} AS share_2 FROM xy, la, lb GROUP BY label""")
def pca_variance(t):
    """Share of variance of the first two components, with the spread of each class along them."""
    model, projected = stats.pca_fit(vectors(t), V_NAMES, 2)
    shares = model.explainedVariance.toArray()
    xy = vector_to_array("pca")
    return projected.groupBy("label").agg(
        F.count("*").alias("rows"), rounded(F.stddev(xy[0]), 4).alias("spread_1"), rounded(F.stddev(xy[1]), 4).alias("spread_2")
    ).withColumns({"share_1": rounded(F.lit(float(shares[0]))), "share_2": rounded(F.lit(float(shares[1])))})
