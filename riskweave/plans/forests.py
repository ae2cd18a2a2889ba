"""Boosted and randomised trees and their attributions on the supplied vectors, with SQL that grows the trees anew."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import rounded
from riskweave.ml import boosting, explain, extra
from riskweave.operators import sampling
from riskweave.plans.learning import SPLIT, split
from riskweave.plans.registry import query
from riskweave.plans.views import V_NAMES, rnd

PRIME, SCALE = 2147483647, 1048576


def fitted(t, flavour: str, **settings):
    """A boosted model of the training part, stopped by a validation part of it, and the test part."""
    train, test = split(t)
    inner = sampling.stratified_split(train, "label", "vec_id", 0.2, seed=7)
    fit, valid = inner.where(F.col("is_test") == 0), inner.where(F.col("is_test") == 1)
    return boosting.fit_boosted(fit, valid, V_NAMES, "label", "vec_id", flavour, **settings), test


def scored(t, flavour: str) -> DataFrame:
    model, test = fitted(t, flavour)
    return model.transform(test).select("vec_id", "label", "score")


@query("ml_boosted_xgb")
def ml_boosted_xgb(t):
    """Test scores of level-wise trees with sampled rows and columns."""
    return scored(t, "xgb")


@query("ml_boosted_lgb")
def ml_boosted_lgb(t):
    """Test scores of leaf-wise trees."""
    return scored(t, "lgb")


@query("ml_boosted_cat")
def ml_boosted_cat(t):
    """Test scores of symmetric trees with gradients from earlier segments."""
    return scored(t, "cat")


def node_table(spark, model) -> DataFrame:
    """tree, path from the root (L, R), feature, cut, value, cover."""
    out = []
    for number, tree in enumerate(model.trees):
        stack = [(0, "")]
        while stack:
            v, path = stack.pop()
            leaf = tree.feature[v] < 0
            out.append((number, path, None if leaf else model.features[tree.feature[v]], None if leaf else float(tree.cut[v]), float(tree.value[v]), float(tree.cover[v])))
            if not leaf:
                stack += [(tree.left[v], path + "L"), (tree.right[v], path + "R")]
    nodes = spark.createDataFrame(out, "tree int, path string, feature string, cut double, value double, cover double")
    return nodes.withColumns({c: rounded(c, 6) for c in ("cut", "value", "cover")})


UNPIVOT = f"SELECT vec_id, label, name, CAST(substr(name, 2) AS INT) - 1 AS j, value FROM (UNPIVOT (SELECT * FROM {SPLIT} WHERE is_test = 0) ON {', '.join(V_NAMES)} INTO NAME name VALUE value)"
L1, L2, RATE, MIN_GAIN, MIN_WEIGHT = 0.1, 1.0, 0.05, 0.1, 5.0


def gain(g: str, h: str) -> str:
    return f"pow(sign({g}) * greatest(abs({g}) - {L1}, 0), 2) / greatest({h} + {L2}, 1e-12)"


def boosted_sql(rounds: int, depth: int = 6, bins: int = 256, share: float = 0.8, seed: int = 42) -> str:
    """Trees of the level-wise learner, grown with joins and windows: sums by bin, running sums, best gain by node."""
    parts = [
        f"u AS MATERIALIZED ({UNPIVOT})",
        f"""r AS (SELECT j, value, row_number() OVER (PARTITION BY j ORDER BY value) AS k, count(*) OVER (PARTITION BY j) AS n, max(value) OVER (PARTITION BY j) AS top FROM u)""",
        f"e AS MATERIALIZED (SELECT DISTINCT j, value AS edge FROM r WHERE value < top AND k IN (SELECT i * n // {bins} FROM range(1, {bins}) x(i)))",
        "en AS MATERIALIZED (SELECT j, edge, row_number() OVER (PARTITION BY j ORDER BY edge) - 1 AS b FROM e)",
        "x AS MATERIALIZED (SELECT vec_id, label, u.j, value, (SELECT count(*) FROM en WHERE en.j = u.j AND edge < value) AS b FROM u)",
        f"d0 AS MATERIALIZED (SELECT DISTINCT vec_id, label, 0.0::DOUBLE AS margin, (('0x' || substr(md5(concat_ws('|', vec_id, '7')), 1, 8))::BIGINT % {PRIME - 1}) + 1 AS u FROM u)",
        "w AS (SELECT count_if(label = 0) / count_if(label = 1) AS w FROM d0)",
    ]
    for t in range(rounds):
        factor = 1 + int(hashlib.md5(f"{t}|{seed}".encode()).hexdigest()[:8], 16) % (PRIME - 1)
        p = "(1 / (1 + exp(-margin)))"
        weight = "CASE WHEN label = 1 THEN w ELSE 1.0 END"
        parts += [
            f"""g{t} AS MATERIALIZED (SELECT vec_id, margin, u * {factor} % {PRIME} < {share} * {PRIME} AS used, '' AS path,
              round_even({weight} * ({p} - label) * {SCALE}, 0)::BIGINT AS g, round_even({weight} * {p} * (1 - {p}) * {SCALE}, 0)::BIGINT AS h FROM d{t}, w)""",
            f"""c{t} AS (SELECT j FROM (SELECT j, row_number() OVER (ORDER BY md5(concat_ws('|', '{t}', j::VARCHAR, '{seed}'))) AS k FROM range(0, {len(V_NAMES)}) x(j))
              WHERE k <= ceil({share} * {len(V_NAMES)}))""",
        ]
        rows = f"g{t}"
        splits = []
        for level in range(depth):
            s = f"{t}_{level}"
            own = f"SELECT path, j, b, sum(g) AS g, sum(h) AS h FROM {rows} JOIN x USING (vec_id) WHERE used AND j IN (SELECT j FROM c{t}) GROUP BY path, j, b"
            run = "sum({0}) OVER (PARTITION BY path, j ORDER BY b) / {1}.0 AS {0}l, sum({0}) OVER (PARTITION BY path, j) / {1}.0 AS {0}"
            best = f"0.5 * ({gain('gl', 'hl')} + {gain('(g - gl)', '(h - hl)')} - {gain('g', 'h')}) - {MIN_GAIN}"
            # A cut may lie on an edge that no row of the node has in its bin, but the first of equal gains is the one with rows.
            parts += [
                f"h{s} AS (SELECT path, j, b, {run.format('g', SCALE)}, {run.format('h', SCALE)} FROM ({own}))",
                f"k{s} AS (SELECT path, j, b, edge, {best} AS gain FROM h{s} JOIN en USING (j, b) WHERE hl >= {MIN_WEIGHT} AND h - hl >= {MIN_WEIGHT})",
                f"s{s} AS MATERIALIZED (SELECT path, j, b, edge FROM k{s} WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, j, b) = 1)",
                f"""g{s} AS MATERIALIZED (SELECT r.vec_id, r.margin, r.used, r.g, r.h,
                  CASE WHEN s.path IS NULL THEN r.path WHEN x.b <= s.b THEN r.path || 'L' ELSE r.path || 'R' END AS path
                  FROM {rows} r LEFT JOIN s{s} s USING (path) LEFT JOIN x ON x.vec_id = r.vec_id AND x.j = s.j)""",
            ]
            splits.append(f"SELECT path, j, edge FROM s{s}")
            rows = f"g{s}"
        parts += [
            f"s{t} AS ({' UNION ALL '.join(splits)})",
            f"""n{t} AS (SELECT p.path, any_value(s.j) AS j, any_value(s.edge) AS edge, coalesce(sum(g) FILTER (used), 0) / {SCALE}.0 AS g, coalesce(sum(h) FILTER (used), 0) / {SCALE}.0 AS h
              FROM (SELECT '' AS path UNION SELECT path || 'L' FROM s{t} UNION SELECT path || 'R' FROM s{t}) p LEFT JOIN s{t} s USING (path) JOIN {rows} r ON starts_with(r.path, p.path) GROUP BY p.path)""",
            f"v{t} AS MATERIALIZED (SELECT path, j, edge, h, -{RATE} * (sign(g) * greatest(abs(g) - {L1}, 0)) / (h + {L2}) AS value FROM n{t})",
            f"d{t + 1} AS MATERIALIZED (SELECT vec_id, label, d.margin + value AS margin, u FROM d{t} d JOIN {rows} r USING (vec_id) JOIN v{t} v ON v.path = r.path)",
        ]
    out = " UNION ALL ".join(
        f"SELECT {t} AS tree, path, CASE WHEN j IS NOT NULL THEN 'V' || (j + 1) END AS feature, {rnd('edge')} AS cut, {rnd('value')} AS value, {rnd('h')} AS cover FROM v{t}" for t in range(rounds)
    )
    return "WITH " + ",\n".join(parts) + "\n" + out


@query("ml_boosted_trees", boosted_sql(2))
def ml_boosted_trees(t):
    """Nodes of the first two level-wise trees, grown on the whole training part."""
    train, _ = split(t)
    return node_table(t.spark, boosting.fit_boosted(train, None, V_NAMES, "label", "vec_id", "xgb", rounds=2))


def extra_sql(depth: int = 15, k: int = 8, min_leaf: int = 4, seed: int = 42) -> list[str]:
    """Parts of a query that grows the first randomised tree: node numbers by row after each level, splits, nodes."""
    draw = f"md5(concat_ws('|', '0', node::VARCHAR, j::VARCHAR, '{seed}'))"
    parts = [
        f"u AS MATERIALIZED ({UNPIVOT})",
        "w AS (SELECT count(*) / (2.0 * count_if(label = 0)) AS w0, count(*) / (2.0 * count_if(label = 1)) AS w1 FROM (SELECT DISTINCT vec_id, label FROM u))",
        "r0 AS MATERIALIZED (SELECT DISTINCT vec_id, label, 1::BIGINT AS node FROM u)",
    ]
    for level in range(depth):
        rows = f"r{level}"
        parts += [
            f"o{level} AS (SELECT node FROM {rows} WHERE node >= {1 << level} GROUP BY node HAVING count_if(label = 0) > 0 AND count_if(label = 1) > 0 AND count(*) >= {2 * min_leaf if level else 1})",
            f"""c{level} AS MATERIALIZED (SELECT node, j, ('0x' || substr({draw}, 9, 8))::BIGINT / 4294967296.0 AS spot FROM o{level}, range(0, {len(V_NAMES)}) x(j)
              QUALIFY row_number() OVER (PARTITION BY node ORDER BY {draw}) <= {k})""",
            f"""b{level} AS MATERIALIZED (SELECT node, j, min(value) + any_value(spot) * (max(value) - min(value)) AS cut, min(value) < max(value) AS spread
              FROM c{level} JOIN {rows} USING (node) JOIN u USING (vec_id, j) GROUP BY node, j)""",
            f"""i{level} AS (SELECT node, j, any_value(cut) AS cut, count_if(value <= cut AND r.label = 0) AS a, count_if(value <= cut AND r.label = 1) AS b, count_if(value > cut AND r.label = 0) AS c, count_if(value > cut AND r.label = 1) AS d
              FROM b{level} JOIN {rows} r USING (node) JOIN u USING (vec_id, j) WHERE spread GROUP BY node, j)""",
            f"""s{level} AS MATERIALIZED (SELECT node, j, cut FROM i{level}, w WHERE a + b >= {min_leaf} AND c + d >= {min_leaf} QUALIFY row_number() OVER (PARTITION BY node
              ORDER BY 2 * (a * w0) * (b * w1) / (a * w0 + b * w1) + 2 * (c * w0) * (d * w1) / (c * w0 + d * w1), j) = 1)""",
            f"""r{level + 1} AS MATERIALIZED (SELECT r.vec_id, r.label, CASE WHEN s.node IS NULL THEN r.node WHEN u.value <= s.cut THEN 2 * r.node ELSE 2 * r.node + 1 END AS node
              FROM {rows} r LEFT JOIN s{level} s USING (node) LEFT JOIN u ON u.vec_id = r.vec_id AND u.j = s.j)""",
        ]
    parts += [
        f"s AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM s{i}' for i in range(depth))})",
        "p AS (SELECT 1::BIGINT AS node UNION SELECT 2 * node FROM s UNION SELECT 2 * node + 1 FROM s)",
        f"""n AS MATERIALIZED (SELECT p.node, any_value(s.j) AS j, any_value(s.cut) AS cut, any_value(w0) * count_if(label = 0) + any_value(w1) * count_if(label = 1) AS cover, any_value(w1) * count_if(label = 1) / cover AS value
          FROM p LEFT JOIN s USING (node) JOIN r{depth} r ON p.node = r.node >> (length(bin(r.node)) - length(bin(p.node))), w WHERE r.node >= p.node GROUP BY p.node)""",
    ]
    return parts


EXTRA_NODES = f"""WITH {', '.join(extra_sql())}
SELECT 0 AS tree, replace(replace(substr(bin(node), 2), '0', 'L'), '1', 'R') AS path, CASE WHEN j IS NOT NULL THEN 'V' || (j + 1) END AS feature,
  {rnd('cut')} AS cut, {rnd('value')} AS value, {rnd('cover')} AS cover FROM n"""


@query("ml_extra_nodes", EXTRA_NODES)
def ml_extra_nodes(t):
    """Nodes of the first randomised tree at the depth of the whole forest."""
    train, _ = split(t)
    return node_table(t.spark, extra.fit_extra_trees(train, V_NAMES, "label", trees=1))


# Points and weights of a quadrature on [0, 1] that is exact for polynomials up to degree 15.
GAUSS = [(0.019855071751231856, 0.05061426814518813), (0.10166676129318664, 0.11119051722668724), (0.2372337950418355, 0.15685332293894363), (0.4082826787521751, 0.18134189168918100),
         (0.5917173212478249, 0.18134189168918100), (0.7627662049581645, 0.15685332293894363), (0.8983332387068134, 0.11119051722668724), (0.9801449282487681, 0.05061426814518813)]

SHAP = f"""WITH {', '.join(extra_sql())},
x AS MATERIALIZED (SELECT vec_id, CAST(substr(name, 2) AS INT) - 1 AS j, value FROM (UNPIVOT (SELECT * FROM {SPLIT} WHERE is_test = 1) ON {', '.join(V_NAMES)} INTO NAME name VALUE value)),
leaf AS (SELECT node AS leaf, value AS v FROM n WHERE j IS NULL),
step AS (SELECT leaf, v, a.j, a.cut, (leaf >> (length(bin(leaf)) - length(bin(a.node)) - 1)) & 1 AS side, b.cover / a.cover AS share
  FROM leaf JOIN n a ON a.j IS NOT NULL AND a.node < leaf AND a.node = leaf >> (length(bin(leaf)) - length(bin(a.node))) JOIN n b ON b.node = leaf >> (length(bin(leaf)) - length(bin(a.node)) - 1)),
way AS MATERIALIZED (SELECT vec_id, leaf, any_value(v) AS v, step.j, bool_and(CASE WHEN side = 0 THEN value <= cut ELSE value > cut END)::INT AS o, product(share) AS z FROM step JOIN x USING (j) GROUP BY vec_id, leaf, step.j),
q AS (SELECT unnest({[p for p, _ in GAUSS]}) AS spot, unnest({[w for _, w in GAUSS]}) AS weight),
whole AS (SELECT vec_id, leaf, spot, any_value(weight) AS weight, product(o * spot + z * (1 - spot)) AS m FROM way, q GROUP BY vec_id, leaf, spot),
phi AS (SELECT vec_id, j, sum(v * (o - z) * weight * m / (o * spot + z * (1 - spot))) AS phi FROM way JOIN whole USING (vec_id, leaf) GROUP BY vec_id, j)
"""


def first_tree_attributions(t) -> DataFrame:
    """vec_id, label, feature, value, phi of the test rows, for the first randomised tree."""
    train, test = split(t)
    model = extra.fit_extra_trees(train, V_NAMES, "label", trees=1)
    return explain.tree_attribution(test, model, ["vec_id", "label"])


@query("tree_shap_values", f"{SHAP} SELECT vec_id, 'V' || (j + 1) AS feature, {rnd('phi', 9)} AS phi FROM phi WHERE abs(phi) > 1e-12")
def tree_shap_values(t):
    """Attributions of every test row, where they are not zero."""
    return first_tree_attributions(t).where(F.abs("phi") > 1e-12).select("vec_id", "feature", rounded("phi", 9).alias("phi"))


@query("tree_attribution_top", f"""{SHAP}, f AS (SELECT j, sum(abs(phi)) / (SELECT count(DISTINCT vec_id) FROM x) AS m FROM phi GROUP BY j)
SELECT 'V' || (j + 1) AS feature, {rnd('m', 9)} AS mean_abs, CAST(row_number() OVER (ORDER BY m DESC, 'V' || (j + 1)) AS INT) AS rank FROM f WHERE m > 1e-12""")
def tree_attribution_top(t):
    """Mean absolute attribution of every feature that the tree splits on."""
    ranked = explain.attribution_rank(first_tree_attributions(t)).where(F.col("mean_abs") > 1e-12)
    return ranked.withColumn("mean_abs", rounded("mean_abs", 9))


@query("tree_attribution_rank")
def tree_attribution_rank(t):
    """Mean absolute attribution of each feature in the whole randomised forest, over all test rows."""
    train, test = split(t)
    model = extra.fit_extra_trees(train, V_NAMES, "label")
    return explain.attribution_rank(explain.tree_attribution(test, model, ["vec_id", "label"]))


@query("tree_local_attribution", f"""{SHAP}, every AS (SELECT vec_id, 'V' || (j + 1) AS feature, coalesce(phi, 0) AS phi FROM x LEFT JOIN phi USING (vec_id, j)
  JOIN (SELECT vec_id, label FROM {SPLIT}) USING (vec_id) WHERE label = 1)
SELECT vec_id, feature, {rnd('phi', 9)} AS phi, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY {rnd('abs(phi)', 9)} DESC, feature) AS r FROM every) WHERE r <= 10""")
def tree_local_attribution(t):
    """The ten largest attributions of every flagged test row in the first randomised tree."""
    long = first_tree_attributions(t).where(F.col("label") == 1).withColumn("phi", rounded("phi", 9))
    return explain.local_attribution(long, "vec_id", 10).select("vec_id", "feature", "phi", "rank")


@query("tree_dependence_points", f"""{SHAP}, top AS (SELECT j FROM phi GROUP BY j ORDER BY sum(abs(phi)) DESC LIMIT 1)
SELECT vec_id, label, 'V' || (j + 1) AS feature, {rnd('value')} AS value, {rnd('coalesce(phi, 0)', 9)} AS phi
FROM x SEMI JOIN top USING (j) LEFT JOIN phi USING (vec_id, j) JOIN (SELECT vec_id, label FROM {SPLIT}) USING (vec_id)""")
def tree_dependence_points(t):
    """Value and attribution of every test row for the feature that matters most in the first randomised tree."""
    out = explain.dependence_points(first_tree_attributions(t), ["vec_id", "label"])
    return out.withColumns({"value": rounded("value"), "phi": rounded("phi", 9)})
