"""Attributions of scores to features, for whole tables and for single cases."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.operators.ordered import exact_quantiles
from riskweave.operators.stats import unpivot

_TWO_53 = float(1 << 53)


def linear_attribution(df: DataFrame, coefficients: dict[str, float], keep: list[str]) -> DataFrame:
    """Long (keep, feature, value, phi): beta * (x - mean), exact for a linear model."""
    names = list(coefficients)
    means = df.agg(*[F.avg(c).alias(c) for c in names]).first()
    effect = F.create_map(*[F.lit(v) for c in names for v in (c, float(coefficients[c]))])
    center = F.create_map(*[F.lit(v) for c in names for v in (c, float(means[c] or 0.0))])
    long = unpivot(df, keep, names)
    return long.withColumn("phi", effect[F.col("feature")] * (F.col("value") - center[F.col("feature")]))


def tree_attribution(df: DataFrame, model, keep: list[str]) -> DataFrame:
    """Long (keep, feature, value, phi): exact attributions of a `TreeModel` to its features."""
    rows = F.arrays_zip(
        F.array(*[F.lit(c) for c in model.features]).alias("feature"),
        F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in model.features]).alias("value"), F.col("_phi").alias("phi"),
    )
    return model.attributions(df, "_phi").select(*keep, F.explode(rows).alias("_e")).select(*keep, "_e.feature", "_e.value", "_e.phi")


def attribution_rank(long: DataFrame, k: int | None = None) -> DataFrame:
    """Mean |phi| per feature with its rank; there is one row per feature."""
    means = long.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    order = Window.orderBy(F.col("mean_abs").desc(), "feature")
    ranked = means.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k) if k else ranked


def local_attribution(long: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The k largest |phi| of every case."""
    order = Window.partitionBy(key).orderBy(F.abs("phi").desc(), "feature")
    return long.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dependence_points(long: DataFrame, keep: list[str]) -> DataFrame:
    """Value and attribution of every row for the globally most important feature."""
    top = attribution_rank(long, 1).first()["feature"]
    return long.where(F.col("feature") == top).select(*keep, "feature", "value", "phi")


def pick_cases(df: DataFrame, label: str, order: list[str], n_pos: int = 3, n_neg: int = 2) -> DataFrame:
    """The first positives and negatives in `order`, numbered per class."""
    first = lambda value, n: df.where(F.col(label) == value).orderBy(*order).limit(n)
    cases = first(1, n_pos).unionByName(first(0, n_neg))
    return cases.withColumn("case_no", F.row_number().over(Window.partitionBy(label).orderBy(*order)))


def _walk(beta: list[float], intercept: float):
    """What each feature of a case adds to a logistic score when the features of a background row
    are replaced one by one, in the order of their hashes (equal ones together)."""
    weights = np.array(beta)

    @F.pandas_udf("array<double>")
    def walk(x: pd.Series, w: pd.Series, h: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        case, other, drawn = (np.stack(c.to_numpy()) for c in (x, w, h))
        order = np.argsort(drawn, axis=1, kind="stable")
        steps = np.take_along_axis((case - other) * weights, order, axis=1)
        after = (other @ weights + intercept)[:, None] + np.cumsum(steps, axis=1)
        before = np.column_stack([other @ weights + intercept, after[:, :-1]])
        drawn = np.take_along_axis(drawn, order, axis=1)
        for i, j in np.argwhere(drawn[:, 1:] == drawn[:, :-1]):
            before[i, j + 1] = before[i, j]
        for i, j in np.argwhere(drawn[:, 1:] == drawn[:, :-1])[::-1]:
            after[i, j] = after[i, j + 1]
        out = np.empty(after.shape)
        np.put_along_axis(out, order, 1.0 / (1.0 + np.exp(-after)) - 1.0 / (1.0 + np.exp(-before)), axis=1)
        return pd.Series(list(out))

    return walk


def shapley_sampled(cases: DataFrame, model, cols: list[str], key: str, background: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """Sampled Shapley values (Strumbelj and Kononenko, 2014) of any model with `transform`.

    Every case meets `n` background rows, each with its own random feature order. For each
    feature the model scores the row once with and once without it; nothing is collected.
    A model that is the logistic curve of a weighted sum (`linear`) is walked along each
    order: a feature moves the sum by its own term, so no row is put together or scored anew.
    """
    as_array = lambda d: F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    # At most n rows, so numbering them in one task and broadcasting them is bounded.
    drawn = background.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n).select(as_array(background).alias("_w"), F.col(key).alias("_bk"))
    drawn = drawn.withColumn("_s", F.row_number().over(Window.orderBy("_bk"))).drop("_bk")
    met = cases.select(F.col(key), as_array(cases).alias("_x")).withColumn("_s", F.explode(F.sequence(F.lit(1), F.lit(n))))
    met = met.join(F.broadcast(drawn), "_s")
    line = model.linear() if hasattr(model, "linear") else None
    slots = F.sequence(F.lit(0), F.lit(len(cols) - 1))
    met = met.withColumn("_h", F.transform(slots, lambda i: F.xxhash64(F.lit(seed), F.col(key), F.col("_s"), i)))
    names = F.array(*[F.lit(c) for c in cols])
    if line:
        walked = met.select(key, _walk(*line)("_x", "_w", "_h").alias("_d"), F.lit(1).alias("_n"))
        sums = walked.groupBy(key).agg(*[F.sum(F.get("_d", F.lit(i))).alias(f"_d{i}") for i in range(len(cols))], F.sum("_n").alias("_n"))
        pairs = F.arrays_zip(names.alias("feature"), F.array(*[F.col(f"_d{i}") / F.col("_n") for i in range(len(cols))]).alias("phi"))
        return sums.select(key, F.explode(pairs).alias("_e")).select(key, "_e.feature", "_e.phi")
    each = met.select("*", F.posexplode("_h").alias("_j", "_hj"))
    mix = lambda inside: F.transform(slots, lambda i: F.when(inside(F.get("_h", i)), F.get("_x", i)).otherwise(F.get("_w", i)))
    pairs = each.select(
        key, "_j",
        F.explode(F.array(
            F.struct(F.lit(1.0).alias("sign"), mix(lambda h: h <= F.col("_hj")).alias("z")),
            F.struct(F.lit(-1.0).alias("sign"), mix(lambda h: h < F.col("_hj")).alias("z")),
        )).alias("p"),
    )
    rows = pairs.select(F.col(key), "_j", "p.sign", *[F.get("p.z", F.lit(i)).alias(c) for i, c in enumerate(cols)])
    return (
        model.transform(rows, "_score").groupBy(key, "_j")
        .agg((F.sum(F.col("sign") * F.col("_score")) * 2 / F.count(F.lit(1))).alias("phi"))
        .select(key, F.get(names, F.col("_j")).alias("feature"), "phi")
    )


def quartile_edges(train: DataFrame, cols: list[str]) -> dict[str, list[float]]:
    """Exact minimum, quartiles and maximum per feature; one small row per feature."""
    qs = {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q3": 0.75, "q4": 1.0}
    rows = exact_quantiles(unpivot(train, [], cols), ["feature"], "value", qs).collect()
    return {r["feature"]: [r[q] for q in qs] for r in rows}


def _ridge(x: np.ndarray, y: np.ndarray, w: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    mean_x, mean_y = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc, yc = x - mean_x, y - mean_y
    beta = np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(x.shape[1]), (xc * w[:, None]).T @ yc)
    return beta, float(mean_y - mean_x @ beta)


def _local_fit(key: str, cols: list[str], k: int):
    width = 0.75 * np.sqrt(len(cols))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.array(pdf.sort_values("_s")["_same"].tolist(), dtype=np.float64)
        y = pdf.sort_values("_s")["_score"].to_numpy()
        w = np.sqrt(np.exp(-((1.0 - x).sum(axis=1)) / width**2))
        first, _ = _ridge(x, y, w, 0.01)
        chosen = np.argsort(-np.abs(first), kind="stable")[:k]
        beta, intercept = _ridge(x[:, chosen], y, w, 1.0)
        order = np.argsort(-np.abs(beta), kind="stable")
        return pd.DataFrame({
            key: [pdf[key].iloc[0]] * len(order), "rank": np.arange(1, len(order) + 1, dtype=np.int32),
            "feature": [cols[chosen[i]] for i in order], "weight": beta[order], "local_score": intercept + beta.sum(),
        })

    return fit


def lime_local(cases: DataFrame, model, train: DataFrame, cols: list[str], key: str, n: int = 1000, k: int = 10, seed: int = 42) -> DataFrame:
    """Local linear explanation of a few cases (Ribeiro et al., 2016).

    Each case gets `n` copies whose features are redrawn from the quartile bins of the
    training data. Copies are scored by the model, weighted by how many features stay in
    the case's bin, and a ridge fit per case (exactly `n` rows) gives the weights.
    """
    edges = quartile_edges(train, cols)
    table = F.array(*[F.array(*[F.lit(float(e)) for e in edges[c]]) for c in cols])
    slots = F.sequence(F.lit(0), F.lit(len(cols) - 1))
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    bin_of = lambda v, e: F.when(v <= e[1], 0).when(v <= e[2], 1).when(v <= e[3], 2).otherwise(3)
    uniform = lambda i, salt: F.pmod(F.xxhash64(F.lit(seed + salt), F.col(key), F.col("_s"), i), F.lit(1 << 53)) / F.lit(_TWO_53)
    copies = cases.select(F.col(key), x.alias("_x")).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    copies = copies.withColumn("_bin", F.transform(slots, lambda i: F.when(
        F.col("_s") == 0, bin_of(F.get("_x", i), F.get(table, i))
    ).otherwise(F.floor(uniform(i, 0) * 4).cast("int"))))
    low = lambda i: F.get(F.get(table, i), F.get("_bin", i))
    high = lambda i: F.get(F.get(table, i), F.get("_bin", i) + 1)
    copies = copies.withColumns({
        "_same": F.transform(slots, lambda i: (F.get("_bin", i) == bin_of(F.get("_x", i), F.get(table, i))).cast("double")),
        "_z": F.transform(slots, lambda i: F.when(F.col("_s") == 0, F.get("_x", i)).otherwise(low(i) + uniform(i, 1) * (high(i) - low(i)))),
    })
    rows = copies.select(F.col(key), "_s", "_same", *[F.get("_z", F.lit(i)).alias(c) for i, c in enumerate(cols)])
    scored = model.transform(rows, "_score").select(key, "_s", "_same", "_score")
    kind = cases.schema[key].dataType.simpleString()
    return scored.groupBy(key).applyInPandas(
        _local_fit(key, cols, k), f"{key} {kind}, rank int, feature string, weight double, local_score double"
    )
