"""Isolation forest (Liu et al., 2008): trees are grown in parallel, rows are scored in place."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.operators.ordered import exact_quantiles
from riskweave.operators.sampling import sample_n
from riskweave.session import materialize

_NODE = "tree int, node int, feature int, threshold double, left int, right int, length double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n leaves."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(limit: int, seed: int):
    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        rng = np.random.default_rng([seed, tree])
        x = np.array(pdf.sort_values("_k")["_x"].tolist(), dtype=np.float64)
        nodes, open_nodes = [None], [(0, np.arange(len(x)), 0)]
        while open_nodes:
            at, rows, depth = open_nodes.pop()
            part = x[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            choices = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(choices):
                nodes[at] = (tree, at, -1, 0.0, -1, -1, depth + average_path(len(rows)))
                continue
            f = int(rng.choice(choices))
            cut = float(rng.uniform(low[f], high[f]))
            goes_left = part[:, f] <= cut
            left, right = len(nodes), len(nodes) + 1
            nodes += [None, None]
            nodes[at] = (tree, at, f, cut, left, right, 0.0)
            open_nodes += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "length"])

    return grow


@dataclass
class IsolationForestModel:
    trees: list[dict]
    features: list[str]
    sample: int
    cut: float | None = None

    def transform(self, df: DataFrame, out: str = "iso_anomaly_score") -> DataFrame:
        """Add the anomaly score, high for unusual rows, and -1/1 as `iso_prediction` once a cut is set."""
        shared = df.sparkSession.sparkContext.broadcast(self.trees)
        norm = average_path(self.sample) or 1.0

        @F.pandas_udf("double")
        def score(rows: pd.Series) -> pd.Series:
            if not len(rows):
                return pd.Series([], dtype="float64")
            x = np.array(rows.tolist(), dtype=np.float64)
            total = np.zeros(len(x))
            every = np.arange(len(x))
            for t in shared.value:
                at = np.zeros(len(x), dtype=np.int64)
                while True:
                    f = t["feature"][at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    left = x[every, np.maximum(f, 0)] <= t["threshold"][at]
                    at = np.where(inner, np.where(left, t["left"][at], t["right"][at]), at)
                total += t["length"][at]
            return pd.Series(np.power(2.0, -(total / len(shared.value)) / norm))

        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features])
        scored = df.withColumn(out, score(values))
        if self.cut is None:
            return scored
        return scored.withColumn("iso_prediction", F.when(F.col(out) >= self.cut, -1).otherwise(1))


class IsolationForest:
    def __init__(self, n_trees: int = 200, sample: int = 256, contamination: float | None = None, seed: int = 42):
        self.n_trees, self.sample, self.contamination, self.seed = n_trees, sample, contamination, seed

    def fit(self, df: DataFrame, features: list[str], key: str) -> IsolationForestModel:
        """Grow trees on `sample` rows each, all drawn from one hash sample of bounded size."""
        rows = df.select(F.col(key).alias("_k"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]).alias("_x"))
        pool = materialize(sample_n(rows, self.n_trees * self.sample, "_k", self.seed), "pool")
        size = pool.count()
        each = min(self.sample, size)
        spread = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(self.n_trees - 1))))
        # A generous share of the hash range keeps few rows per tree to rank.
        share = min(1.0, (each + 8.0 * math.sqrt(each) + 8.0) / max(size, 1))
        drawn = spread.withColumn("_h", hash_order("_k", "tree", seed=self.seed)).where(F.col("_h") <= f"{int(share * 0xFFFFFFFF):08x}" + "g")
        order = Window.partitionBy("tree").orderBy("_h")
        picked = drawn.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= each).select("tree", "_k", "_x")
        limit = max(1, math.ceil(math.log2(max(each, 2))))
        nodes = picked.groupBy("tree").applyInPandas(_grow(limit, self.seed), _NODE).toPandas()
        trees = []
        for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
            trees.append({c: part[c].to_numpy() for c in ("feature", "threshold", "left", "right", "length")})
        model = IsolationForestModel(trees, features, each)
        if self.contamination is not None:
            scored = model.transform(df.select(*features), "_s")
            model.cut = exact_quantiles(scored, [], "_s", {"cut": 1.0 - self.contamination}).first()["cut"]
        return model

