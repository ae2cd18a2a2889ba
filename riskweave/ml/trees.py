"""Tree models as node tables: scoring and exact attributions, in batches of rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.session import ship_package


@dataclass
class Tree:
    """Nodes by number, the root first. A row goes left where its feature is at most `cut`.

    Leaves have feature -1; the lists may be arrays once a tree is grown. `bin` is the number of the cut among the feature's bin edges,
    `cover` the weight of the training rows that reached the node.
    """

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    cover: list[float] = field(default_factory=list)

    def add(self, value: float, cover: float) -> int:
        for name, v in (("feature", -1), ("cut", 0.0), ("bin", -1), ("left", -1), ("right", -1), ("value", value), ("cover", cover)):
            getattr(self, name).append(v)
        return len(self.value) - 1

    def split(self, node: int, feature: int, bin: int, cut: float, left: int, right: int) -> None:
        self.feature[node], self.bin[node], self.cut[node], self.left[node], self.right[node] = feature, bin, cut, left, right

    def find(self, data: np.ndarray, binned: bool = False) -> np.ndarray:
        """The leaf of every row of `data` (values, or numbers of bins)."""
        feature, left, right = np.asarray(self.feature), np.asarray(self.left), np.asarray(self.right)
        cut = np.asarray(self.bin if binned else self.cut)
        at, rows = np.zeros(len(data), dtype=np.int64), np.arange(len(data))
        while len(rows):
            rows = rows[feature[at[rows]] >= 0]
            here = at[rows]
            at[rows] = np.where(data[rows, feature[here]] <= cut[here], left[here], right[here])
        return at

    def paths(self) -> list[tuple[int, list[tuple[int, float, float, float]]]]:
        """(leaf, [(feature, above, up to, share)]): on the way to each leaf, the interval of each
        feature once, and the share of the cover that follows the leaf at the feature's splits."""
        out, stack = [], [(0, {})]
        while stack:
            node, held = stack.pop()
            f = self.feature[node]
            if f < 0:
                out.append((node, [(g, *v) for g, v in held.items()]))
                continue
            low, high, share = held.get(f, (-np.inf, np.inf, 1.0))
            whole = self.cover[node] or 1.0
            for child, span in ((self.left[node], (low, min(high, self.cut[node]))), (self.right[node], (max(low, self.cut[node]), high))):
                stack.append((child, {**held, f: (*span, share * self.cover[child] / whole)}))
        return out

    def mean(self) -> float:
        """The value a row is expected to get when none of its features is known."""
        return sum(self.value[leaf] * float(np.prod([p[3] for p in path])) for leaf, path in self.paths())


_quadrature = lru_cache(np.polynomial.legendre.leggauss)


def _weights(follows: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley weight of each feature of a path, for rows of `follows` (does the row take the path at this feature).

    A set of known features keeps a row on the path with the product of `follows` over the
    set and of `shares` over the rest. The mean over all orders is the integral from 0 to 1
    of a polynomial in the chance of a feature to be known, the product of one factor for
    each other feature. A Gauss quadrature of half as many points as features is exact for
    it; a factor has two values, so logarithms turn the products into matrix products.
    """
    spots, weights = _quadrature((follows.shape[1] + 1) // 2)
    spots, weights = (1.0 + spots[:, None]) / 2.0, weights[:, None] / 2.0
    shares = np.maximum(shares, 1e-300)
    taken, missed = spots + shares * (1.0 - spots), shares * (1.0 - spots)
    whole = np.exp(follows @ np.log(taken / missed).T + np.log(missed).sum(axis=1))
    known, unknown = whole @ (weights * (1.0 - shares) / taken), whole @ (weights / (1.0 - spots))
    return np.where(follows > 0, known, -unknown)


def shap(trees: list[Tree], data: np.ndarray) -> np.ndarray:
    """Exact Shapley values of the sum of the trees for each row and feature, as the cover tells the
    distribution of unknown features (Lundberg et al., 2020). Rows that follow a path in the
    same way share the work, so a leaf costs at most one quadrature for each way that occurs."""
    phi, columns = np.zeros(data.shape[::-1]), np.ascontiguousarray(data.T)
    for tree in trees:
        for leaf, path in tree.paths():
            if not path:
                continue
            feature, low, high, share = (np.array(c) for c in zip(*path))
            feature = feature.astype(np.int64)
            x = columns[feature]
            follows = (x > low[:, None]) & (x <= high[:, None])
            if len(path) < 63 and len(data) > 1 << min(len(path), 30):
                code = (1 << np.arange(len(path))) @ follows
                ways, which = np.unique(code, return_inverse=True)
                each = (ways[:, None] >> np.arange(len(path)) & 1).astype(np.float64)
                phi[feature] += tree.value[leaf] * _weights(each, share).T[:, which.reshape(-1)]
            else:
                phi[feature] += tree.value[leaf] * _weights(follows.T.astype(np.float64), share).T
    return phi.T


def scores(trees: list[Tree], data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data))
    for tree in trees:
        out += np.asarray(tree.value)[tree.find(data)]
    return out


def matrix(columns: tuple[pd.Series, ...]) -> np.ndarray:
    """Columns side by side; nulls count as 0."""
    return np.column_stack([c.to_numpy(dtype=np.float64, na_value=0.0) for c in columns]) if columns else np.zeros((0, 0))


@dataclass
class TreeModel:
    """A sum of trees on top of a base value; its score is the sum itself or the logistic curve of it."""

    trees: list[Tree]
    base: float
    features: list[str]
    logistic: bool = True

    def margin(self) -> Column:
        trees, base = self.trees, self.base

        @F.pandas_udf("double")
        def margin(*columns: pd.Series) -> pd.Series:
            return pd.Series(base + scores(trees, matrix(columns)))

        return margin(*[F.col(c).cast("double") for c in self.features])

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        ship_package(df.sparkSession)
        margin = self.margin()
        return df.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) if self.logistic else margin)

    def expected(self) -> float:
        """The margin of a row of which nothing is known."""
        return self.base + sum(t.mean() for t in self.trees)

    def attributions(self, df: DataFrame, out: str = "phi") -> DataFrame:
        """`df` with the array `out`: for each feature what it adds to the row's margin.

        The values of a row and `expected()` add up to its margin. Every leaf is work for a
        row, so also a short table is dealt to all cores.
        """
        trees = self.trees

        @F.pandas_udf("array<double>")
        def values(*columns: pd.Series) -> pd.Series:
            return pd.Series(list(shap(trees, matrix(columns))))

        ship_package(df.sparkSession)
        df = df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
        return df.withColumn(out, values(*[F.col(c).cast("double") for c in self.features]))

    def nodes(self) -> list[tuple]:
        """(tree, node, feature, cut, left, right, value, cover) of all nodes."""
        return [
            (t, i, self.features[f] if f >= 0 else None, *((float(cut), int(left), int(right)) if f >= 0 else (None, None, None)), float(value), float(cover))
            for t, tree in enumerate(self.trees)
            for i, (f, cut, left, right, value, cover) in enumerate(zip(tree.feature, tree.cut, tree.left, tree.right, tree.value, tree.cover))
        ]

    def importance(self) -> dict[str, int]:
        """Number of splits by feature."""
        out = dict.fromkeys(self.features, 0)
        for tree in self.trees:
            for f in tree.feature:
                if f >= 0:
                    out[self.features[f]] += 1
        return out
