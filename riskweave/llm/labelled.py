"""Labelled rows for the classifiers: a bounded, reproducible sample of the learning folds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fold


def sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, most: int) -> DataFrame:
    """text and y (0 or 1) of at most `most` labelled rows outside fold `held` of `parts`.

    Rows are taken in the order of a hash of their id, so the sample is the same wherever rows
    lie. Null labels, labels other than 0 and 1, null ids and labels without a document teach
    nothing. The sample of ids has at most `most` rows and is sent to all tasks.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    chosen = known.where(fold(F.col("doc_id"), parts) != held).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")


def platt(margin: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of the logistic curve through (margin, y), with the usual softened targets."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x, w = np.stack([margin, np.ones_like(margin)], axis=1), np.zeros(2)
    w[1] = np.log((pos + 1) / (neg + 1))

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - target @ z + ridge / 2 * w @ w

    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        grad = x.T @ (p - target) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(2), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])
