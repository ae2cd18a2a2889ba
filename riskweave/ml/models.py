"""Classifiers on Spark's distributed learners; every model adds a `score` column."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, LogisticRegressionModel, MultilayerPerceptronClassifier,
    NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.columns import safe_ratio, total_of
from riskweave.functions.hashing import hash_order
from riskweave.operators.neighbors import knn_join
from riskweave.operators.prep import assemble, with_class_weight
from riskweave.operators.sampling import kfold
from riskweave.session import drop_stage, write_stage

_VEC = "_features"
_OUTPUTS = ["rawPrediction", "probability", "prediction"]


@dataclass
class RiskModel:
    """A fitted MLlib classifier together with its input columns."""

    model: object
    features: list[str]

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        scored = self.model.transform(assemble(df, self.features, _VEC))
        return scored.withColumn(out, vector_to_array("probability")[1]).drop(_VEC, *_OUTPUTS)

    def linear(self) -> tuple[list[float], float] | None:
        """Weights and intercept where the score is the logistic curve of a weighted sum of the features, else None."""
        if isinstance(self.model, LogisticRegressionModel) and self.model.numClasses == 2:
            return [float(c) for c in self.model.coefficients.toArray()], float(self.model.intercept)
        return None

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def _fit(estimator, train: DataFrame, features: list[str], label: str, weight: bool = False, keep: tuple = (), held: bool = False) -> RiskModel:
    """Fit on assembled vectors; `held` keeps them for a learner that goes over its input several times."""
    data = with_class_weight(train, label, "_weight") if weight else train
    extra = ["_weight"] if weight else []
    vectors = assemble(data, features, _VEC).select(_VEC, F.col(label).cast("double").alias("_label"), *extra, *keep)
    estimator = estimator.setFeaturesCol(_VEC).setLabelCol("_label")
    if weight:
        estimator = estimator.setWeightCol("_weight")
    if not held:
        return RiskModel(estimator.fit(vectors), features)
    vectors = vectors.persist()
    try:
        return RiskModel(estimator.fit(vectors), features)
    finally:
        vectors.unpersist()


def fit_logreg(train: DataFrame, features: list[str], label: str, C: float = 0.01, balanced: bool = True, max_iter: int = 1000, tol: float = 1e-6) -> RiskModel:
    """L2 logistic regression; `C` is the inverse penalty on the summed loss, features are scaled beforehand."""
    reg = 1.0 / (C * max(train.count(), 1))
    return _fit(LogisticRegression(regParam=reg, elasticNetParam=0.0, maxIter=max_iter, standardization=False, tol=tol), train, features, label, balanced)


@dataclass
class CalibratedSVM:
    """Mean of sigmoid-calibrated linear SVMs, one per fold."""

    parts: list = field(default_factory=list)
    features: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        data = assemble(df, self.features, _VEC)
        x = vector_to_array(F.col(_VEC))
        scores = []
        for coefficients, intercept, slope, shift in self.parts:
            weights = F.array(*[F.lit(float(c)) for c in coefficients])
            margin = F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(float(intercept)), lambda s, v: s + v)
            scores.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin * slope + shift))))
        return data.withColumn(out, total_of(*scores) / len(scores)).drop(_VEC)


def fit_linear_svm(train: DataFrame, features: list[str], label: str, key: str, C: float = 0.01, folds: int = 3, max_iter: int = 100, seed: int = 42) -> CalibratedSVM:
    """Per fold: a linear SVM on the other folds, then a one-feature logistic fit on the held-out margins."""
    numbered = with_class_weight(kfold(train, label, key, folds, seed), label, "_weight")
    data = assemble(numbered, features, _VEC).select(_VEC, F.col(label).cast("double").alias("_label"), "_weight", "fold").persist()
    parts = []
    try:
        reg = 1.0 / (C * max(data.count(), 1))
        for i in range(folds):
            svm = LinearSVC(featuresCol=_VEC, labelCol="_label", weightCol="_weight", regParam=reg, maxIter=max_iter, standardization=False).fit(
                data.where(F.col("fold") != i)
            )
            margins = svm.transform(data.where(F.col("fold") == i)).select(
                "_label", array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("_margin")
            )
            sigmoid = LogisticRegression(featuresCol="_margin", labelCol="_label").fit(margins)
            parts.append((svm.coefficients.toArray(), svm.intercept, float(sigmoid.coefficients[0]), float(sigmoid.intercept)))
    finally:
        data.unpersist()
    return CalibratedSVM(parts, features)


def fit_gaussian_nb(train: DataFrame, features: list[str], label: str) -> RiskModel:
    return _fit(NaiveBayes(modelType="gaussian"), train, features, label)


def knn_scores(train: DataFrame, test: DataFrame, features: list[str], label: str, key: str, k: int = 5, train_rows: int = 30_000, exact: bool = True) -> DataFrame:
    """(key, score): distance-weighted vote of the k nearest training rows; exact matches decide alone.

    The model is made of at most `train_rows` training rows, taken in the order of a hash of
    their key; all test rows are scored.
    """
    train = train.orderBy(hash_order(key), key).limit(train_rows)
    as_array = lambda d: d.na.fill(0.0, features).withColumn("_x", F.array(*[F.col(c).cast("double") for c in features]))
    near = knn_join(as_array(test), as_array(train), "_x", k, key, key, exact=exact)
    votes = near.join(train.select(F.col(key).cast("long").alias("neighbor_id"), F.col(label).alias("_l")), "neighbor_id")
    same = F.col("distance") == 0
    weight = F.when(~same, 1.0 / F.when(same, F.lit(1.0)).otherwise(F.col("distance"))).otherwise(0.0)
    sums = votes.groupBy("query_id").agg(
        F.count_if(same).alias("m"), F.count_if(same & (F.col("_l") == 1)).alias("mp"),
        F.sum(weight).alias("w"), F.sum(F.when(F.col("_l") == 1, weight).otherwise(0.0)).alias("wp"),
    )
    score = F.when(F.col("m") > 0, safe_ratio(F.col("mp"), F.col("m"))).otherwise(safe_ratio(F.col("wp"), F.col("w")))
    return sums.select(F.col("query_id").alias(key), score.alias("score"))


def fit_random_forest(train: DataFrame, features: list[str], label: str, trees: int = 200, depth: int = 15, min_leaf: int = 4, seed: int = 42) -> RiskModel:
    est = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)
    return _fit(est, train, features, label, weight=True)


def fit_gbt(train: DataFrame, features: list[str], label: str, rounds: int = 200, rate: float = 0.05, depth: int = 4, subsample: float = 0.8, balanced: bool = False, seed: int = 42) -> RiskModel:
    est = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=subsample, seed=seed)
    return _fit(est, train, features, label, weight=balanced, held=True)


# Settings of the three boosted-tree flavours.
BOOSTED = {
    "xgb": {"rounds": 500, "rate": 0.05, "depth": 6, "subsample": 0.8},
    "lgb": {"rounds": 500, "rate": 0.05, "depth": 6, "subsample": 0.8},
    "cat": {"rounds": 500, "rate": 0.05, "depth": 6, "subsample": 1.0},
}


def fit_boosted(train: DataFrame, validation: DataFrame, features: list[str], label: str, flavour: str = "xgb", tolerance: float = 0.001, seed: int = 42, **overrides) -> RiskModel:
    """Boosted trees with positive weight; rounds stop when the loss on `validation` stops falling."""
    p = {**BOOSTED[flavour], **overrides}
    both = train.withColumn("_valid", F.lit(False)).unionByName(validation.withColumn("_valid", F.lit(True)))
    est = GBTClassifier(
        maxIter=p["rounds"], stepSize=p["rate"], maxDepth=p["depth"], subsamplingRate=p["subsample"], seed=seed,
        validationIndicatorCol="_valid", validationTol=tolerance,
    )
    return _fit(est, both, features, label, weight=True, keep=("_valid",), held=True)


def _tree_column(node) -> Column:
    """Prediction of a tree with continuous splits over the array column `_x`."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    inside = F.get("_x", F.lit(node.split().featureIndex())) <= F.lit(float(node.split().threshold()))
    return F.when(inside, _tree_column(node.leftChild())).otherwise(_tree_column(node.rightChild()))


@dataclass
class AdaBoost:
    """Weighted vote of shallow trees."""

    trees: list
    weights: list[float]
    features: list[str]

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        cols = df.columns
        data = assemble(df, self.features, _VEC).withColumn("_x", vector_to_array(_VEC))
        # All trees are one expression over the features, so a row is scored in one pass.
        votes = [F.lit(alpha) * _tree_column(tree._call_java("rootNode")) for tree, alpha in zip(self.trees, self.weights)]
        data = data.withColumn("_votes", F.aggregate(F.array(*votes, F.lit(0.0)), F.lit(0.0), lambda a, v: a + v))
        # Two-class vote: the margin between the classes, through a logistic link.
        total = sum(self.weights) or 1.0
        return data.withColumn(out, F.lit(1.0) / (F.lit(1.0) + F.exp(-(2 * F.col("_votes") - total) / total))).select(*cols, out)


def fit_adaboost(train: DataFrame, features: list[str], label: str, rounds: int = 200, rate: float = 0.1, depth: int = 2, seed: int = 42, write_every: int = 10) -> AdaBoost:
    """SAMME for two classes: each round reweights the rows the last tree got wrong.

    A round reads the rows several times, so their weights are kept until the next ones are
    there; they are written every `write_every` rounds so the plan stays short, and a lost
    part is made again from the written table.
    """
    spark = train.sparkSession
    # The classes are stated, so no fit has to look for them.
    classes = {"ml_attr": {"type": "nominal", "name": "_label", "vals": ["0", "1"]}}
    data = assemble(train, features, _VEC).select(_VEC, F.col(label).cast("double").alias("_label", metadata=classes), F.lit(1.0).alias("_w"))
    data, path = write_stage(data, "boost")
    total = data.agg(F.sum("_w")).first()[0] or 0.0
    trees, weights, kept = [], [], [data.persist()]
    try:
        for i in range(rounds):
            tree = DecisionTreeClassifier(
                featuresCol=_VEC, labelCol="_label", weightCol="_w", maxDepth=depth, seed=seed + i, rawPredictionCol="", probabilityCol="",
            ).fit(data)
            judged = tree.transform(data).withColumn("_wrong", F.col("prediction") != F.col("_label"))
            wrong = judged.agg(F.sum(F.when(F.col("_wrong"), F.col("_w")).otherwise(0.0))).first()[0] or 0.0
            while len(kept) > 1:
                kept.pop(0).unpersist()
            error = wrong / total if total else 0.0
            if error >= 0.5 and not trees:
                raise ValueError("the first tree is no better than chance")
            if error >= 0.5:
                break
            alpha = rate * (math.log((1 - error) / max(error, 1e-12)))
            trees.append(tree)
            weights.append(alpha)
            if error <= 1e-12 or i + 1 == rounds:
                break
            # Rescaling keeps the weights summing to 1 without another pass.
            rescaled = (total - wrong) + wrong * math.exp(alpha)
            data = judged.select(_VEC, "_label", (F.col("_w") * F.when(F.col("_wrong"), math.exp(alpha)).otherwise(1.0) / F.lit(rescaled)).alias("_w"))
            total = 1.0
            if (i + 1) % write_every == 0:
                data, new_path = write_stage(data, "boost")
                drop_stage(spark, path)
                path = new_path
            kept.append(data.persist())
    finally:
        for rows in kept:
            rows.unpersist()
    return AdaBoost(trees, weights, features)


def fit_mlp(train: DataFrame, features: list[str], label: str, hidden: tuple = (256, 128, 64), max_iter: int = 100, seed: int = 42) -> RiskModel:
    est = MultilayerPerceptronClassifier(layers=[len(features), *hidden, 2], maxIter=max_iter, seed=seed)
    return _fit(est, train, features, label)


def importance(model: RiskModel, k: int = 20) -> DataFrame:
    """The `k` most important features of a tree model."""
    values = model.model.featureImportances.toArray()
    ranked = sorted(zip(model.features, map(float, values)), key=lambda p: (-p[1], p[0]))[:k]
    rows = [(i, name, value) for i, (name, value) in enumerate(ranked, 1)]
    return SparkSession.active().createDataFrame(rows, "rank int, feature string, importance double")


def linear_score_udf(coefficients: dict[str, float], intercept: float = 0.0) -> Column:
    """Logistic score as an Arrow-batched function over many columns; nulls count as 0."""
    names, beta = list(coefficients), np.array(list(coefficients.values()), dtype=np.float64)

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        x = np.column_stack([c.fillna(0.0).to_numpy(dtype=np.float64) for c in cols])
        return pd.Series(1.0 / (1.0 + np.exp(-(x @ beta + intercept))))

    return score(*[F.col(c) for c in names])
