"""Exact metrics of scored tables, ties included, for any number of models at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import safe_ratio
from riskweave.operators.ordered import ordered_pairs, prefix_sums


def _scored(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    return df.select(*by, label, score).where(F.col(score).isNotNull() & F.col(label).isNotNull())


def _class_sums(label: str) -> dict[str, Column]:
    return {"pos": F.count_if(F.col(label) == 1), "neg": F.count_if(F.col(label) != 1)}


def _counts(df: DataFrame, label: str, score: str, by: list[str], partitions: int | None = None) -> DataFrame:
    """Positives and negatives per distinct score with their running sums."""
    return prefix_sums(_scored(df, label, score, by), by, score, _class_sums(label), partitions)


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order; a tie counts half."""
    pairs = F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2)
    all_pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return F.try_divide(F.sum(pairs), all_pairs)


def _average_precision() -> Column:
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    return F.sum(F.try_divide(F.col("pos").cast("double"), F.col("pos_total").cast("double")) * (tp / (tp + fp)))


def auc_of_pairs() -> Column:
    """AUC from the output of `ordered_pairs`."""
    return F.try_divide(F.col("pairs"), F.col("pos").cast("double") * F.col("neg"))


def auc_roc(df: DataFrame, label: str, score: str, by: tuple | list = (), partitions: int | None = None) -> DataFrame:
    pairs = ordered_pairs(_scored(df, label, score, list(by)), list(by), score, _class_sums(label), partitions)
    return pairs.select(*by, auc_of_pairs().alias("auc_roc"))


def average_precision(df: DataFrame, label: str, score: str, by: tuple | list = (), partitions: int | None = None) -> DataFrame:
    return _counts(df, label, score, list(by), partitions).groupBy(*by).agg(_average_precision().alias("avg_precision"))


def roc_points(df: DataFrame, label: str, score: str, by: tuple | list = ()) -> DataFrame:
    """True and false positive rate when everything scoring at least `threshold` is flagged."""
    c = _counts(df, label, score, list(by))
    return c.select(
        *by,
        F.col(score).alias("threshold"),
        ((F.col("pos_total") - F.col("pos_before")) / F.col("pos_total")).alias("tpr"),
        ((F.col("neg_total") - F.col("neg_before")) / F.col("neg_total")).alias("fpr"),
    )


def pr_points(df: DataFrame, label: str, score: str, by: tuple | list = ()) -> DataFrame:
    c = _counts(df, label, score, list(by))
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    return c.select(
        *by, F.col(score).alias("threshold"), (tp / (tp + fp)).alias("precision"), (tp / F.col("pos_total")).alias("recall")
    )


def confusion(df: DataFrame, label: str, pred: str, by: tuple | list = ()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall and catch rate in percent; empty denominators give 0."""
    hit = lambda l, p: F.count_if((F.col(label) == l) & (F.col(pred) == p))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (
        df.groupBy(*by)
        .agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
        .withColumns(
            {
                "precision": safe_ratio(tp, tp + fp),
                "recall": safe_ratio(tp, tp + fn),
                "catch_rate_pct": safe_ratio(tp, tp + fn) * 100,
            }
        )
    )


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Rows per class plus accuracy, macro avg and weighted avg.

    Only the class-by-class counts leave the first aggregation.
    """
    cells = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    # Each cell counts towards its true class, its predicted class, or both.
    sides = cells.select(
        F.explode(F.array(
            F.struct(F.col("l").alias("k"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"),
                     F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("p").alias("k"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"),
                     F.lit(0).cast("long").alias("hit")),
        )).alias("s")
    ).select("s.*")
    per_class = (
        sides.groupBy("k")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
        .withColumns({"precision": safe_ratio(F.col("hit"), F.col("predicted")), "recall": safe_ratio(F.col("hit"), F.col("support"))})
        .withColumn("f1", safe_ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    n = F.sum("support")
    weighted = lambda c: safe_ratio(F.sum(F.col(c) * F.col("support")), n)
    whole = per_class.agg(
        n.alias("support"),
        safe_ratio(F.sum("hit"), n).alias("acc"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )
    row = lambda name, p, r, f: F.struct(
        F.lit(name).alias("row"), p.alias("precision"), r.alias("recall"), f.alias("f1"), F.col("support").alias("support")
    )
    nothing = F.lit(None).cast("double")
    summary = whole.select(
        F.inline(
            F.array(
                row("accuracy", nothing, nothing, F.col("acc")),
                row("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1")),
                row("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1")),
            )
        )
    )
    classes = per_class.select(F.col("k").cast("string").alias("row"), "precision", "recall", "f1", "support")
    return classes.unionByName(summary)


def metric_suite(df: DataFrame, label: str = "label", score: str = "score", by: tuple | list = ("model",), threshold: float = 0.5) -> DataFrame:
    """AUC, average precision, F1, precision and recall per model, from one set of prefix sums."""
    c = _counts(df, label, score, list(by))
    flagged = F.col(score) >= threshold
    at = lambda n: F.sum(F.when(flagged, F.col(n)).otherwise(0))
    tp, fp, p = F.col("_tp"), F.col("_fp"), F.col("_p")
    return (
        c.groupBy(*by)
        .agg(
            _auc().alias("auc_roc"), _average_precision().alias("avg_precision"),
            at("pos").alias("_tp"), at("neg").alias("_fp"), F.max("pos_total").alias("_p"),
        )
        .withColumns(
            {
                "f1": safe_ratio(2 * tp, tp + fp + p),
                "precision": safe_ratio(tp, tp + fp),
                "recall": safe_ratio(tp, p),
            }
        )
        .drop("_tp", "_fp", "_p")
    )


def benchmark_delta(suite: DataFrame, proposed: str, metric: str = "auc_roc", name: str = "model") -> DataFrame:
    """The proposed model against the best other one, difference in points."""
    is_it = F.col(name) == proposed
    best = F.struct(F.col(metric), F.col(name))
    return suite.agg(
        F.max(F.when(is_it, F.col(metric))).alias("proposed"),
        F.max(F.when(~is_it, F.col(metric))).alias("best_baseline"),
        F.max_by(F.when(~is_it, F.col(name)), F.when(~is_it, best)).alias("baseline_model"),
    ).withColumn("delta_points", (F.col("proposed") - F.col("best_baseline")) * 100)


