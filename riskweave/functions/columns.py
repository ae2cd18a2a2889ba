"""Column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """Predicate as 0/1; null stays null."""
    return condition.cast("int")


def total_of(*cols: str | Column) -> Column:
    return reduce(add, [col_of(c) for c in cols])


def rounded(c: str | Column, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0."""
    return F.round(col_of(c).cast("double"), digits) + F.lit(0.0)


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 on the clock of the timestamp, whatever the session's time zone."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    elapsed = col_of(ts).cast("timestamp_ntz") - origin
    return F.floor(elapsed.cast("interval second").cast("decimal(20,6)")).cast("long")


def hour_of_seconds(t: str | Column) -> Column:
    return ((col_of(t) % 86400) / 3600).cast("int")


def day_of_seconds(t: str | Column) -> Column:
    return (col_of(t) / 86400).cast("int")


def night_flag(hour: str | Column) -> Column:
    h = col_of(hour)
    return flag((h < 6) | (h > 22))


def risk_tier(score: str | Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins, lowest edge included; anything outside gives 'nan'."""
    s = col_of(score)
    tier = F.when((s >= edges[0]) & (s <= edges[1]), labels[0])
    for low, high, label in zip(edges[1:-1], edges[2:], labels[1:]):
        tier = tier.when((s > low) & (s <= high), label)
    return tier.otherwise("nan")


# Edges and labels of the two risk scales.
TIERS_3 = ([0.0, 0.5, 0.8, 1.0], ["LOW", "MEDIUM", "HIGH"])
TIERS_4 = ([0.0, 0.3, 0.5, 0.8, 1.0], ["VERY LOW", "LOW", "MEDIUM", "HIGH"])


def score_flag(score: str | Column, threshold: float = 0.5) -> Column:
    return flag(col_of(score) >= threshold)


def fused(weights: dict[str, float]) -> Column:
    """Weighted sum of score columns."""
    return total_of(*[F.lit(float(w)) * F.col(c) for c, w in weights.items()])


def hour_label(ts: str | Column) -> Column:
    return F.date_format(F.date_trunc("hour", col_of(ts)), "yyyy-MM-dd HH:00")


def clean_feature_name(text: str | Column) -> Column:
    """First word of a rule text such as 'v4 <= 0.31', without comparison signs."""
    return F.translate(F.split(col_of(text), " ").getItem(0), "<>=", "")


def direction(value: str | Column) -> Column:
    return F.when(col_of(value) > 0, "up").otherwise("down")


def sliced(array: str, names: list[str], start: int = 1) -> list[Column]:
    """Elements `start`.. of an array column as named double columns."""
    return [F.element_at(F.col(array), start + i).cast("double").alias(n) for i, n in enumerate(names)]


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """0 where the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
