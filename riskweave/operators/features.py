"""Gold-layer row features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import col_of, day_of_seconds, flag, hour_of_seconds, night_flag, total_of
from riskweave.operators.ordered import exact_quantiles
from riskweave.session import materialize

EPSILON = 1e-9


def amount_math(df: DataFrame, c: str) -> DataFrame:
    return df.withColumns({"amount_log": F.log1p(c), "amount_squared": F.pow(F.col(c), F.lit(2))})


def interactions(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_{b}_interaction".lower(): F.col(a) * F.col(b) for a, b in pairs})


def row_sum(df: DataFrame, cols: list[str], out: str = "row_sum") -> DataFrame:
    return df.withColumn(out, total_of(*cols))


def abs_sum(df: DataFrame, cols: list[str | Column], out: str = "v_abs_sum") -> DataFrame:
    return df.withColumn(out, total_of(*[F.abs(col_of(c)) for c in cols]))


def time_features(df: DataFrame, c: str) -> DataFrame:
    """Hour, day, weekday, night and weekend flags from a time in seconds."""
    day = day_of_seconds(c)
    weekday = (day % 7).cast("int")
    return df.withColumns(
        {
            "tx_hour": hour_of_seconds(c),
            "tx_day": day,
            "is_night": night_flag(hour_of_seconds(c)),
            "tx_day_of_week": weekday,
            "is_weekend": flag(weekday >= 5),
        }
    )


def amount_flags(df: DataFrame, c: str, thresholds: dict[str, float]) -> DataFrame:
    return df.withColumns({name: flag(F.col(c) > limit) for name, limit in thresholds.items()})


def balance_features(df: DataFrame, old: str, new: str, amount: str | None, side: str = "orig") -> DataFrame:
    """Change of balance and empty-account flag; with `amount` also its ratio to the old balance."""
    outs = {f"balance_diff_{side}": F.col(new) - F.col(old), f"{side}_balance_zero": flag(F.col(old) == 0)}
    if amount:
        outs[f"balance_ratio_{side}"] = F.col(amount) / (F.col(old) + F.lit(EPSILON))
    return df.withColumns(outs)


def one_hot(df: DataFrame, c: str, values: dict[str, str]) -> DataFrame:
    """`values` maps an output name to the category it marks."""
    return df.withColumns({name: flag(F.col(c) == v) for name, v in values.items()})


def group_flag(df: DataFrame, c: str, values: list[str], out: str) -> DataFrame:
    return df.withColumn(out, flag(F.col(c).isin(values)))


def rule_flags(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.withColumns({name: flag(rule) for name, rule in rules.items()})


def account_drain(diff: str, zero_flag: str, limit: float = -1000.0) -> Column:
    return (F.col(diff) < limit) & (F.col(zero_flag) == 0)


def case_risk(df: DataFrame, c: str, safe: list[str], out: str) -> DataFrame:
    """0 for a safe value, 1 for a missing one, 2 for anything else."""
    return df.withColumn(out, F.when(F.col(c).isin(safe), 0).when(F.col(c).isNull(), 1).otherwise(2))


def presence_flag(df: DataFrame, c: str, out: str) -> DataFrame:
    return df.withColumn(out, flag(F.col(c).isNotNull()))


def equality_flag(df: DataFrame, c: str, value, out: str) -> DataFrame:
    """1/0, null where the column is null."""
    return df.withColumn(out, flag(F.col(c) == value))


def winsorize(df: DataFrame, c: str, q: float = 0.99, low: float = 0.0, by: list[str] | None = None, out: str | None = None) -> DataFrame:
    """Clip to [low, exact q-quantile], per group when `by` is given."""
    out = out or f"{c}_clipped"
    by = by or []
    caps = exact_quantiles(df, by, c, {"_cap": q})
    if not by:
        cap = F.lit(caps.first()["_cap"])
        return df.withColumn(out, F.greatest(F.lit(low), F.least(F.col(c), cap)))
    capped = df.join(materialize(caps, "caps"), by)
    return capped.withColumn(out, F.greatest(F.lit(low), F.least(F.col(c), F.col("_cap")))).drop("_cap")


def minmax_score(df: DataFrame, c: str, out: str, invert: bool = False) -> DataFrame:
    """Scale a score to [0, 1] over the whole table; `invert` turns low into high."""
    low, high = df.agg(F.min(c), F.max(c)).first()
    if low is None:
        return df.withColumn(out, F.lit(None).cast("double"))
    scaled = (F.col(c) - F.lit(low)) / F.lit(high - low) if high > low else F.when(F.col(c).isNotNull(), F.lit(0.0))
    return df.withColumn(out, F.lit(1.0) - scaled if invert else scaled)
