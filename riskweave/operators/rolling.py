"""Row-frame windows that stay parallel when there is no key, or one key is huge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.columns import col_of, flag, total_of
from riskweave.operators.ordered import after_cut, order_cuts, with_global_index
from riskweave.session import materialize

HOT_ROWS = 5_000_000
BLOCK_ROWS = 250_000

_AGGREGATES = {"count": F.count, "avg": F.avg, "std": F.stddev, "max": F.max, "min": F.min, "sum": F.sum}


def _windowed(df: DataFrame, part: list[str], order: list, frames: dict) -> DataFrame:
    outs = {
        out: _AGGREGATES[fn](c).over(Window.partitionBy(*part).orderBy(*[col_of(o) for o in order]).rowsBetween(-n, 0))
        for out, (fn, c, n) in frames.items()
    }
    return df.withColumns(outs)


def _in_blocks(df, part, order, frames, block_rows, partitions) -> DataFrame:
    """Cut the global order into blocks and give each block the last rows of the one before."""
    halo = max(n for _, _, n in frames.values())
    size = max(block_rows, halo + 1)
    indexed = with_global_index(df, [*part, *order], "_idx", partitions)
    block = F.floor(F.col("_idx") / size).cast("long")
    homes = F.when(F.col("_idx") % size >= size - halo, F.array(block, block + 1)).otherwise(F.array(block))
    spread = indexed.withColumn("_block", F.explode(homes))
    rolled = _windowed(spread, [*part, "_block"], ["_idx"], frames)
    return rolled.where(F.col("_block") == block).drop("_idx", "_block")


def hot_keys(df: DataFrame, part: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows; at most rows/hot_rows of them exist."""
    return materialize(df.groupBy(*part).count().where(F.col("count") > hot_rows).select(*part), "hotkeys")


def _same_key(left: str, right: str, part: list[str]) -> Column:
    condition = F.lit(True)
    for p in part:
        condition = condition & F.col(f"{left}.{p}").eqNullSafe(F.col(f"{right}.{p}"))
    return condition


def rolling(
    df: DataFrame,
    part: list[str],
    order: list,
    frames: dict[str, tuple[str, str, int]],
    hot_rows: int = HOT_ROWS,
    block_rows: int = BLOCK_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Aggregates over the current row and the `n` rows before it.

    `frames` maps an output name to (aggregate, column, n). `order` must end in a
    unique key. Keys below `hot_rows` share one ordinary window shuffle; larger keys,
    or the whole table when `part` is empty, are processed in overlapping blocks.
    """
    if not part:
        return _in_blocks(df, part, order, frames, block_rows, partitions)
    # Written once: the keys are counted before the windows are computed.
    df = materialize(df, "rolling")
    hot = hot_keys(df, part, hot_rows)
    if hot.isEmpty():
        return _windowed(df, part, order, frames)
    on = _same_key("d", "h", part)
    cold = df.alias("d").join(hot.alias("h"), on, "left_anti")
    large = df.alias("d").join(hot.alias("h"), on, "left_semi")
    return _windowed(cold, part, order, frames).unionByName(
        _in_blocks(large, part, order, frames, block_rows, partitions)
    )


def rolling_global(df: DataFrame, order: list, n: int, aggs: dict[str, tuple[str, str]], **options) -> DataFrame:
    """`aggs` maps an output name to (aggregate, column), all over the last n+1 rows of the table."""
    return rolling(df, [], order, {out: (fn, c, n) for out, (fn, c) in aggs.items()}, **options)


def velocity(df: DataFrame, part: list[str], order: list, frames: dict, **options) -> DataFrame:
    """Per-account counts, means, spreads and sums over recent rows."""
    return rolling(df, part, order, frames, **options)


def zscore(value: str, mean: str, std: str) -> Column:
    """Distance from the rolling mean; null where the frame has one row."""
    return (F.col(value) - F.col(mean)) / (F.col(std) + F.lit(1e-9))


def spike(value: str, mean: str, factor: float = 3.0) -> Column:
    return flag(F.col(value) > F.col(mean) * factor)


def rolling_zscore(df: DataFrame, part: list[str], order: list, c: str, n: int, out: str = "zscore", **options) -> DataFrame:
    frames = {"_mean": ("avg", c, n), "_std": ("std", c, n)}
    return rolling(df, part, order, frames, **options).withColumn(out, zscore(c, "_mean", "_std")).drop("_mean", "_std")


def amount_spike(
    df: DataFrame, part: list[str], order: list, c: str, n: int, factor: float = 3.0, out: str = "amount_spike", **options
) -> DataFrame:
    rolled = rolling(df, part, order, {"_mean": ("avg", c, n)}, **options)
    return rolled.withColumn(out, spike(c, "_mean", factor)).drop("_mean")


def moving_avg_full(df: DataFrame, order: list, c: str, n: int, out: str = "moving_avg", **options) -> DataFrame:
    """Mean of the last `n` rows, null until `n` rows exist."""
    frames = {"_mean": ("avg", c, n - 1), "_rows": ("count", c, n - 1)}
    rolled = rolling(df, [], order, frames, **options)
    return rolled.withColumn(out, F.when(F.col("_rows") == n, F.col("_mean"))).drop("_mean", "_rows")


def rank_by(df: DataFrame, order: list, out: str = "rank") -> DataFrame:
    """1-based rank of every row; `order` must end in a unique key."""
    return with_global_index(df, order, "_idx").withColumn(out, (F.col("_idx") + 1).cast("int")).drop("_idx")


def positional_split(df: DataFrame, order: list[str], fraction: float, out: str = "side", partitions: int | None = None) -> DataFrame:
    """'ref' for the first `fraction` of the rows in `order`, 'cur' for the rest."""
    (cut,) = order_cuts(df, order, [int(df.count() * fraction)], partitions)
    return df.withColumn(out, F.when(after_cut(df, order, cut), "cur").otherwise("ref"))


def rate_by_window(df: DataFrame, order: list[str], label: str, n: int, partitions: int | None = None) -> DataFrame:
    """Label rate in percent for `n` equal contiguous windows; the remainder is left out."""
    size = df.count() // n
    cuts = order_cuts(df, order, [size * i for i in range(1, n + 1)], partitions)
    window = total_of(F.lit(1), *[after_cut(df, order, c).cast("int") for c in cuts])
    return (
        df.select(label, window.alias("window")).where(F.col("window") <= n)
        .groupBy("window").agg(F.count(F.lit(1)).alias("rows"), (F.avg(label) * 100).alias("rate_pct"))
    )
