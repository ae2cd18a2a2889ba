"""Global order without a single-task window.

Everything that looks un-partitioned (row positions, running sums over a whole
table, exact quantiles) is built on range partitions: sort inside each, then
shift by small per-partition totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType

from riskweave.functions.columns import col_of
from riskweave.functions.hashing import hash_order
from riskweave.session import materialize

_POSITION_BITS = (1 << 33) - 1


def _range_parted(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    cols = [col_of(c) for c in order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.withColumn("_part", F.spark_partition_id())


def _range_sorted(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    return _range_parted(df, order, partitions).sortWithinPartitions(*[col_of(c) for c in order])


def with_global_index(df: DataFrame, order: list, out: str = "idx", partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the order of `order`.

    `order` must end in a unique key: ties would be placed at random, and the key
    is also what lets one frequent value spread over many range partitions.
    """
    placed = materialize(
        _range_sorted(df, order, partitions).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS))
        ),
        "order",
    )
    # One row per range partition, so this window and the broadcast are bounded
    # by the number of shuffle partitions, whatever the table size.
    sizes = placed.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, (F.col("_start") + F.col("_pos")).cast("long"))
        .drop("_part", "_pos", "_start")
    )


def with_group_index(
    df: DataFrame, group: list[str], order: list, out: str = "idx", partitions: int | None = None
) -> DataFrame:
    """0-based position inside each group; a group may span many partitions."""
    indexed = with_global_index(df, [*group, *order], "_idx", partitions)
    # Written first: one row per group, joined by broadcast whenever that is small.
    starts = materialize(indexed.groupBy(*group).agg(F.min("_idx").alias("_first")), "groups")
    joined = indexed.alias("a").join(
        starts.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_first"),
        _null_safe(group, "_g_"),
    )
    return joined.withColumn(out, F.col("_idx") - F.col("_first")).drop(
        "_idx", "_first", *[f"_g_{g}" for g in group]
    )


def _null_safe(cols: list[str], prefix: str) -> Column:
    condition = F.lit(True)
    for c in cols:
        condition = condition & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return condition


def _merged(df: DataFrame, by: list[str], value: str, sums: dict[str, Column]) -> DataFrame:
    """Equal values become one row before the range shuffle, so heavy ties shrink the
    data instead of skewing it."""
    return df.groupBy(*by, value).agg(*[e.alias(n) for n, e in sums.items()])


def _running_in_part(placed: DataFrame, by: list[str], value: str, names: list[str]) -> DataFrame:
    """Exclusive running sums (`_<name>_local`) inside each range partition of a group."""
    running = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        *by, "_part", value, *names,
        *[F.coalesce(F.sum(n).over(running), F.lit(0)).alias(f"_{n}_local") for n in names],
    )


def _part_windows(by: list[str]):
    """Earlier parts, and all parts, of a group: at most one row per range partition."""
    parts = Window.partitionBy(*by).orderBy("_part")
    return parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def prefix_sums(
    df: DataFrame,
    by: list[str],
    value: str,
    sums: dict[str, Column],
    partitions: int | None = None,
) -> DataFrame:
    """Per distinct `value` inside each `by` group: the sums, the sums of all smaller
    values (`<name>_before`) and of the whole group (`<name>_total`)."""
    names = list(sums)
    placed = materialize(_range_parted(_merged(df, by, value, sums), [*by, value], partitions), "prefix")
    local = _running_in_part(placed, by, value, names)
    blocks = placed.groupBy(*by, "_part").agg(*[F.sum(n).alias(n) for n in names])
    earlier, whole = _part_windows(by)
    offsets = blocks.select(
        *[F.col(b).alias(f"_o_{b}") for b in by],
        F.col("_part").alias("_o__part"),
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_shift") for n in names],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in names],
    )
    # Groups + partitions rows: written first, so its true size decides the join.
    joined = local.join(materialize(offsets, "offsets"), _null_safe([*by, "_part"], "_o_"))
    return joined.select(
        *by, value, *names,
        *[(F.col(f"_{n}_local") + F.col(f"_{n}_shift")).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names],
    )


def ordered_pairs(
    df: DataFrame, by: list[str], value: str, sums: dict[str, Column], partitions: int | None = None, premerge: bool = True
) -> DataFrame:
    """Per group: `pairs`, the number of (pos, neg) pairs with the positive at the higher
    value plus half the tied pairs, and the totals `pos` and `neg`.

    `sums` gives `pos` and `neg`. The pair count is linear in the offsets of the range
    partitions, so it is summed per partition and shifted afterwards; unlike
    `prefix_sums` nothing is written and no row is joined. `premerge=False` saves the
    merging shuffle when equal values are known to be few.
    """
    rows = _merged(df, by, value, sums) if premerge else df.select(*by, value, *[F.col(n) for n in sums])
    placed = _range_parted(rows, [*by, value], partitions)
    ordered = Window.partitionBy(*by, "_part").orderBy(value)
    upto = F.sum("neg").over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    tied = F.sum("neg").over(ordered.rangeBetween(Window.currentRow, Window.currentRow)) if not premerge else F.col("neg")
    pos = F.col("pos").cast("double")
    inside = placed.withColumn("_half", upto - tied / 2)
    parts = inside.groupBy(*by, "_part").agg(
        F.sum(pos * F.col("_half")).alias("_inside"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    earlier, _ = _part_windows(by)
    shifted = parts.withColumn("_shift", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    return shifted.groupBy(*by).agg(
        F.sum(F.col("_inside") + pos * F.col("_shift")).alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )


def _to_plain(c: str, kind: DataType) -> Column:
    """Timestamps travel as text or microseconds, so no time zone of the driver gets in."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(c).alias(c)
    return F.col(c).cast("string").alias(c) if isinstance(kind, TimestampNTZType) else F.col(c)


def _from_plain(value, kind: DataType) -> Column:
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(value))
    return F.lit(value).cast(kind)


def order_cuts(df: DataFrame, order: list[str], ranks: list[int], partitions: int | None = None) -> list:
    """Order-key values of the rows at the given 1-based ranks (None for rank 0).

    Only the key columns are sorted and only the asked-for rows reach the driver; rows
    are then placed by comparing their own key with a cut, without moving the table.
    """
    keys = with_global_index(df.select(*order), order, "_idx", partitions).where(F.col("_idx").isin([k - 1 for k in ranks]))
    plain = keys.select("_idx", *[_to_plain(c, df.schema[c].dataType) for c in order])
    found = {r["_idx"] + 1: tuple(r[c] for c in order) for r in plain.collect()}
    return [found.get(k) for k in ranks]


def after_cut(df: DataFrame, order: list[str], cut: tuple | None) -> Column:
    """True for rows behind `cut` in the order of `order`."""
    if cut is None:
        return F.lit(True)
    fixed = F.struct(*[_from_plain(v, df.schema[c].dataType).alias(c) for c, v in zip(order, cut)])
    return F.struct(*order) > fixed


def exact_quantiles(
    df: DataFrame, by: list[str], value: str, quantiles: dict[str, float], partitions: int | None = None
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Counts per distinct value are ranked by prefix sums; no task holds a whole group.
    """
    ranked = prefix_sums(df.where(F.col(value).isNotNull()), by, value, {"n": F.count(F.lit(1))}, partitions)
    covers = lambda rank: (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
    picks, outs = [], []
    for name, q in quantiles.items():
        target = (F.col("n_total") - 1) * F.lit(float(q))
        low = F.floor(target)
        high = F.ceil(target)
        picks += [
            F.max(F.when(covers(low), F.col(value))).alias(f"_{name}_lo"),
            F.max(F.when(covers(high), F.col(value))).alias(f"_{name}_hi"),
            F.max(target - low).alias(f"_{name}_w"),
        ]
        lo, hi, w = F.col(f"_{name}_lo"), F.col(f"_{name}_hi"), F.col(f"_{name}_w")
        outs.append((lo + (hi - lo) * w).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *outs)


_PREFIX_DIGITS = 5


def hash_cuts(df: DataFrame, by: list[str], key: list[str], seed: int, ranks) -> DataFrame:
    """For each group the hash value found at given ranks of the hash order.

    `ranks` maps the group's row count column to an array column of 1-based ranks
    (0 means "before the first row"). Result: `by`, `n`, `cuts` (array of strings
    in rank order; '' for rank 0). Comparing a row's hash with a cut then selects
    an exact number of rows without sorting or shuffling the table: only hash-prefix
    counts and the rows of the few prefixes that hold a cut are moved.
    """
    hashed = df.select(*by, hash_order(*key, seed=seed).alias("_h")).withColumn(
        "_p", F.substring("_h", 1, _PREFIX_DIGITS)
    )
    group = by or ["_all"]
    if not by:
        hashed = hashed.withColumn("_all", F.lit(0))
    counts = hashed.groupBy(*group, "_p").agg(F.count(F.lit(1)).alias("_c"))
    # At most 16**5 prefixes per group, so these windows are bounded.
    earlier = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    located = counts.select(
        *group, "_p", "_c", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("n")
    )
    within = F.col("_rank") - F.col("_before")
    # Rank 0 stays with the first prefix and matches no row below.
    cut_at = materialize(
        located.select(*group, "n", "_p", "_c", "_before", F.posexplode(ranks(F.col("n"))).alias("_i", "_rank"))
        .where((within > 0) & (within <= F.col("_c")) | (F.col("_rank") <= 0) & (F.col("_before") == 0))
        .select(*group, "n", "_p", "_i", within.alias("_within")),
        "hashcuts",
    )
    inside = hashed.join(cut_at.where(F.col("_within") > 0).select(*group, "_p"), [*group, "_p"], "left_semi")
    order = Window.partitionBy(*group, "_p").orderBy("_h")
    found = inside.withColumn("_within", F.row_number().over(order))
    cuts = (
        cut_at.join(found, [*group, "_p", "_within"], "left")
        .groupBy(*group, "n")
        .agg(F.array_sort(F.collect_list(F.struct("_i", F.coalesce("_h", F.lit("")).alias("_h")))).alias("_pairs"))
        .select(*by, "n", F.transform("_pairs", lambda p: p["_h"]).alias("cuts"))
    )
    return materialize(cuts, "cuts")
