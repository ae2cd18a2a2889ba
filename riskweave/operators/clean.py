"""Silver-layer cleaning: types, names, nulls, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, NumericType, StringType

from riskweave.functions.columns import col_of
from riskweave.session import materialize


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast to the target types; text that does not fit becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return cast_columns(df, {c: "double" for c in cols})


def rename_std(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def label_flag(df: DataFrame, label: str, out: str = "_is_fraud") -> DataFrame:
    return df.withColumn(out, F.col(label) == 1)


def fill_prefix(df: DataFrame, prefix: str, value: float = 0.0) -> DataFrame:
    """Fill nulls of every column whose name starts with `prefix`, in one projection."""
    return df.select(
        *[F.coalesce(F.col(c), F.lit(value)).alias(c) if c.startswith(prefix) else F.col(c) for c in df.columns]
    )


def fill_by_type(df: DataFrame, string: str = "UNKNOWN", number: float = 0, skip: tuple = ()) -> DataFrame:
    fills = {}
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, StringType):
            fills[field.name] = string
        elif isinstance(field.dataType, NumericType):
            fills[field.name] = number
    return df.na.fill(fills) if fills else df


def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.na.drop(subset=cols)


def dedupe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Distinct rows, over all columns or over `cols`."""
    return df.dropDuplicates(cols)


def dedupe_with_report(df: DataFrame, cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct rows and a one-row report (rows_before, rows_after, removed).

    The rows are written once; both counts then come from file footers instead of a
    second shuffle of the whole table.
    """
    kept = materialize(dedupe(df, cols), "silver")
    before, after = df.count(), kept.count()
    report = df.sparkSession.range(1).select(
        F.lit(before).alias("rows_before"), F.lit(after).alias("rows_after"), F.lit(before - after).alias("removed")
    )
    return kept, report


def align(df: DataFrame, features: list[str], fill: float = 0) -> DataFrame:
    """Exactly `features`, in order; columns the frame lacks become the constant as double."""
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(fill).cast("double").alias(c) for c in features]
    )


def pick_or_default(df: DataFrame, cols: list[str], default) -> DataFrame:
    return df.select(*[F.col(c) if c in df.columns else F.lit(default).alias(c) for c in cols])


def union_master(frames: list[DataFrame], features: list[str]) -> DataFrame:
    """UNION ALL of frames aligned to one feature list."""
    first, *rest = [align(f, features) for f in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def row_id(df: DataFrame, key: list[str | Column], out: str = "row_id") -> DataFrame:
    """Stable 128-bit id (32 hex digits) from the natural key, the same on every run, plan and partitioning.

    Each value goes in with its length, and a null as such, so different keys give different
    texts; two of 10^12 keys share an id with a probability of about 10^-15. Rows with equal
    keys share theirs.
    """
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return df.withColumn(out, F.md5(F.concat_ws("|", *[part(col_of(k)) for k in key])))


def number_repeats(df: DataFrame, key: str, out: str = "nth") -> DataFrame:
    """Number the rows of each value of `key` from 0; which of them gets which number is left open.

    Rows are counted by value and partition first, so one value may hold any share of the
    table: a window sees the rows of one partition, or one count for each partition.
    """
    parted = materialize(df.withColumn("_part", F.spark_partition_id()), "repeats")
    local = parted.withColumn("_at", F.row_number().over(Window.partitionBy(key, "_part").orderBy(key)) - 1)
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parted.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        key, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return local.join(starts, [key, "_part"]).withColumn(out, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def number_equal_rows(df: DataFrame, out: str = "nth", block_rows: int = 1 << 16) -> DataFrame:
    """Number the rows that are equal in all columns from 0.

    Equal rows travel as one row with their count, and are made again behind the shuffle; more
    than `block_rows` of them in blocks, by as many tasks as they need.
    """
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FractionalType) and not isinstance(f.dataType, DecimalType)]
    # Grouping takes -0.0 for 0.0, so its sign is kept beside it.
    minus = [F.coalesce((F.col(c) == 0) & F.col(c).cast("string").startswith("-"), F.lit(False)) for c in floats]
    counted = df.withColumn("_minus", F.array(*minus)).groupBy(*df.columns, "_minus").agg(F.count(F.lit(1)).alias("_rows"))
    counted = materialize(counted, "repeats").withColumns({c: F.when(F.col("_minus")[i], F.lit(-0.0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for i, c in enumerate(floats)})
    few = counted.where(F.col("_rows") <= block_rows).withColumn(out, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1)))
    starts = F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, F.lit(block_rows).cast("long"))
    many = counted.where(F.col("_rows") > block_rows).withColumn("_start", F.explode(starts)).repartition(*df.columns, "_start")
    ends = F.least(F.col("_start") + block_rows, F.col("_rows")) - 1
    many = many.withColumn(out, F.explode(F.sequence(F.col("_start"), ends)))
    return few.select(*df.columns, out).unionByName(many.select(*df.columns, out))


def drop_meta(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)
