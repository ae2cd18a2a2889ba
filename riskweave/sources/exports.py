"""Files for dashboards and stream replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.sampling import batch_ids, sample_n
from riskweave.session import stage_path


def export_table(df: DataFrame, path: str, formats: tuple = ("csv", "parquet"), single_file: bool = False) -> dict[str, str]:
    """Write a mart as CSV and Parquet; `single_file` only suits marts known to be small."""
    paths = {}
    out = df.coalesce(1) if single_file else df
    for fmt in formats:
        paths[fmt] = f"{path}/{fmt}"
        writer = out.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        writer.format(fmt).save(paths[fmt])
    return paths


def summary_json(df: DataFrame, sections: dict[str, Column]) -> DataFrame:
    """One-row frame with a nested JSON text built from the columns of a one-row frame."""
    return df.select(F.to_json(F.struct(*[c.alias(n) for n, c in sections.items()])).alias("summary"))


def export_summary_json(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").text(path)
    return path


def sample_export(df: DataFrame, n: int, key, path: str, seed: int = 42) -> dict[str, str]:
    return export_table(sample_n(df, n, key, seed), path)


def split_to_batches(df: DataFrame, n: int, size: int, key, path: str | None = None, seed: int = 42, file_rows: int = 1_000_000) -> str:
    """Shuffle, cut into `n` batches of `size` rows and write one folder per batch for replay.

    Rows behind the last full batch are left out, as the sizes say. A batch is written in
    files of about `file_rows` rows, so no task holds a large batch.
    """
    path = path or stage_path(df.sparkSession, "replay")
    numbered = batch_ids(df, n, size, key, seed)
    parts = F.pmod(F.xxhash64("batch_id", *numbered.columns), F.lit(max(1, -(-size // file_rows))))
    numbered.repartition(F.col("batch_id"), parts).write.mode("overwrite").partitionBy("batch_id").parquet(path)
    return path
