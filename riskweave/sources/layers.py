"""Bronze, silver and gold tables on a shared file system."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.session import shared_dir


def _root(spark: SparkSession) -> str:
    return spark.conf.get("riskweave.layers.dir", None) or f"{shared_dir(spark)}/layers"


def layer_path(spark: SparkSession, layer: str, name: str) -> str:
    return f"{_root(spark)}/{layer}/{name}"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, header: bool = True) -> DataFrame:
    """A declared schema reads the files once; without one Spark scans them first to infer it."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_layer(spark: SparkSession, layer: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(layer_path(spark, layer, name))


def write_layer(
    df: DataFrame, layer: str, name: str, mode: str = "overwrite", partition_by: list[str] | None = None, fmt: str = "parquet"
) -> str:
    """Write a layer table and return its path; overwriting also replaces the schema."""
    path = layer_path(df.sparkSession, layer, name)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def stamp_ingest(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {"_source": F.lit(source), "_ingested_at": F.current_timestamp(), "_ingestion_date": F.current_date()}
    )


def from_rows(spark: SparkSession, rows: list, schema: StructType | str) -> DataFrame:
    """Typed frame from a short list of literal rows."""
    return spark.createDataFrame(rows, schema)
