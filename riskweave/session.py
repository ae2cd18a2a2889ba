"""Session defaults and the shared folder that holds written intermediate tables."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_OWN_DIR = "riskweave.shared.dir"
_stages: list[str] = []
_shipped: set[str] = set()


def build_session(app: str = "riskweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Functions that run in Python workers are found there by name, so without it they only
    work where every machine has the package installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(tempfile.mkdtemp(prefix="riskweave-"), "riskweave")
    context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(home), os.path.basename(home)))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    own = tempfile.mkdtemp(prefix="riskweave-")
    spark.conf.set(_OWN_DIR, own)
    return own


def stage_path(spark: SparkSession, tag: str) -> str:
    """A new folder for a table that may go when the session is done with it."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _stages.append(path)
    return path


def write_stage(df: DataFrame, tag: str = "stage") -> tuple[DataFrame, str]:
    """Write `df` as Parquet in the shared folder; return the re-read table and its path.

    The written table cuts lineage, survives the loss of any executor, and gives
    the optimizer a true size, so joins against it are broadcast only when small.
    """
    spark = df.sparkSession
    path = stage_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def write_measured(df: DataFrame, tag: str, *metrics: Column) -> tuple[DataFrame, str, dict]:
    """Like `write_stage`, and also return aggregates of the rows, read from the written columns."""
    written, path = write_stage(df, tag)
    return written, path, written.agg(*metrics).first().asDict()


def materialize(df: DataFrame, tag: str = "stage") -> DataFrame:
    return write_stage(df, tag)[0]


def open_stages() -> list[str]:
    """Paths of the intermediate tables that have not been dropped."""
    return list(_stages)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Delete a superseded stage of an iterative job."""
    if path in _stages:
        _stages.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_stages(spark: SparkSession) -> None:
    """Delete every intermediate table of this session; call it once the results are saved."""
    while _stages:
        drop_stage(spark, _stages.pop())
