"""Helpers shared by the corpus operators: learning folds, row iteration in bounded groups."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import ship_package

WHITE = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def with_row(df: DataFrame, **own: Column) -> DataFrame:
    """The whole row as one struct `row` beside the columns an operator works on.

    Names of further columns of the input can then never clash with working columns.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(k) for k, c in own.items()])


def row_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def grouped_texts(batches: Iterable[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the incoming batches with their `text` column as strings (null: empty).

    A slice holds about `most` bytes of text, or one row, so memory stays bounded whatever
    the number of rows in a batch.
    """
    for batch in batches:
        texts = batch.column("text")
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                yield batch.slice(start, i - start), _strings(texts.slice(start, i - start))
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start), _strings(texts.slice(start))


def _strings(texts: pa.Array) -> list[str]:
    return [t or "" for t in texts.to_pylist()]


_states: dict[str, dict] = {}


def worker_state(owner: str) -> dict:
    """What the operator `owner` keeps in a Python worker from task to task."""
    return _states.setdefault(owner, {})


def release_states(owner: str | None = None) -> None:
    """Give back what other operators than `owner` have kept: a worker outlives the stage it kept that for."""
    others = [held for name, held in _states.items() if name != owner and held]
    for held in others:
        held.clear()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def map_texts(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch, list[str]], pa.RecordBatch]], schema, owner: str | None = None) -> DataFrame:
    """Apply a function of (rows, texts) to slices of `df`; `make` runs once in each task.

    `owner` names the worker state that `make` uses; any other is released.
    """

    def run(batches):
        release_states(owner)
        step = make()
        for rows, texts in grouped_texts(batches):
            yield step(rows, texts)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
