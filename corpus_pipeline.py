"""From raw documents to packed training sequences: one operator after another, each on all
the documents that the one before has kept."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import exact, langid, mixing, packing, simhash
from riskweave.llm.common import fold, table
from riskweave.session import drop_stage, materialize, open_stages

_left: list[str] = []


def stage(fn):
    """A stage whose documents have been written: what the stage before left behind can go."""

    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left:
            drop_stage(spark, _left.pop())
        before = set(open_stages())
        out = fn(spark, docs, sf_dir)
        _left.extend(p for p in open_stages() if p not in before)
        return out

    return run_stage


@stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without a letter or without a clear language go."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    held = docs.select(rest.alias("rest"), "text", "lang", (fold(F.col("doc_id"), 5) != 0).alias("learn"))
    told = langid.predict(held, langid.fit(held, F.col("learn")), "rest", "text").where(langid.accepted())
    return told.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


@stage
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact.drop_exact_duplicates(docs)


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the rates that bring the domains to their target weights."""
    return mixing.draw(docs, table(spark, sf_dir, "labels"))


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.digests(packing.pack(docs))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing", mix),
    ("packing", pack),
]

#: Near-duplicate components, learned models and token ids can't be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "corpus")
    return docs
