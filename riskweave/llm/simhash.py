"""Near-duplicates by SimHash, found with multi-index hashing.

A fingerprint is cut into equal segments. Two fingerprints within `distance` bits agree in
some segment up to `distance // segments` bits, so the small Hamming balls around each
segment value are enumerated, fetched from the table of that segment, and the complete
distance is verified. Only distinct fingerprints take part; copies share one.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import map_texts, row_columns, with_row
from riskweave.llm.exact import sieve, sifted
from riskweave.operators.graph import connected_components
from riskweave.session import materialize

BITS = 64


def simhash(text: str, width: int = 3, seed: int = 42, block: int = 100_000) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; no word: 0."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    n, ones = max(1, len(words) - width + 1), np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, block):
        part = words[at : at + block + width - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(width)])) if len(words) >= width else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, text: Column, *keep: str, width: int = 3) -> DataFrame:
    """The columns `keep` of `docs` and `fp`, the fingerprint as a signed 64-bit number."""
    kept = docs.select(*keep, text.alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")

    def make():
        def step(rows, texts):
            codes = pa.array([simhash(t, width) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], codes], names=[*keep, "fp"])

        return step

    return map_texts(kept, make, f"{schema}, fp long")


def links(codes: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs `a`, `b` of distinct fingerprints `fp` with at most `distance` differing bits.

    Each pair of segment values is probed from its smaller side only.
    """
    size = BITS // segments
    reach = range(distance // segments + 1)
    masks = F.array(*[F.lit(sum(1 << b for b in bits)).cast("long") for r in reach for bits in combinations(range(size), r)])
    # All bits above a segment are cut off; a segment is a non-negative number.
    values = [F.shiftrightunsigned("fp", i * size).bitwiseAND(F.lit((1 << size) - 1)) for i in range(segments)]

    def ball(i: int, value: Column) -> Column:
        near = F.filter(F.transform(masks, lambda m: value.bitwiseXOR(m)), lambda key: key >= value)
        return F.transform(near, lambda key: F.struct(F.lit(i).alias("segment"), key.alias("key"), (key == value).alias("same")))

    exact = F.array(*[F.struct(F.lit(i).alias("segment"), v.alias("key")) for i, v in enumerate(values)])
    index = codes.select(F.col("fp").alias("b"), F.explode(exact).alias("e")).select("b", "e.segment", "e.key")
    probes = codes.select(F.col("fp").alias("a"), F.explode(F.concat(*[ball(i, v) for i, v in enumerate(values)])).alias("e"))
    probes = probes.select("a", "e.segment", "e.key", "e.same")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # In the same bucket of equal values a pair is met from both sides; one is enough.
    found = probes.join(index, ["segment", "key"])
    return found.where((differ <= distance) & (differ > 0) & (~F.col("same") | (F.col("a") < F.col("b")))).select("a", "b")


def components(codes: DataFrame, distance: int = 3) -> DataFrame:
    """fp and `root`, the smallest fingerprint reachable over links."""
    edges = materialize(links(codes, distance), "simhash-links").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    linked = connected_components(edges).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    return codes.join(linked, "fp", "left").select(*[c for c in codes.columns], F.coalesce("root", "fp").alias("root"))


def _classes(coded: DataFrame, order: Column, distance: int) -> DataFrame:
    """fp and `first`, the least `order` value of the rows reachable from it; `coded` is a written table."""
    codes = materialize(coded.groupBy("fp").agg(F.min(order).alias("least")), "simhash-codes")
    rooted = components(codes, distance)
    best = rooted.groupBy("root").agg(F.min("least").alias("first"))
    return rooted.select("fp", "root").join(best, "root").select("fp", "first")


def near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (16 hex digits), component_id.

    Null text counts as empty; texts without words have fingerprint zero and link like any
    other. A null doc_id comes after all numbers, so a component of rows without ids has a
    null id. Repeated rows are returned as often as they come.
    """
    coded = materialize(fingerprints(docs.select("doc_id", "text"), F.col("text"), "doc_id", width=width), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"))
    found = _classes(coded, order, distance)
    return coded.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first.id").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, distance: int = 3, width: int = 3) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component the smallest doc_id stays.

    Of rows with the same doc_id in a component one stays. Columns are those of `docs`. Texts
    are not moved: a sieve of the uids that go tells nearly all other rows where they lie.
    """
    held = materialize(with_row(docs, uid=F.monotonically_increasing_id()), "simhash-rows")
    told = held.select("uid", F.col("row").getField("doc_id").alias("doc_id"), F.col("row").getField("text").alias("text"))
    coded = materialize(fingerprints(told, F.col("text"), "uid", "doc_id", width=width), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col("uid").alias("uid"))
    found = _classes(coded, order, distance)
    dropped = materialize(coded.join(found, "fp").where(F.col("uid") != F.col("first.uid")).select("uid"), "simhash-dropped")
    told = sifted(held, sieve(dropped.select(F.xxhash64("uid").alias("look"))), F.xxhash64("uid"))
    kept = told.where(~F.col("maybe")).select("row")
    return row_columns(kept.unionByName(told.where("maybe").join(dropped, "uid", "left_anti").select("row")), docs.columns)
