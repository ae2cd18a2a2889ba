"""Approximate k-nearest-neighbour join: multi-probe random projections, bounded buckets, exact ranking.

Each table cuts space by a few random directions at the median, so a row's bucket is the
bits of the sides it lies on. A query looks into its own bucket and those across the cuts
that it is closest to. Buckets beyond the bound are cut further by directions kept for
that, and what is still too full (rows that are all alike) is dealt by a hash, of which a
query meets one part. How many buckets a query looks into is fitted: a few queries, chosen
by a hash, meet every row, and the fewest probes count that find `aim` of their true
neighbours (all probes, where none does). So a query is compared with at most tables x probes x `bucket_rows`
rows (about; a dealt part may be a little larger), however the rows are spread.
Every row of the base is in every table, in packed blocks that hold whole buckets side by side;
blocks of queries meet them in a product (`packed`), so a query's vector is not sent with each
of its probes. Distances of the candidates are exact.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.operators.neighbors import _matrix, _top_k, _vectors
from riskweave.operators.packed import LEAST_ROWS, PART_BLOCKS, block_rows, blocks, matrix, nearest
from riskweave.session import materialize

#: Base rows whose medians place the cuts, in the order of a hash of their id.
SAMPLE = 20_000
#: Further directions for buckets that are too full.
FINER = 8
#: Queries that meet every row of the base, to see how many probes it takes.
TRIAL = 200
#: Numbers of probes to choose from; there are 42 sets of up to three of the six closest cuts.
PROBES = (4, 8, 16, 32, 42)
#: Where these find too little: up to four of the ten closest cuts, 386 sets.
MORE_PROBES = (64, 96, 128, 192, 256, 386)

#: Buckets that a block of queries looks into in a table, all probes together.
LOOKS = 1 << 23


def _flips(most: int = 6, sets: int = 3) -> list[tuple[int, ...]]:
    """Sets of up to `sets` of the closest cuts, the empty one first."""
    return [s for m in range(sets + 1) for s in combinations(range(most), m)]


def _sides(x: np.ndarray, cuts: list[tuple[np.ndarray, np.ndarray]], bits: int):
    """For each table: distances to all cuts, the bucket and the finer bits of each row."""
    for directions, middle in cuts:
        d = x @ directions - middle
        on = (d > 0).astype(np.int64)
        yield d, on[:, :bits] @ (1 << np.arange(bits, dtype=np.int64)), on[:, bits:] @ (1 << np.arange(FINER, dtype=np.int64))


def _place(cuts, bits: int, vectors: bool = True):
    """Each row's bucket in every table, with or without its vector."""

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for t, (_, code, fine) in enumerate(_sides(matrix(batch.column("vec")).astype(np.float64), cuts, bits)):
                rows = {"tab": np.full(len(code), t, np.int32), "code": code, "fine": fine}
                yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "vec": batch.column("vec"), **rows} if vectors else rows)

    return place


def _looked(d: np.ndarray, code: np.ndarray, bits: int, probes: int) -> list[np.ndarray]:
    """Buckets that queries look into, the likeliest first, from their distances to the cuts and their own buckets."""
    most, sets = (6, 3) if probes <= PROBES[-1] else (10, 4)
    flips = _flips(min(most, bits), sets)
    near = np.argsort(np.abs(d[:, :bits]), axis=1, kind="stable")[:, :most]
    gap = np.take_along_axis(d[:, :bits], near, axis=1) ** 2
    cost = np.column_stack([gap[:, list(s)].sum(axis=1) if s else np.zeros(len(d)) for s in flips])
    flip = np.column_stack([(1 << near[:, list(s)]).sum(axis=1) if s else np.zeros(len(d), np.int64) for s in flips])
    chosen = np.argsort(cost, axis=1, kind="stable")[:, :probes]
    return [code ^ flip[np.arange(len(d)), chosen[:, c]] for c in range(chosen.shape[1])]


class _Lookups:
    """For each table, the queries of a block that look into a bucket."""

    def __init__(self, cuts, bits: int, probes: int):
        self.cuts, self.bits, self.probes, self.queries, self.made = cuts, bits, probes, None, {}

    def _table(self, t: int):
        """Buckets looked into, sorted, the queries that do, and the finer bits of the queries; one table is kept."""
        if t not in self.made:
            ((d, code, fine),) = _sides(self.queries.x.astype(np.float64), self.cuts[t : t + 1], self.bits)
            kind, slices = np.uint16 if self.bits <= 16 else np.int64, [slice(i, i + 4_096) for i in range(0, len(code), 4_096)]
            looked = np.concatenate([np.column_stack(_looked(d[i], code[i], self.bits, self.probes)).astype(kind) for i in slices]).ravel()
            order = np.argsort(looked, kind="stable")
            self.made = {t: (looked[order], (order // (len(looked) // len(code))).astype(np.int32), fine)}
        return self.made[t]

    def __call__(self, queries, base):
        """Queries meet the rows of the buckets that they look into: of a full one their own part."""
        if queries is not self.queries:
            self.queries, self.made, self.dealt = queries, {}, queries.numbers("deal")
        keys = np.column_stack([base.numbers(c) for c in ("tab", "code", "more", "sub", "parts", "part")])
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        for s, e in zip(starts, [*starts[1:], len(keys)]):
            t, code, more, sub, parts, part = map(int, keys[s])
            looked, asked, fine = self._table(t)
            first, last = np.searchsorted(looked, np.array([code, code + 1], np.int64).clip(0, np.iinfo(looked.dtype).max).astype(looked.dtype))
            if code == np.iinfo(looked.dtype).max:
                last = len(looked)
            at = asked[first:last]
            if more:
                at = at[fine[at] >> (FINER - more) == sub]
            if parts > 1:
                at = at[self.dealt[at] % parts == part]
            if len(at):
                yield at, s, e


def _probes_for(q: DataFrame, b: DataFrame, counts: DataFrame, cuts, bits: int, k: int, exclude_self: bool, bucket_rows: int, aim: float, seed: int) -> int:
    """The fewest probes whose buckets hold `aim` of the true neighbours of the trial queries."""
    trial = q.orderBy(hash_order("query_id", seed=seed), "query_id").limit(TRIAL).toPandas()
    if not len(trial):
        return PROBES[0]
    asked, ids = _matrix(trial["vec"]), trial["query_id"].to_numpy()

    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                pdf = pdf.sort_values("id", ignore_index=True)
                best = _top_k(ids, asked, pdf["id"].to_numpy(), _matrix(pdf["vec"]), k, exclude_self)
                yield best.drop(columns="rank").merge(pdf.rename(columns={"id": "neighbor_id"}), on="neighbor_id")

    best = b.mapInPandas(nearest, "query_id long, neighbor_id long, distance double, vec array<double>")
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "vec").toPandas()
    if not len(best):
        return PROBES[0]
    # A full bucket is cut further, and a query meets its own part of it.
    full = {(r.tab, r.code): r.rows for r in counts.groupBy("tab", "code").agg(F.sum("rows").alias("rows")).where(F.col("rows") > bucket_rows).collect()}
    at = trial.reset_index().set_index("query_id")["index"].loc[best["query_id"]].to_numpy()

    def first_found(most: int) -> np.ndarray:
        """For each neighbour, how many of the `most` likeliest buckets come before the one that holds it."""
        first = np.full(len(best), most + 1)
        for t, ((d, own, fine), (_, code, part)) in enumerate(zip(_sides(asked, cuts, bits), _sides(_matrix(best["vec"]), cuts, bits))):
            more = np.array([min(FINER, math.ceil(math.log2(full[t, c] / bucket_rows))) if (t, c) in full else 0 for c in code], dtype=np.int64)
            same = fine[at] >> (FINER - more) == part >> (FINER - more)
            for place, bucket in enumerate(_looked(d, own, bits, most)):
                first = np.where(same & (bucket[at] == code), np.minimum(first, place), first)
        return first

    for choice in (PROBES, MORE_PROBES):
        first = first_found(choice[-1])
        for probes in choice:
            if (first < probes).mean() >= aim:
                return probes
    return MORE_PROBES[-1]


def approx_knn_join(
    query: DataFrame, base: DataFrame, vec: str, k: int, query_id: str, base_id: str, exclude_self: bool = False,
    tables: int = 8, probes: int | None = None, bucket_rows: int = 256, seed: int = 42, aim: float = 0.95,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) of the k nearest base rows that each query row meets.

    Ids are longs and name the base rows uniquely; ties in distance go to the smaller id. An
    empty base gives no rows. Without `probes` their number is fitted to `aim`.
    """
    b, q = _vectors(base, base_id, vec, "id"), _vectors(query, query_id, vec, "query_id")
    n = b.count()
    if not n:
        return q.select("query_id", F.lit(None).cast("long").alias("neighbor_id"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank")).where("false")
    sample = _matrix(b.orderBy(hash_order("id", seed=seed), "id").limit(SAMPLE).select("vec").toPandas()["vec"])
    bits = max(0, math.ceil(math.log2(n / bucket_rows)))
    rng, cuts = np.random.default_rng(seed), []
    for _ in range(tables):
        directions = rng.normal(size=(sample.shape[1], bits + FINER))
        cuts.append((directions, np.median(sample @ directions, axis=0)))

    keys = ["tab", "code"]
    counts = b.mapInArrow(_place(cuts, bits, vectors=False), "tab int, code long, fine long").groupBy(*keys, "fine").agg(F.count(F.lit(1)).alias("rows"))
    counts = materialize(counts, "counts")
    probes = probes or _probes_for(q, b, counts, cuts, bits, k, exclude_self, bucket_rows, aim, seed)
    # Buckets beyond the bound: at most tables x rows / bucket_rows of them, joined as Spark sees fit.
    full = counts.groupBy(*keys).agg(F.sum("rows").alias("rows")).where(F.col("rows") > bucket_rows)
    full = materialize(full.select(*keys, F.least(F.lit(FINER), F.ceil(F.log2(F.col("rows") / bucket_rows))).cast("int").alias("more")), "full")
    cut = lambda d: d.join(full, keys, "left").withColumn("more", F.coalesce("more", F.lit(0))).withColumn("sub", F.expr(f"shiftright(fine, {FINER} - more)")).drop("fine")
    alike = cut(counts).groupBy(*keys, "sub").agg(F.sum("rows").alias("rows")).where(F.col("rows") > bucket_rows)
    alike = materialize(alike.select(*keys, "sub", F.ceil(F.col("rows") / bucket_rows).cast("int").alias("parts")), "alike")
    placed = cut(b.mapInArrow(_place(cuts, bits), f"id long, vec {b.schema['vec'].dataType.simpleString()}, tab int, code long, fine long"))
    placed = placed.join(alike, [*keys, "sub"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    deal = lambda key: F.xxhash64(key, F.lit(seed))
    placed = placed.withColumn("part", F.pmod(deal("id"), F.col("parts")))
    # Rows of a bucket lie together, and most tasks hold rows of one table. Blocks of queries share the rows that a task has packed.
    rows = block_rows(b)
    queries = q.count()
    some = min(rows, max(LEAST_ROWS, LOOKS // probes), max(LEAST_ROWS, -(-queries // 16)))
    left = blocks(q.withColumn("deal", deal("query_id")).repartition(max(1, -(-queries // (4 * some))), "query_id"), ["query_id", "deal"], some, "q_")
    places = ["tab", "code", "sub", "part"]
    placed = placed.repartitionByRange(max(tables, -(-tables * n // (PART_BLOCKS * rows))), *places).sortWithinPartitions(*places)
    numbers = ["id", "tab", "code", "more", "sub", "parts", "part"]
    found = nearest(left, blocks(placed, numbers, rows, "b_"), k, exclude_self, _Lookups(cuts, bits, probes), distinct=True)
    # By query alone: equal pairs of several tables and the ranks need one shuffle.
    found = found.repartition("query_id").distinct()
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame, by: str = "query_id") -> DataFrame:
    """queries, neighbors, found, recall: how much of an exact result an approximate one holds."""
    both = exact.select(by, "neighbor_id").join(found.select(by, "neighbor_id", F.lit(1).alias("hit")), [by, "neighbor_id"], "left")
    return both.agg(
        F.count_distinct(by).alias("queries"), F.count(F.lit(1)).alias("neighbors"), F.count("hit").alias("found"),
        (F.count("hit") / F.count(F.lit(1))).alias("recall"),
    )
