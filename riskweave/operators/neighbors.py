"""Exact k-nearest-neighbour join with Euclidean distance.

Base rows are grouped around pivots (Lu et al., 2012) and, inside a pivot's cell, cut
into rings of bounded size by their distance to it. The distances kept per pivot give
each query an upper bound on its k-th neighbour; by the triangle inequality most cells
and rings cannot beat it and are skipped. Each remaining block pair returns k rows per
query. In few dimensions, or where rows form clusters, that skips most of the base; in many
dimensions without clusters hardly any cell can be ruled out, and an exact search has to
compare nearly all pairs: then blocks of packed vectors meet in a product of the two sides
(`packed`), for which each row is shuffled once. `exact=False` bounds the work there.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.operators import packed
from riskweave.operators.ordered import with_group_index
from riskweave.session import drop_stage, materialize, write_stage

_SLACK = 1e-9
#: Rows of a block where all pairs are compared, and queries that tell whether cells can be ruled out.
GRID_ROWS, TRIAL_QUERIES = 8_192, 64


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64)


def _distances(q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Plain differences, in slices of bounded memory; exact for identical rows."""
    out = np.empty((len(q), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for i in range(0, len(q), step):
        d = q[i : i + step, None, :] - b[None, :, :]
        out[i : i + step] = np.sqrt(np.einsum("ijk,ijk->ij", d, d))
    return out


def _nearest_cell(pivots: np.ndarray):
    def assign(batches):
        for pdf in batches:
            if len(pdf):
                d = _distances(_matrix(pdf["vec"]), pivots)
                cell = d.argmin(axis=1)
                yield pdf.assign(cell=cell.astype("int32"), to_pivot=d[np.arange(len(d)), cell])

    return assign


def _route(pivots: np.ndarray, cells: list[tuple[int, float, float]], near: np.ndarray, k: int):
    """Send each query to the cells that may hold one of its k nearest rows, with the
    range of distances to the pivot (`low`..`high`) such rows can have."""
    step = max(1, 4_000_000 // (near.size + pivots.size))

    def route(batches):
        for batch in batches:
            for i in range(0, len(batch), step):
                pdf = batch.iloc[i : i + step]
                d = _distances(_matrix(pdf["vec"]), pivots)
                # near[c, j] is the distance from pivot c to its j-th closest base row, so
                # going through a pivot gives an upper bound on the k-th neighbour.
                bound = np.partition((d[:, :, None] + near[None, :, :]).reshape(len(d), -1), k - 1, axis=1)[:, k - 1]
                bound = bound * (1 + _SLACK) + _SLACK
                for cell, inner, outer in cells:
                    low, high = d[:, cell] - bound, d[:, cell] + bound
                    rows = np.flatnonzero((outer >= low) & (inner <= high))
                    if len(rows):
                        yield pdf.iloc[rows].assign(cell=np.int32(cell), low=low[rows], high=high[rows])

    return route


def _top_k(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, b: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k nearest of `ids` (ascending) for each query; equal distances keep id order.

    A matrix product bounds each squared distance from below and above; plain differences are
    taken for the rows alone whose lower bound does not exceed the k-th upper one.
    """
    keep, error = min(k, len(ids)), (4 * q.shape[1] + 16) * np.finfo(np.float64).eps
    own, square = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", b, b)
    step, found = max(1, 4_000_000 // max(1, len(b))), []
    for i in range(0, len(q), step):
        norms = own[i : i + step, None] + square
        twice = 2.0 * (q[i : i + step] @ b.T)
        low, high = (1 - error) * norms - twice, (1 + error) * norms - twice
        out = ~np.isfinite(high)
        if exclude_self:
            out |= q_ids[i : i + step, None] == ids
        high[out] = np.inf
        at, near = np.nonzero((low <= np.partition(high, keep - 1, axis=1)[:, keep - 1 :keep]) & ~out)
        d, cut = np.empty(len(at)), max(1, 4_000_000 // max(1, b.shape[1]))
        for j in range(0, len(at), cut):
            gap = q[i + at[j : j + cut]] - b[near[j : j + cut]]
            d[j : j + cut] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        order = np.lexsort((near, d, at))
        at, near, d = at[order], near[order], d[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at) + 1
        first = (rank <= keep) & np.isfinite(d)
        found.append((q_ids[i + at[first]], ids[near[first]], d[first], rank[first].astype(np.int32)))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [[]] * 4
    return pd.DataFrame(dict(zip(("query_id", "neighbor_id", "distance", "rank"), columns)))


def _block_top_k(k: int, exclude_self: bool):
    def best(_, queries: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(base):
            return pd.DataFrame({"query_id": [], "neighbor_id": [], "distance": []})
        base = base.sort_values("id")
        found = _top_k(queries["query_id"].to_numpy(), _matrix(queries["vec"]), base["id"].to_numpy(), _matrix(base["vec"]), k, exclude_self)
        return found[["query_id", "neighbor_id", "distance"]]

    return best


def _grid(q: DataFrame, b: DataFrame, queries: int, n: int, k: int, exclude_self: bool, grid_rows: int) -> DataFrame:
    """(query_id, neighbor_id, distance): the k nearest of each part of the base rows, for all queries."""
    rows = 4 * grid_rows if n <= grid_rows else min(packed.block_rows(b), 4 * grid_rows)
    # Few queries are cut finer, so that there is work for all tasks.
    some = min(rows, max(packed.LEAST_ROWS, -(-queries // 16)))
    left = packed.blocks(q.repartition(max(1, -(-queries // some)), "query_id"), ["query_id"], some, "q_")
    right = packed.blocks(b.repartition(-(-n // (packed.PART_BLOCKS * rows)), "id"), ["id"], rows, "b_")
    return packed.nearest(left, right, k, exclude_self, _all_rows)


def _all_rows(queries, base):
    """Every query meets all rows of the base."""
    for i in range(0, len(queries), packed.TILE_QUERIES):
        at = np.arange(i, min(i + packed.TILE_QUERIES, len(queries)))
        for j in range(0, len(base), packed.TILE_ROWS):
            yield at, j, min(j + packed.TILE_ROWS, len(base))


def _vectors(df: DataFrame, key: str, vec: str, name: str) -> DataFrame:
    """Ids as longs and vectors as they are: floats stay floats, anything else becomes doubles."""
    out = df.select(F.col(key).cast("long").alias(name), F.col(vec).alias("vec"))
    single = out.schema["vec"].dataType.simpleString() == "array<float>"
    return out.withColumn("vec", F.col("vec").cast(f"array<{'float' if single else 'double'}>"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def knn_join(
    query: DataFrame,
    base: DataFrame,
    vec: str,
    k: int,
    query_id: str,
    base_id: str,
    exclude_self: bool = False,
    pivots: int | None = None,
    block_rows: int = 2_000,
    exact: bool = True,
    grid_rows: int = GRID_ROWS,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) of the k nearest base rows of every query row.

    Ids are longs; ties in distance go to the smaller id. Given `pivots`, cells are used also where
    they rule nothing out; a trial chooses between them and the grid, never what is found. With `exact=False` a query meets a
    bounded number of rows (`approx.approx_knn_join`) and may miss a neighbour.
    """
    if not exact:
        from riskweave.operators.approx import approx_knn_join

        return approx_knn_join(query, base, vec, k, query_id, base_id, exclude_self)
    need = k + (1 if exclude_self else 0)
    plain_b, plain_q = _vectors(base, base_id, vec, "id"), _vectors(query, query_id, vec, "query_id")
    b, q = (d.withColumn("vec", F.col("vec").cast("array<double>")) for d in (plain_b, plain_q))

    n = b.count()
    if not n:
        return q.select("query_id", F.lit(None).cast("long").alias("neighbor_id"), F.lit(0.0).alias("distance"), F.lit(0).alias("rank")).where("false")
    queries = q.count()
    if not pivots and n * queries <= grid_rows * grid_rows:
        return _ranked(_grid(plain_q, plain_b, queries, n, k, exclude_self, grid_rows), k)
    # The pivots, a quarter of the root of the rows and chosen by hash, are all of the base that reaches the driver.
    chosen = pivots or max(16, math.isqrt(n) // 4)
    seeds = b.orderBy(hash_order("id"), "id").limit(chosen).select("vec").collect()
    centers = np.unique(np.array([r["vec"] for r in seeds], dtype=np.float64), axis=0)

    placed, path = write_stage(b.mapInPandas(_nearest_cell(centers), "id long, vec array<double>, cell int, to_pivot double"), "cells")
    stats = placed.groupBy("cell").agg(F.min("to_pivot").alias("a"), F.max("to_pivot").alias("z")).collect()
    closest = (
        placed.withColumn("r", F.row_number().over(Window.partitionBy("cell").orderBy("to_pivot", "id")))
        .where(F.col("r") <= need).select("cell", "r", "to_pivot").collect()
    )
    near = np.full((len(centers), need), np.inf)
    for row in closest:
        near[row["cell"], row["r"] - 1] = row["to_pivot"]
    cells = [(r["cell"], r["a"], r["z"]) for r in stats]
    trial = pd.DataFrame({"vec": [r["vec"] for r in q.select("vec").limit(0 if pivots else TRIAL_QUERIES).collect()]})
    met = sum(map(len, _route(centers, cells, near, need)([trial])))
    if 2 * met > len(trial) * len(cells):
        drop_stage(q.sparkSession, path)
        return _ranked(_grid(plain_q, plain_b, queries, n, k, exclude_self, grid_rows), k)

    # Rings hold `block_rows` rows each, also where a cell is full of identical rows.
    ringed = with_group_index(placed, ["cell"], ["to_pivot", "id"], "_pos")
    blocked = materialize(ringed.withColumn("block", F.floor(F.col("_pos") / block_rows).cast("int")).drop("_pos"), "rings")
    rings = materialize(blocked.groupBy("cell", "block").agg(F.min("to_pivot").alias("a"), F.max("to_pivot").alias("z")), "bounds")
    wanted = q.mapInPandas(_route(centers, cells, near, need), "query_id long, vec array<double>, cell int, low double, high double")
    meets = (wanted.cell == rings.cell) & (rings.z >= wanted.low) & (rings.a <= wanted.high)
    routed = materialize(wanted.join(rings, meets).select("query_id", "vec", rings.cell, "block"), "routed")
    blocked = blocked.drop("to_pivot")
    # A block wanted by many queries is met by several query groups of bounded size.
    groups = routed.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("groups"))
    groups = materialize(groups, "groups")
    keys = ["cell", "block", "part"]
    left = routed.join(groups, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int")).drop("groups")
    right = blocked.join(groups, ["cell", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _block_top_k(k, exclude_self), "query_id long, neighbor_id long, distance double"
    )
    return _ranked(found, k)
