"""Approximate neighbours against the exact join, and the weight search against plain counting."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.ml import stacking
from riskweave.operators import approx, neighbors, prep


def table(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, vec array<double>").repartition(3)


def test_recall_and_bounded_candidates(spark):
    """Clusters, a third of all rows alike, and many queries on one bucket."""
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(500, 12)) * 0.3 + rng.integers(0, 6, (500, 1)), np.full((250, 12), 2.5)])
    df = table(spark, x)
    found = approx.approx_knn_join(df, df, "vec", 4, "id", "id", exclude_self=True, bucket_rows=80)
    got = found.toPandas()
    for q, n, d in got[["query_id", "neighbor_id", "distance"]].to_numpy()[:200]:
        assert q != n and d == pytest.approx(np.linalg.norm(x[int(q)] - x[int(n)]))
    assert not got.duplicated(["query_id", "neighbor_id"]).any() and (got.groupby("query_id")["rank"].max() <= 4).all()
    exact = neighbors.knn_join(df, df, "vec", 4, "id", "id", exclude_self=True).where("query_id < 500")
    seen = approx.recall(found, exact).first()
    assert seen.queries == 500 and seen.recall >= 0.9
    # All of the rows that are alike find rows at distance 0, though they overfill every bucket.
    assert (got[got["query_id"] >= 500].groupby("query_id")["distance"].max() == 0).all()


def test_small_and_empty_bases(spark):
    df = table(spark, np.eye(3))
    got = neighbors.knn_join(df, df, "vec", 5, "id", "id", exact=False).toPandas()
    assert len(got) == 9 and (got[got["rank"] == 1]["distance"] == 0).all()
    assert neighbors.knn_join(df, df.limit(0), "vec", 2, "id", "id", exact=False).count() == 0
    assert neighbors.knn_join(df.limit(0), df, "vec", 2, "id", "id", exact=False).count() == 0


def test_oversampling_with_approximate_neighbours(spark):
    rows = [(i, int(i < 6), float(i), float(i % 3)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    exact, near = (prep.smote(df, "y", ["a", "b"], "id", 0.5, exact=e).orderBy("id", "_copy").collect() for e in (True, False))
    assert exact == near and len(near) == 40 + 11


@pytest.mark.parametrize("steps, ordered_rows", [(1024, 1_000_000), (3, 20), (1, 5)])
def test_weight_search(spark, steps, ordered_rows):
    """Equal AUCs whatever the steps: ties, nulls, negative scores and weights, constant scores."""
    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), int(y)) for a, b, y in zip(np.round(rng.normal(size=150), 1), rng.integers(0, 4, 150), rng.integers(0, 2, 150))]
    df = spark.createDataFrame([*rows, (None, 1.0, 1), (1.0, float("nan"), 0)], "s double, t double, y int").repartition(4)
    candidates = [(0.5, 0.5), (1.0, 0.0), (0.0, 0.0), (-0.3, 1.3)]
    got = {r.weight_id: r.auc_roc for r in stacking.weight_grid(df, ["s", "t"], "y", candidates, steps, ordered_rows).collect()}
    for i, (u, v) in enumerate(candidates):
        pos, neg = ([0.0 + u * a + v * b for a, b, y in rows if y == k] for k in (1, 0))
        assert got[i] == pytest.approx(np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg]), abs=1e-12)
    assert all(r.auc_roc is None for r in stacking.weight_grid(df.where("y = 1"), ["s", "t"], "y", candidates).collect())
    assert stacking.weight_grid(df.limit(0), ["s", "t"], "y", candidates).where(F.col("auc_roc").isNotNull()).count() == 0


def test_cells_of_the_weight_search_travel_packed(spark):
    """About two bytes a row and weight vector, and equal AUCs where cells are coarse and blocks small."""
    rng = np.random.default_rng(7)
    cells, told = np.sort(rng.integers(1 << 43, 1 << 44, 50_000)), rng.random(50_000) < 0.3
    got = stacking._unpacked(pa.py_buffer(stacking._packed(cells, told)))
    assert (got[0] == cells).all() and (got[1] == told).all()
    rows = [(float(a), float(b), int(y)) for a, b, y in zip(np.round(rng.normal(size=500), 2), rng.random(500), rng.integers(0, 2, 500))]
    df, weights = spark.createDataFrame(rows, "s double, t double, y int").repartition(3), [(0.5, 0.5), (1.0, 0.0)]
    grids = [stacking.weight_grid(df, ["s", "t"], "y", weights, steps, 60, block, cells).orderBy("weight_id").collect() for steps, block, cells in ((1024, 1 << 17, 256), (4, 30, 1), (7, 1, 2))]
    assert grids[0] == grids[1] == grids[2]
    cells = np.sort(rng.integers(0, 256 * 50_000, 50_000))
    assert len(stacking._packed(cells, told)) < 3 * len(cells)


def test_probes_are_fitted_to_the_recall(spark):
    """Vectors without clusters need more probes than clustered ones."""
    df = table(spark, np.random.default_rng(5).normal(size=(1200, 20)))
    found = approx.approx_knn_join(df, df, "vec", 4, "id", "id", exclude_self=True, bucket_rows=40)
    seen = approx.recall(found, neighbors.knn_join(df, df, "vec", 4, "id", "id", exclude_self=True)).first()
    assert seen.queries == 1200 and seen.recall >= 0.9


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_nearest_rows_by_matrix_product(monkeypatch, shift):
    """The k nearest rows are exact though not all differences are taken: copies, ties, far origins, nulls as nan."""
    rng = np.random.default_rng(6)
    b = np.concatenate([rng.normal(size=(300, 8)), np.full((20, 8), 0.5), rng.integers(0, 2, (200, 8))]) + shift
    b[7, 3], ids = np.nan, np.arange(520) * 3
    d = neighbors._distances(b, b)
    d[np.arange(520), np.arange(520)] = np.inf
    monkeypatch.setattr(neighbors, "_distances", None)
    got = neighbors._top_k(ids, b, ids, b, 6, True)
    order = np.argsort(d, axis=1, kind="stable")[:, :6]
    want = [(ids[i], ids[j], r + 1) for i in range(520) for r, j in enumerate(order[i]) if np.isfinite(d[i, j])]
    assert list(got[["query_id", "neighbor_id", "rank"]].itertuples(index=False, name=None)) == want
    assert got["distance"].to_numpy() == pytest.approx([d[i // 3, j // 3] for i, j, _ in want])


def test_vectors_are_not_written_with_probes(spark, monkeypatch):
    """No written table holds vectors, and the plans send each row once, however many buckets or blocks it meets."""
    df = table(spark, np.random.default_rng(8).normal(size=(900, 16)))
    written = []
    for place in (approx, neighbors):
        monkeypatch.setattr(place, "materialize", lambda d, tag, write=place.materialize: written.append((tag, d.columns)) or write(d, tag))
    near = approx.approx_knn_join(df, df, "vec", 3, "id", "id", exclude_self=True, bucket_rows=40)
    exact = neighbors.knn_join(df, df, "vec", 3, "id", "id", exclude_self=True, grid_rows=64)
    assert written and not any("vec" in columns for _, columns in written)
    for found in (near, exact):
        assert "CartesianProduct" in found._jdf.queryExecution().executedPlan().toString()
    assert approx.recall(near, exact).first().recall >= 0.9


def test_more_probes_where_buckets_are_many(spark):
    """All sets of the six closest cuts find too little here."""
    df = table(spark, np.random.default_rng(9).normal(size=(1500, 24)))
    found = approx.approx_knn_join(df, df, "vec", 4, "id", "id", exclude_self=True, tables=3, bucket_rows=8)
    seen = approx.recall(found, neighbors.knn_join(df, df, "vec", 4, "id", "id", exclude_self=True)).first()
    assert seen.queries == 1500 and seen.recall >= 0.9


@pytest.mark.parametrize("kind", ["float", "double"])
def test_packed_blocks_find_the_nearest(spark, kind):
    """Blocks of a few rows against plain numpy: ties by id, repeated and null ids, far origins, nan."""
    rng = np.random.default_rng(10)
    x = np.concatenate([rng.normal(size=(120, 6)), rng.integers(0, 2, (60, 6)), rng.normal(size=(20, 6)) + 1e6]).astype(np.float32).astype(float)
    x[5, 2] = np.nan
    ids = [None if i == 3 else i // 2 if i < 20 else i for i in range(200)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], f"id long, vec array<{kind}>").repartition(3)
    got = neighbors.knn_join(df, df, "vec", 4, "id", "id", exclude_self=True, grid_rows=13, pivots=None).toPandas()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for q in range(20, 200):
        best = sorted((d[q, j], ids[j] if ids[j] is not None else -1) for j in range(200) if j != q and np.isfinite(d[q, j]))[:4]
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["distance"].to_numpy() == pytest.approx([b for b, _ in best])
        assert mine["neighbor_id"].fillna(-1).to_numpy().tolist() == [i for _, i in best]
