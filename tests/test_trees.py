"""Boosted and randomised trees against plain regrowth, and attributions against all subsets."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.ml import boosting
from riskweave.ml.trees import Tree, TreeModel, scores, shap

NAMES = ["a", "b", "c", "d"]


def rows_of(n=260, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, len(NAMES))), 1)
    x[:, 2] = rng.integers(0, 3, n)
    y = (x[:, 0] + 0.7 * x[:, 1] * (x[:, 2] > 0) + rng.normal(scale=0.7, size=n) > 0.9).astype(int)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))], f"id long, {', '.join(f'{c} double' for c in NAMES)}, y int").repartition(3)


def regrown(spark, df, growth, rounds):
    """Each tree as {path: (feature, cut, value, cover)}, grown by masks over all rows."""
    from riskweave.functions.hashing import hash_order

    number = (F.conv(F.substring(hash_order("id", seed=7), 1, 8), 16, 10).cast("long") % (boosting.PRIME - 1)) + 1
    data = df.withColumn("number", number).toPandas()
    x, y, u = data[NAMES].to_numpy(), data["y"].to_numpy(), data["number"].to_numpy()
    edges = boosting.bin_edges(df, NAMES, "id", growth.bins)
    w = np.where(y == 1, (y == 0).sum() / (y == 1).sum(), 1.0)
    margin, out = np.zeros(len(y)), []
    shrink = lambda s: math.copysign(max(abs(s) - growth.l1, 0), s)
    score = lambda g, h: shrink(g) ** 2 / max(h + growth.l2, 1e-12)
    value = lambda m: -growth.rate * shrink(g[m].sum()) / (h[m].sum() + growth.l2)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint(w * (p - y) * boosting.SCALE) / boosting.SCALE, np.rint(w * p * (1 - p) * boosting.SCALE) / boosting.SCALE
        used = boosting.tree_rows(u, t, growth.rows, growth.seed)
        columns = np.flatnonzero(boosting.tree_columns(t, len(NAMES), growth.columns, growth.seed))

        def gain(mask, j, e):
            left, right = mask & (x[:, j] <= e), mask & (x[:, j] > e)
            if not growth.symmetric and (h[left].sum() < growth.min_weight or h[right].sum() < growth.min_weight or min(left.sum(), right.sum()) < growth.min_rows):
                return -math.inf
            return 0.5 * (score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[mask].sum(), h[mask].sum())) - growth.min_gain

        masks, splits, open_nodes = {"": np.ones(len(y), dtype=bool)}, {}, [""]
        for _ in range(growth.depth):
            fits = {v: [(gain(masks[v] & used, j, e), -j, -b, j, e) for j in columns for b, e in enumerate(edges[j])] for v in open_nodes}
            if growth.symmetric:
                total = [(sum(fits[v][i][0] for v in open_nodes), *fits[open_nodes[0]][i][1:]) for i in range(len(next(iter(fits.values()))))]
                fits = dict.fromkeys(open_nodes, total)
            following = []
            for v in open_nodes:
                best = max(fits[v], key=lambda c: (round(c[0], 12), c[1], c[2]))
                if best[0] > 1e-9:
                    splits[v] = best[0], best[3], best[4]
                    masks[v + "L"], masks[v + "R"] = masks[v] & (x[:, best[3]] <= best[4]), masks[v] & (x[:, best[3]] > best[4])
                    following += [v + "L", v + "R"]
            open_nodes = following
        if growth.leaves:
            taken, ready = set(), [""]
            while len(taken) + 1 < growth.leaves and any(v in splits for v in ready):
                v = max((v for v in ready if v in splits), key=lambda v: splits[v][0])
                taken.add(v)
                ready = [r for r in ready if r != v] + [v + "L", v + "R"]
            splits = {v: s for v, s in splits.items() if v in taken}
        reached = {""} | {v + s for v in splits for s in "LR"}
        tree = {v: (NAMES[splits[v][1]], splits[v][2]) if v in splits else value(masks[v] & used) for v in reached}
        out.append(tree)
        segment = u * growth.segments // boosting.PRIME if growth.segments else None
        for v in reached - set(splits):
            for s in range(growth.segments) if growth.segments else [None]:
                own = masks[v] if s is None else masks[v] & (segment == s)
                margin[own] += tree[v] if s is None else value(masks[v] & (segment < s))
    return out


def by_path(tree: Tree):
    out, stack = {}, [(0, "")]
    while stack:
        v, path = stack.pop()
        out[path] = (NAMES[tree.feature[v]], tree.cut[v]) if tree.feature[v] >= 0 else tree.value[v]
        if tree.feature[v] >= 0:
            stack += [(tree.left[v], path + "L"), (tree.right[v], path + "R")]
    return out


@pytest.mark.parametrize("flavour, settings", [
    ("xgb", {"min_weight": 2.0, "bins": 16}), ("lgb", {"min_rows": 5, "leaves": 6, "bins": 256}), ("cat", {"segments": 4, "bins": 9, "depth": 3}), ("cat", {"segments": 0, "depth": 2}),
])
def test_trees_are_those_of_plain_regrowth(spark, flavour, settings):
    """Splits, cuts and leaf values of several rounds, with the state written in between."""
    x, y = rows_of()
    df = frame(spark, x, y)
    growth = boosting.replace(boosting.FLAVOURS[flavour], rounds=3, rate=0.3, **settings)
    model = boosting.fit_boosted(df, None, NAMES, "y", "id", flavour, rounds=3, rate=0.3, **settings)
    want = regrown(spark, df, growth, 3)
    assert len(model.trees) == 3 and max(len(t.value) for t in model.trees) > 3
    for tree, plain in zip(model.trees, want):
        got = by_path(tree)
        assert got.keys() == plain.keys()
        for path, node in plain.items():
            assert got[path] == node if isinstance(node, tuple) else got[path] == pytest.approx(node, abs=1e-9)


def test_written_state_does_not_change_the_trees(spark, monkeypatch):
    x, y = rows_of(120)
    df = frame(spark, x, y)
    plain = boosting.fit_boosted(df, None, NAMES, "y", "id", "cat", rounds=4, depth=2, segments=3)
    add = boosting.Grower.add
    monkeypatch.setattr(boosting.Grower, "add", lambda self, tree: add(self, tree, every=2))
    again = boosting.fit_boosted(df, None, NAMES, "y", "id", "cat", rounds=4, depth=2, segments=3)
    assert [v for t in plain.trees for v in t.value] == pytest.approx([v for t in again.trees for v in t.value])


def test_patience(spark):
    """With labels drawn at random the validation AUC soon stops rising; the best round is kept."""
    x, _ = rows_of(200, 5)
    rng = np.random.default_rng(1)
    df = frame(spark, x, rng.integers(0, 2, 200))
    fit, valid = df.where("id % 2 = 0"), df.where("id % 2 = 1")
    counted = []
    grow = boosting.Grower.grow
    boosting.Grower.grow = lambda self, number, judge: counted.append(grow(self, number, judge)) or counted[-1]
    try:
        model = boosting.fit_boosted(fit, valid, NAMES, "y", "id", "lgb", rounds=30, depth=2, patience=3, min_rows=5)
    finally:
        boosting.Grower.grow = grow
    seen = [boosting.auc(c) for _, c in counted]
    best = 1 + int(np.argmax(seen[1:]))
    assert len(model.trees) == best and len(seen) == min(31, best + 4)
    # The AUC of the chosen round is that of the model's scores on the validation rows.
    got = model.transform(valid).select("y", "score").toPandas()
    steps = np.floor((boosting.AUC_STEPS - 1) * got["score"].to_numpy())
    pairs = [(a > b) + (a == b) / 2 for a in steps[got["y"] == 1] for b in steps[got["y"] == 0]]
    assert seen[best] == pytest.approx(np.mean(pairs), abs=1e-6)


def test_odd_tables(spark):
    x, y = rows_of(40)
    df = frame(spark, x, y)
    assert boosting.fit_boosted(df.limit(0), None, NAMES, "y", "id").trees == []
    one = boosting.fit_boosted(df.where("y = 1"), None, NAMES, "y", "id").transform(df).select("score").first()[0]
    assert one > 0.999
    holes = df.withColumns({"a": F.when(F.col("id") % 3 == 0, F.col("a")), "b": F.lit(1.0), "y": F.when(F.col("id") != 1, F.col("y"))})
    model = boosting.fit_boosted(holes, None, NAMES, "y", "id", "xgb", rounds=2, min_weight=0.5)
    filled = boosting.fit_boosted(holes.na.fill(0.0, ["a"]).where("id != 1"), None, NAMES, "y", "id", "xgb", rounds=2, min_weight=0.5)
    assert model.nodes() == filled.nodes() and all(n[2] != "b" for n in model.nodes())
    assert model.transform(holes).where("score is null").count() == 0


def random_tree(rng, features, depth):
    tree = Tree()
    tree.add(0.0, 100.0)
    frontier = [0]
    for _ in range(depth):
        following = []
        for v in frontier:
            if rng.random() < 0.85:
                share = rng.random()
                kids = [tree.add(float(rng.normal()), tree.cover[v] * s) for s in (share, 1 - share)]
                tree.split(v, int(rng.integers(features)), 0, float(rng.normal()), *kids)
                following += kids
        frontier = following
    return tree


def expected(tree, x, known, v=0):
    if tree.feature[v] < 0:
        return tree.value[v]
    if tree.feature[v] in known:
        return expected(tree, x, known, tree.left[v] if x[tree.feature[v]] <= tree.cut[v] else tree.right[v])
    return sum(tree.cover[c] / tree.cover[v] * expected(tree, x, known, c) for c in (tree.left[v], tree.right[v]))


@pytest.mark.parametrize("features, depth", [(3, 6), (5, 4), (8, 5)])
def test_attributions_by_enumeration_of_subsets(features, depth):
    rng = np.random.default_rng(features)
    trees = [random_tree(rng, features, depth) for _ in range(2)]
    data = rng.normal(size=(4, features))
    phi = shap(trees, data)
    for x, got in zip(data, phi):
        for j in range(features):
            others = [k for k in range(features) if k != j]
            want = 0.0
            for size in range(features):
                weight = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                want += weight * sum(expected(t, x, {*s, j}) - expected(t, x, set(s)) for s in combinations(others, size) for t in trees)
            assert got[j] == pytest.approx(want, abs=1e-9)


def test_attributions_add_up_to_the_margin(spark):
    x, y = rows_of()
    df = frame(spark, x, y)
    model = boosting.fit_boosted(df, None, NAMES, "y", "id", "xgb", rounds=8, min_weight=1.0)
    got = model.attributions(df).select("phi", model.margin().alias("margin")).toPandas()
    assert np.abs(np.stack(got["phi"]).sum(axis=1) + model.expected() - got["margin"]).max() < 1e-9
    assert np.allclose(scores(model.trees, df.toPandas()[NAMES].to_numpy()).mean(), got["margin"].mean())
    assert TreeModel([], 0.5, NAMES).attributions(df).select("phi").first()[0] == [0.0] * 4


def test_attributions_of_a_short_table_are_dealt(spark):
    """Leaves make the work, so one task would hold up all cores."""
    tree = Tree()
    tree.add(0.0, 4.0)
    tree.split(0, 0, -1, 0.5, tree.add(1.0, 1.0), tree.add(-1.0, 3.0))
    rows = spark.createDataFrame([(float(i % 2),) for i in range(40)], "a double").coalesce(1)
    out = TreeModel([tree], 0.0, ["a"]).attributions(rows)
    assert out.rdd.getNumPartitions() > 1
    assert sorted({(r.a, round(r.phi[0], 9)) for r in out.collect()}) == [(0.0, 1.5), (1.0, -0.5)]


def test_sums_reach_the_driver_packed():
    """Sums of any sign and size come back as they were, in a fraction of their bytes."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    keys = rng.permutation(60_000)[:40_000]
    sums = pa.table([keys, rng.integers(-(1 << 22), 1 << 22, 40_000), rng.integers(0, 1 << 20, 40_000), rng.integers(1, 9, 40_000)], names=["key", "g", "h", "n"])
    sums = pa.concat_tables([sums, pa.table([[70_000, 70_001], [-(1 << 60), 1 << 60], [0, 1 << 60], [1, 1]], names=["key", "g", "h", "n"])])
    row = pa.Table.from_batches(boosting._packed(iter(sums.to_batches(7_000)))).column("sums").to_pylist()
    assert len(row) == 1 and len(row[0]) < sums.nbytes / 3
    assert boosting._unpacked(row).equals(sums.sort_by("key"))
    assert len(boosting._unpacked(list(pa.Table.from_batches(boosting._packed(iter([]))).column("sums").to_pylist()))) == 0


def test_extra_trees_do_not_depend_on_blocks_and_groups(spark):
    """Rows and trees come in several pieces; null features count as 0 and rows without a label are left out."""
    import hashlib

    from riskweave.ml import extra

    x, y = rows_of(400)
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y)] + [(None, 1.0, None, 2.0, 1), (9.0, 9.0, 9.0, 9.0, None)]
    df = spark.createDataFrame(rows, f"{', '.join(f'{c} double' for c in NAMES)}, y int").repartition(3)
    whole = extra.fit_extra_trees(df, NAMES, "y", trees=6, depth=6)
    pieces = extra.fit_extra_trees(df, NAMES, "y", trees=6, depth=6, block_rows=17, group_nodes=5)
    assert whole.nodes() == pieces.nodes() and len(whole.nodes()) > 60
    assert all(tree.cover[0] == pytest.approx(401) for tree in whole.trees)
    drawn, place = extra.candidates(np.array([3, 5]), np.array([1, 12]), 4, 2, 42)
    for t, v, got, at in zip((3, 5), (1, 12), drawn, place):
        order = sorted((hashlib.md5(f"{t}|{v}|{j}|42".encode()).hexdigest(), j) for j in range(4))[:2]
        assert [(j, int(d[8:16], 16)) for d, j in order] == [(int(j), int(a)) for j, a in zip(got, at)]
    assert all(isinstance(tree.cut, np.ndarray) and len(tree.cut) == len(tree.value) for tree in whole.trees)
    assert extra.fit_extra_trees(df.limit(0), NAMES, "y", trees=2).trees == []
