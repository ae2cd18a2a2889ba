"""Extremely randomised trees: one drawn threshold for each of a few features of a node.

All trees grow together, level by level, in two passes over the rows: the first finds the
least and greatest value of each candidate feature in each open node, the second counts the
classes on both sides of the threshold drawn between them. Every draw is a hash of tree,
node and feature, and what is summed are whole numbers of rows, so the trees do not depend
on the order of rows or tasks. Every tree sees all rows.

A task sums up all its rows before anything moves, and runs of nodes are brought together,
judged and given the draws of their children in tasks of their own. The driver and the
tasks hold the nodes of all trees as arrays: at most 2^(depth+1) for each, and no more than
the rows over `min_leaf` allow. A pass takes trees up to `group_nodes` open nodes at once.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.ml.trees import Tree, TreeModel
from riskweave.session import drop_stage, ship_package, write_stage

#: Rows of a block, open nodes that one pass deals with, and nodes that are judged together.
BLOCK_ROWS, GROUP_NODES, RUN_NODES = 32_768, 1 << 18, 1 << 10


def candidates(trees: np.ndarray, nodes: np.ndarray, features: int, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` features that each node may be split on, and the place of each one's threshold in steps of 2^-32.

    The draw of a feature is the MD5 hash of `tree|node|feature|seed`: the least hashes are taken,
    and their digits 9 to 16 tell the place.
    """
    ends = [f"{j}|{seed}".encode() for j in range(features)]
    feature, place = np.zeros((len(nodes), k), dtype=np.int16), np.zeros((len(nodes), k), dtype=np.uint32)
    for at in range(0, len(nodes), 4096):
        starts = [f"{t}|{v}|".encode() for t, v in zip(trees[at : at + 4096].tolist(), nodes[at : at + 4096].tolist())]
        drawn = b"".join([hashlib.md5(start + end).digest() for start in starts for end in ends])
        order = np.argsort(np.frombuffer(drawn, "S16").reshape(-1, features), axis=1, kind="stable")[:, :k]
        feature[at : at + 4096] = order
        words = np.frombuffer(drawn, ">u4").reshape(-1, features, 4)[:, :, 1]
        place[at : at + 4096] = np.take_along_axis(words, order, axis=1)
    return feature, place


@dataclass
class _Growing:
    """Nodes of a tree that still grows; a right child follows the left one. `open` are the nodes of the
    last level that may be split, `path` their numbers in a whole binary tree, `drawn` and `place` their candidates."""

    number: int
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    count: np.ndarray
    open: np.ndarray
    path: np.ndarray
    drawn: np.ndarray
    place: np.ndarray

    def split(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, min_leaf: int, drawn: np.ndarray, place: np.ndarray) -> None:
        """Split the open nodes whose feature is not -1; `drawn` and `place` hold the candidates of left and right children."""
        done = np.flatnonzero(feature >= 0)
        nodes, size = self.open[done], len(self.feature)
        kids = np.stack([left[done], self.count[nodes] - left[done]], axis=1).reshape(-1, 2)
        self.feature[nodes], self.cut[nodes] = feature[done], cut[done]
        self.left[nodes] = size + 2 * np.arange(len(done))
        grown = lambda a, rest: np.concatenate([a, np.full(2 * len(done), rest, dtype=a.dtype)])
        self.feature, self.cut, self.left = grown(self.feature, -1), grown(self.cut, 0.0), grown(self.left, -1)
        self.count = np.concatenate([self.count, kids])
        more = np.flatnonzero(_splittable(kids, min_leaf))
        self.path = (2 * self.path[done, None] + np.arange(2)).reshape(-1)[more]
        self.drawn, self.place = (a[done].reshape(-1, a.shape[2])[more] for a in (drawn, place))
        self.open = size + more

    def finished(self, share, weight: np.ndarray) -> Tree:
        inner = self.feature >= 0
        side = lambda by: np.where(inner, self.left + by, -1).astype(np.int32)
        return Tree(self.feature, self.cut, np.full(len(inner), -1, dtype=np.int8), side(0), side(1), share(self.count), self.count @ weight)


def _splittable(count: np.ndarray, min_leaf: int) -> np.ndarray:
    return (count.min(axis=1) > 0) & (count.sum(axis=1) >= 2 * min_leaf)


def _open_rows(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `x` that lie in one of the `nodes` of a tree, and in which."""
    slot = np.full(len(feature), -1, dtype=np.int64)
    slot[nodes] = np.arange(len(nodes))
    flat, width = x.reshape(-1), x.shape[1]
    rows, at = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
    while len(rows):
        found = slot[at]
        if found.max() >= 0:
            # Open nodes all lie on the last level, so every other row here has ended in a leaf.
            on = np.flatnonzero(found >= 0)
            return rows[on], found[on]
        split = feature[at]
        on = np.flatnonzero(split >= 0)
        if len(on) < len(rows):
            rows, at, split = rows[on], at[on], split[on]
        at = left[at] + ~(flat.take(rows * width + split) <= cut[at])
    return rows, at


def _blocks(df: DataFrame, features: list[str], label: str, block_rows: int) -> tuple[DataFrame, str]:
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)]

    def run(batches):
        held, size = [], 0

        def block():
            x, y = (np.concatenate(parts) for parts in zip(*held))
            values = ([len(y)], [int((y == 1).sum())], [x.tobytes()], [y.tobytes()])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names=["n", "pos", "x", "y"])

        for batch in batches:
            for at in range(0, len(batch), block_rows):
                rows = batch.slice(at, block_rows)
                if size + len(rows) > block_rows:
                    yield block()
                    held, size = [], 0
                x = np.column_stack([rows.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(len(features))])
                held.append((x, rows.column("y").to_numpy(zero_copy_only=False).astype(np.int8)))
                size += len(rows)
        if size:
            yield block()

    ship_package(df.sparkSession)
    return write_stage(df.select(*columns, F.col(label).cast("int").alias("y")).mapInArrow(run, "n long, pos long, x binary, y binary"), "rows")


def _packed(run: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([run], pa.int32()), *[pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns.values()]], names=["run", *columns])


def _pass(blocks: DataFrame, group: list[_Growing], width: int, add, sums: dict, settle, results: dict) -> dict[str, np.ndarray]:
    """Sum up the rows of all blocks by open node and candidate, then judge runs of nodes.

    `sums` names the sums with their kind, first value and the ufunc that joins two of them.
    `add(sums of all nodes, node, candidate, value, class)` puts in rows. `settle(first node, sums)`
    makes the `results`, named with their kinds, of a run of nodes; they reach the driver.
    """
    firsts = np.cumsum([0, *[len(tree.open) for tree in group]])
    total, k = int(firsts[-1]), group[0].drawn.shape[1]
    shapes = [(t.feature, t.cut, t.left, t.open, np.ascontiguousarray(t.drawn.T)) for t in group]
    empty = lambda n: {name: np.full((k, n), value, dtype=kind) for name, (kind, value, _) in sums.items()}

    def gather(batches):
        held, met = empty(total), np.zeros(total, dtype=bool)
        for batch in batches:
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, one = np.frombuffer(x.as_buffer(), dtype=np.float64).reshape(-1, width), np.frombuffer(y.as_buffer(), dtype=np.int8) == 1
                for first, (feature, cut, left, nodes, drawn) in zip(firsts, shapes):
                    rows, at = _open_rows(x, feature, cut, left, nodes)
                    told, at_first, slots = one[rows], rows * width, first + at
                    met[slots] = True
                    for c in range(k):
                        add(held, slots, c, x.reshape(-1).take(at_first + drawn[c].take(at)), told)
        met = np.flatnonzero(met)
        for run in range(-(-total // RUN_NODES)):
            here = met[slice(*np.searchsorted(met, [run * RUN_NODES, (run + 1) * RUN_NODES]))]
            if len(here):
                yield _packed(run, {"nodes": (here - run * RUN_NODES).astype(np.int32)} | {name: a[:, here] for name, a in held.items()})

    def judge(table: pa.Table) -> pa.Table:
        run = table.column("run")[0].as_py()
        held = empty(min(RUN_NODES, total - run * RUN_NODES))
        for i in range(len(table)):
            nodes = np.frombuffer(table.column("nodes")[i].as_buffer(), np.int32)
            for name, (kind, _, join) in sums.items():
                held[name][:, nodes] = join(held[name][:, nodes], np.frombuffer(table.column(name)[i].as_buffer(), kind).reshape(k, -1))
        return pa.Table.from_batches([_packed(run, settle(run * RUN_NODES, {name: a.T for name, a in held.items()}))])

    binaries = lambda names: ", ".join(f"{name} binary" for name in names)
    rows = blocks.mapInArrow(gather, "run int, " + binaries(["nodes", *sums]))
    tasks = min(blocks.sparkSession.sparkContext.defaultParallelism, -(-total // RUN_NODES))
    table = rows.repartition(tasks, "run").groupBy("run").applyInArrow(judge, "run int, " + binaries(results)).toArrow().sort_by("run")
    return {name: np.frombuffer(b"".join(table.column(name).to_pylist()), kind) for name, kind in results.items()}


def _gini(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weight times impurity of nodes with class weights a and b."""
    return 2 * a * b / np.maximum(a + b, 1e-300)


def _grow(blocks: DataFrame, group: list[_Growing], width: int, weight: np.ndarray, min_leaf: int, seed: int) -> None:
    """Split the open nodes of some trees; their children that may be split are the open nodes then."""
    k = group[0].drawn.shape[1]
    every = lambda get: np.concatenate([get(t) for t in group])
    drawn, place, path, whole = every(lambda t: t.drawn), every(lambda t: t.place), every(lambda t: t.path), every(lambda t: t.count[t.open])
    tree = every(lambda t: np.full(len(t.open), t.number))

    def widen(held, at, c, values, told):
        np.minimum.at(held["low"][c], at, values)
        np.maximum.at(held["high"][c], at, values)

    def draw(first, held):
        low, high = held["low"], held["high"]
        with np.errstate(invalid="ignore", over="ignore"):
            cut = low + place[first : first + len(low)] / 4294967296.0 * (high - low)
        # A candidate of one value only has no threshold.
        return {"cut": np.where(high > low, cut, np.nan)}

    spans = {"low": (np.float64, np.inf, np.minimum), "high": (np.float64, -np.inf, np.maximum)}
    cut = _pass(blocks, group, width, widen, spans, draw, {"cut": np.float64})["cut"].reshape(-1, k)

    cuts = np.ascontiguousarray(cut.T)

    def count(held, at, c, values, told):
        under = values <= cuts[c].take(at)
        np.add.at(held["pos"][c], at[under & told], 1)
        np.add.at(held["neg"][c], at[under & ~told], 1)

    def choose(first, held):
        left = np.stack([held["neg"], held["pos"]], axis=2).astype(np.float64)
        here = slice(first, first + len(left))
        right = whole[here, None, :] - left
        impurity = _gini(*np.moveaxis(left * weight, 2, 0)) + _gini(*np.moveaxis(right * weight, 2, 0))
        fits = (left.sum(axis=2) >= min_leaf) & (right.sum(axis=2) >= min_leaf) & ~np.isnan(cut[here])
        impurity = np.where(fits, impurity, np.inf)
        best = np.where(impurity == impurity.min(axis=1, keepdims=True), drawn[here], width).argmin(axis=1)
        at = np.arange(len(left))
        split, left = np.isfinite(impurity[at, best]), left[at, best]
        kids = np.stack([left, whole[here] - left], axis=1).reshape(-1, 2)
        more = np.flatnonzero(np.repeat(split, 2) & _splittable(kids, min_leaf))
        following, spots = np.zeros((len(kids), k), dtype=np.int16), np.zeros((len(kids), k), dtype=np.uint32)
        following[more], spots[more] = candidates(tree[here][more // 2], 2 * path[here][more // 2] + more % 2, width, k, seed)
        return {"feature": np.where(split, drawn[here][at, best], -1).astype(np.int16), "cut": cut[here][at, best], "left": left, "drawn": following, "place": spots}

    sides = {"neg": (np.int32, 0, np.add), "pos": (np.int32, 0, np.add)}
    got = _pass(blocks, group, width, count, sides, choose, {"feature": np.int16, "cut": np.float64, "left": np.float64, "drawn": np.int16, "place": np.uint32})
    left, following, spots = got["left"].reshape(-1, 2), got["drawn"].reshape(-1, 2, k), got["place"].reshape(-1, 2, k)
    first = 0
    for t in group:
        here = slice(first, first + len(t.open))
        first += len(t.open)
        t.split(got["feature"][here], got["cut"][here], left[here], min_leaf, following[here], spots[here])


def fit_extra_trees(
    train: DataFrame, features: list[str], label: str, trees: int = 200, depth: int = 15, min_leaf: int = 4, seed: int = 42,
    block_rows: int = BLOCK_ROWS, group_nodes: int = GROUP_NODES,
) -> TreeModel:
    """Extra trees with balanced class weights; the score is the mean of the leaves' shares of class 1.

    A node is split by the candidate of least weighted impurity (ties: the smaller feature), if
    both sides keep `min_leaf` rows; candidates that have one value only are passed over. Null
    features count as 0, rows without a label are left out; an empty table scores 0.5 throughout.
    """
    blocks, path = _blocks(train.where(F.col(label).isNotNull()), features, label, block_rows)
    seen = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("pos").alias("pos")).first()
    if not seen.n:
        drop_stage(train.sparkSession, path)
        return TreeModel([], 0.5, features, logistic=False)
    count = np.array([[seen.n - seen.pos, seen.pos]], dtype=np.float64)
    weight = seen.n / (2 * np.maximum(count[0], 1))
    k, width = max(1, round(math.sqrt(len(features)))), len(features)
    share = lambda c: weight[1] * c[:, 1] / (c @ weight) / trees
    drawn, place = candidates(np.arange(trees), np.ones(trees, dtype=np.int64), width, k, seed)
    first = np.arange(int(count.min() > 0))
    forest = [_Growing(t, np.array([-1], np.int16), np.zeros(1), np.array([-1]), count, first, first + 1, drawn[t : t + 1], place[t : t + 1]) for t in range(trees)]
    for _ in range(depth):
        group, nodes = [], 0
        for t in [*(t for t in forest if len(t.open)), None]:
            if group and (t is None or nodes + len(t.open) > group_nodes):
                _grow(blocks, group, width, weight, min_leaf, seed)
                group, nodes = [], 0
            if t is not None:
                group.append(t)
                nodes += len(t.open)
    drop_stage(train.sparkSession, path)
    return TreeModel([t.finished(share, weight) for t in forest], 0.0, features, logistic=False)
