"""Second-order gradient boosting on binned columns, in three ways of growing a tree.

Columns are binned once and written as blocks of rows. Each level of a tree is one pass: a
task finds the node of each of its rows and sums gradient, hessian and rows by (node,
feature, bin); Spark adds the sums up. Of two siblings only the smaller is summed, the other
is what is left of their parent. Gradients are whole numbers of 2^-20, so sums do not
depend on the order of rows, blocks or tasks, and a lost task gives the same tree.

A task gets the margins of its rows from the last written state and the few trees grown
since, so nothing is kept on an executor; the state is written anew every few trees. What
reaches the driver is bounded by nodes x features x bins.

* `xgb` grows level by level, on a part of the rows and columns of each tree.
* `lgb` grows leaf by leaf: of all open leaves the one of greatest gain is split next. A
  leaf's gain does not depend on other leaves, so all candidates come from level passes.
* `cat` grows symmetric trees, one split for all nodes of a level. A row's gradient comes
  from a model that has not seen the row: rows are put into segments by the hash order, and
  each segment's leaf values come from the segments before it.

Rounds stop once the AUC on the validation rows has not risen for `patience` rounds; the
trees up to the best round are the model.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from riskweave.functions.hashing import hash_order
from riskweave.ml.trees import Tree, TreeModel
from riskweave.session import drop_stage, ship_package, stage_path, write_stage

SCALE = 1 << 20
PRIME = 2147483647
#: Rows that bin edges are taken from, in the order of a hash of their key.
EDGE_ROWS = 200_000
SUMS = StructType([StructField(c, LongType()) for c in ("key", "g", "h", "n")])
BLOCK_ROWS = "bins binary, row binary, y binary, margin binary"
#: Rows that are worth a task of their own.
TASK_ROWS = 20_000
#: Scores are rounded to this many steps for the validation AUC.
AUC_STEPS = 1 << 16


@dataclass(frozen=True)
class Growth:
    """Settings of a learner."""

    rounds: int = 500
    rate: float = 0.05
    depth: int = 6
    bins: int = 256
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_weight: float = 0.0
    min_rows: int = 1
    rows: float = 1.0
    columns: float = 1.0
    leaves: int | None = None
    symmetric: bool = False
    segments: int = 0
    patience: int | None = 50
    seed: int = 42


# Settings of the three boosted-tree learners.
FLAVOURS = {
    "xgb": Growth(min_weight=5.0, rows=0.8, columns=0.8, min_gain=0.1, l1=0.1, l2=1.0),
    "lgb": Growth(leaves=31, min_rows=20, min_weight=0.001, columns=0.8, l1=0.1, l2=1.0),
    "cat": Growth(symmetric=True, segments=8, bins=129, l2=3.0),
}


def bin_edges(df: DataFrame, features: list[str], key: str, bins: int, rows: int = EDGE_ROWS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: distinct values at even ranks, less the greatest.

    Taken from at most `rows` rows in the order of a hash of their key. A value belongs to
    the bin of the first edge that it does not exceed, or to the last bin.
    """
    seen = df.orderBy(hash_order(key), key).limit(rows).select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]).toPandas()
    out = []
    for c in features:
        values = np.sort(seen[c].to_numpy())
        ranks = np.arange(1, bins) * len(values) // bins
        edges = np.unique(values[ranks[ranks > 0] - 1]) if len(values) else np.zeros(0)
        out.append(edges[edges < values[-1]] if len(values) else edges)
    return out


def _packed(batches):
    """Sums (key, g, h, n) of a task in one row: steps of the keys and the sums byte by byte, compressed."""
    held = [np.stack([b.column(c).to_numpy() for c in SUMS.names]) for b in batches]
    sums = np.concatenate(held, axis=1) if held else np.zeros((4, 0), np.int64)
    sums = sums[:, np.argsort(sums[0], kind="stable")]
    sums[0] = np.diff(sums[0], prepend=0)
    # A small negative number has a low bit for its sign, so its high bytes are zeros as well.
    sums = (sums << 1) ^ (sums >> 63)
    planes = np.ascontiguousarray(sums, dtype="<i8").view(np.uint8).reshape(4, -1, 8).transpose(0, 2, 1)
    yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(planes.tobytes(), 1)], pa.binary())], names=["sums"])


def _unpacked(parts) -> pa.Table:
    """The sums of all tasks as a table again."""
    tables = []
    for part in parts:
        planes = np.frombuffer(zlib.decompress(part), dtype=np.uint8).reshape(4, 8, -1)
        sums = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]
        sums = (sums >> 1) ^ -(sums & 1)
        tables.append(pa.table([np.cumsum(sums[0]), *sums[1:]], names=SUMS.names))
    return pa.concat_tables(tables) if tables else pa.table([pa.array([], pa.int64())] * 4, names=SUMS.names)


def _draw(*parts) -> int:
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


def tree_columns(number: int, features: int, share: float, seed: int) -> np.ndarray:
    """Features that a tree may split on: the first of them in the order of a hash."""
    order = sorted(range(features), key=lambda j: (hashlib.md5(f"{number}|{j}|{seed}".encode()).hexdigest()))
    out = np.zeros(features, dtype=bool)
    out[order[: max(1, math.ceil(share * features))]] = True
    return out


def tree_rows(row: np.ndarray, number: int, share: float, seed: int) -> np.ndarray:
    """Rows that a tree is grown on, from the rows' own numbers in [1, PRIME)."""
    if share >= 1:
        return np.ones(len(row), dtype=bool)
    return row * (1 + _draw(number, seed) % (PRIME - 1)) % PRIME < share * PRIME


class Block:
    """Rows of one block as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int, width: int):
        get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), dtype=kind)
        self.bins = get("bins", np.uint8).reshape(-1, width)
        self.row, self.y, self.margin = get("row", np.int64), get("y", np.int8), get("margin", np.float64)
        self.valid = self.y >= 2

    def advance(self, trees: list, segments: int) -> None:
        """Add the trees grown since the margins were written."""
        margin = self.margin.copy()
        for tree, values in trees:
            margin += values[self.segment(segments), tree.find(self.bins, binned=True)]
        self.margin = margin

    def segment(self, segments: int) -> np.ndarray:
        """Whose leaf values a row gets: those of its own segment, or (last) of all rows."""
        own = self.row * segments // PRIME if segments else np.zeros(len(self.row), dtype=np.int64)
        return np.where(self.valid, segments, own)

    def gradients(self, weight: float) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and hessian of the weighted logistic loss in steps of 1 / SCALE."""
        p = 1.0 / (1.0 + np.exp(-self.margin))
        w = np.where(self.y % 2 == 1, weight, 1.0)
        return np.rint(w * (p - self.y % 2) * SCALE), np.rint(w * p * (1 - p) * SCALE)


def _write_blocks(train: DataFrame, validation: DataFrame | None, features: list[str], label: str, key: str, edges: list[np.ndarray], base: float, rows: int) -> tuple[DataFrame, str]:
    """Blocks of rows: bins (a byte each), the row's number, label (2 more for validation rows), margin.

    A file holds at least some `TASK_ROWS` rows, so a pass is not made of needlessly small tasks.
    """
    number = (F.conv(F.substring(hash_order(key, seed=7), 1, 8), 16, 10).cast("long") % (PRIME - 1)) + 1
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)]
    pick = lambda d, more: d.select(*columns, number.alias("row"), (F.col(label).cast("int") + more).alias("y"))
    both = pick(train, 0) if validation is None else pick(train, 0).unionByName(pick(validation, 2))

    def run(batches):
        for rows in batches:
            if not len(rows):
                continue
            found = [np.searchsorted(e, rows.column(f"x{i}").to_numpy(zero_copy_only=False), side="left").astype(np.uint8) for i, e in enumerate(edges)]
            held = {
                "bins": np.column_stack(found).tobytes(), "row": rows.column("row").to_numpy().tobytes(),
                "y": rows.column("y").to_numpy().astype(np.int8).tobytes(), "margin": np.full(len(rows), base).tobytes(),
            }
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in held.values()], names=list(held))

    ship_package(train.sparkSession)
    return write_stage(both.coalesce(-(-rows // TASK_ROWS)).mapInArrow(run, BLOCK_ROWS), "blocks")


class Grower:
    """Grows trees on written blocks."""

    def __init__(self, blocks: DataFrame, path: str, growth: Growth, edges: list[np.ndarray], weight: float):
        self.spark, self.growth, self.edges, self.weight = blocks.sparkSession, growth, edges, weight
        self.width, self.bins = len(edges), max((len(e) for e in edges), default=0) + 1
        # Made once: a pass is short, and so should be what it takes to state it.
        self.add_up = [F.sum(c).alias(c) for c in "ghn"]
        self._open(blocks, path)

    def _open(self, blocks: DataFrame, path: str) -> None:
        """Read the blocks in a session of its own: a pass is one short job whose sums are of known
        size, so planning it again at run time only costs time. Reducers follow the number of tasks."""
        own = blocks.sparkSession.newSession()
        own.conf.set("spark.sql.adaptive.enabled", "false")
        self.blocks, self.path, self.recent = own.read.schema(blocks.schema).parquet(path), path, []
        tasks = self.blocks.rdd.getNumPartitions()
        own.conf.set("spark.sql.shuffle.partitions", str(min(tasks, 8 + tasks // 64)))

    def _sums(self, each) -> dict[int, tuple[int, int, int]]:
        """Add up what `each` (block) -> (keys, g, h, n) gives, over all blocks."""
        width, recent, segments = self.width, self.recent, self.growth.segments

        def run(batches):
            held = {}
            for batch in batches:
                for i in range(len(batch)):
                    block = Block(batch, i, width)
                    block.advance(recent, segments)
                    for k, sums in each(block):
                        held[k] = held[k] + sums if k in held else sums
            keys = [np.zeros(0, np.int64)]
            parts = [np.zeros((3, 0))]
            for start, sums in held.items():
                seen = np.flatnonzero(sums[2])
                keys.append(start + seen), parts.append(sums[:, seen])
            g, h, n = np.concatenate(parts, axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in (np.concatenate(keys), g, h, n)], names=["key", "g", "h", "n"])

        rows = self.blocks.mapInArrow(run, SUMS)
        packed = rows.groupBy("key").agg(*self.add_up).mapInArrow(_packed, "sums binary").toArrow()
        return _unpacked(packed.column("sums").to_pylist())

    def histograms(self, tree: Tree, nodes: list[int], number: int, judge: bool) -> tuple[dict[int, np.ndarray], np.ndarray | None]:
        """Sums (g, h, n) by feature and bin of the rows in `nodes`; with `judge` also the validation rows by score step and label."""
        size, width, bins = self.width * self.bins, self.width, self.bins
        growth, weight, slot = self.growth, self.weight, np.full(len(tree.value), -1, dtype=np.int64)
        slot[nodes] = np.arange(len(nodes))

        def each(block):
            use = ~block.valid & tree_rows(block.row, number, growth.rows, growth.seed)
            if judge and block.valid.any():
                step = np.floor((AUC_STEPS - 1) / (1.0 + np.exp(-block.margin[block.valid]))).astype(np.int64)
                n = np.bincount(2 * step + block.y[block.valid] % 2, minlength=2 * AUC_STEPS).astype(np.float64)
                yield len(nodes) * size, np.stack([n, n, n])
            at = slot[tree.find(block.bins, binned=True)]
            use &= at >= 0
            g, h = (a[use] for a in block.gradients(weight))
            at, cells = at[use], block.bins[use]
            place = ((at * size)[:, None] + np.arange(width) * bins + cells).reshape(-1)
            weights = (np.repeat(g, width), np.repeat(h, width), None)
            sums = np.stack([np.bincount(place, weights=w, minlength=len(nodes) * size) for w in weights])
            yield 0, sums

        table = self._sums(each)
        keys, sums = table.column("key").to_numpy(), np.stack([table.column(c).to_numpy() for c in "ghn"])
        whole = np.zeros((3, len(nodes) * size + 2 * AUC_STEPS), dtype=np.int64)
        whole[:, keys] = sums
        found = {node: whole[:, i * size : (i + 1) * size].reshape(3, width, bins) for i, node in enumerate(nodes)}
        return found, whole[2, len(nodes) * size :].reshape(-1, 2) if judge else None

    def segment_sums(self, tree: Tree) -> np.ndarray:
        """Sums (g, h) by segment and leaf."""
        segments, weight, nodes = self.growth.segments, self.weight, len(tree.value)

        def each(block):
            g, h = block.gradients(weight)
            place = block.segment(segments) * nodes + tree.find(block.bins, binned=True)
            yield 0, np.stack([np.bincount(place[~block.valid], weights=None if w is None else w[~block.valid], minlength=segments * nodes) for w in (g, h, None)])

        table = self._sums(each)
        out = np.zeros((2, segments * nodes))
        out[:, table.column("key").to_numpy()] = np.stack([table.column(c).to_numpy() for c in "gh"]) / SCALE
        return out.reshape(2, segments, nodes)

    def leaf(self, g, h):
        """Value of a leaf."""
        return -self.growth.rate * self._shrunk(g) / (h + self.growth.l2)

    def _shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.growth.l1, 0.0)

    def _score(self, g, h):
        return self._shrunk(g) ** 2 / np.maximum(h + self.growth.l2, 1e-12)

    def gains(self, hist: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Gain of each (feature, bin) as the last bin that goes left; -inf where it can't be taken."""
        growth = self.growth
        left = np.cumsum(hist, axis=2)
        whole = left[:, :, -1:]
        right = whole - left
        (gl, hl), (gr, hr), (g, h) = (a[:2] / SCALE for a in (left, right, whole))
        gain = 0.5 * (self._score(gl, hl) + self._score(gr, hr) - self._score(g, h)) - growth.min_gain
        if growth.symmetric:
            fits = np.ones(gain.shape, dtype=bool)
        else:
            fits = (hl >= growth.min_weight) & (hr >= growth.min_weight) & (left[2] >= growth.min_rows) & (right[2] >= growth.min_rows)
        for j, e in enumerate(self.edges):
            fits[j, len(e) :] = False
        return np.where(fits & columns[:, None], gain, -np.inf)

    def grow(self, number: int, judge: bool) -> tuple[Tree, np.ndarray | None]:
        """The next tree, and the validation rows by score step and label before it."""
        growth = self.growth
        columns = tree_columns(number, self.width, growth.columns, growth.seed)
        tree = Tree()
        tree.add(0.0, 0.0)
        known, seen = self.histograms(tree, [0], number, judge)
        g, h, n = known[0][:, 0].sum(axis=1) if self.width else np.zeros(3)
        tree.value[0], tree.cover[0] = float(self.leaf(g / SCALE, h / SCALE)), float(h / SCALE)
        gain_of, open_nodes = {}, [0]
        for level in range(growth.depth):
            gains = {v: self.gains(known[v], columns) for v in open_nodes}
            if growth.symmetric and gains:
                total = sum(gains.values())
                gains = dict.fromkeys(open_nodes, total)
            pairs = []
            for v in open_nodes:
                best = int(np.argmax(gains[v]))
                j, b = divmod(best, self.bins)
                if not gains[v][j, b] > 1e-9:
                    continue
                left = known[v][:, j, : b + 1].sum(axis=1)
                right = known[v][:, j].sum(axis=1) - left
                children = [tree.add(float(self.leaf(s[0] / SCALE, s[1] / SCALE)), float(s[1] / SCALE)) for s in (left, right)]
                tree.split(v, j, b, float(self.edges[j][b]), *children)
                gain_of[v] = float(gains[v][j, b])
                pairs.append((v, children, (left[2], right[2])))
            if not pairs or level + 1 == growth.depth:
                break
            small = [c[int(n[1] < n[0])] for _, c, n in pairs]
            found, _ = self.histograms(tree, small, number, False)
            nexts = {}
            for (v, children, _), s in zip(pairs, small):
                other = children[0] if s == children[1] else children[1]
                nexts[s], nexts[other] = found[s], known[v] - found[s]
            known, open_nodes = nexts, [c for _, children, _ in pairs for c in children]
        return (best_first(tree, gain_of, growth.leaves) if growth.leaves else tree), seen

    def add(self, tree: Tree, every: int = 16) -> None:
        """Let the next trees start from this one."""
        segments = self.growth.segments
        if segments:
            g, h = np.cumsum(self.segment_sums(tree), axis=1)
            before = np.concatenate([np.zeros((2, 1, len(tree.value))), np.stack([g, h])], axis=1)
            values = self.leaf(before[0], before[1])
            tree.value = [float(v) if f < 0 else 0.0 for v, f in zip(values[-1], tree.feature)]
        else:
            values = np.array([tree.value])
        self.recent.append((tree, values))
        if len(self.recent) >= every:
            width, recent = self.width, self.recent

            def run(batches):
                for batch in batches:
                    margins = []
                    for i in range(len(batch)):
                        block = Block(batch, i, width)
                        block.advance(recent, segments)
                        margins.append(block.margin.tobytes())
                    kept = [batch.column(c) for c in ("bins", "row", "y")]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(margins, pa.binary())], names=["bins", "row", "y", "margin"])

            old, path = self.path, stage_path(self.spark, "blocks")
            self.blocks.mapInArrow(run, BLOCK_ROWS).write.parquet(path)
            self._open(self.spark.read.schema(BLOCK_ROWS).parquet(path), path)
            drop_stage(self.spark, old)


def best_first(tree: Tree, gains: dict[int, float], leaves: int) -> Tree:
    """The part of a tree that leaf-wise growth reaches: the open node of greatest gain is split until there are `leaves` leaves."""
    taken, open_nodes = set(), [0]
    while len(taken) + 1 < leaves:
        ready = [v for v in open_nodes if v in gains]
        if not ready:
            break
        v = max(ready, key=lambda v: (gains[v], -v))
        taken.add(v)
        open_nodes.remove(v)
        open_nodes += [tree.left[v], tree.right[v]]
    out = Tree()

    def copy(v: int) -> int:
        new = out.add(tree.value[v], tree.cover[v])
        if v in taken:
            out.split(new, tree.feature[v], tree.bin[v], tree.cut[v], copy(tree.left[v]), copy(tree.right[v]))
        return new

    copy(0)
    return out


def auc(counts: np.ndarray) -> float:
    """Area under the curve from rows by (score step, label); ties count half."""
    neg, pos = counts[:, 0].astype(np.float64), counts[:, 1].astype(np.float64)
    if not neg.sum() or not pos.sum():
        return 0.5
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (neg.sum() * pos.sum()))


def fit_boosted(train: DataFrame, validation: DataFrame | None, features: list[str], label: str, key: str, flavour: str = "xgb", **settings) -> TreeModel:
    """A boosted model of one of the three learners; `settings` replace single fields of its `Growth`.

    Positives weigh as much as negatives in all. `key` names the rows uniquely: it decides
    their segment and the part of the rows that each tree sees. Null features count as 0,
    rows without a label are left out. A table without rows, or of one class only, has
    nothing to split and gives the base value alone.
    """
    growth = replace(FLAVOURS[flavour], **settings)
    if not 2 <= growth.bins <= 256:
        raise ValueError("bins must be from 2 to 256")
    known = F.col(label).isNotNull()
    train, validation = train.where(known), validation.where(known) if validation is not None else None
    counts = train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")).first()
    pos, neg = counts.pos or 0, counts.n - (counts.pos or 0)
    if not pos or not neg:
        return TreeModel([], 0.0 if not counts.n else (1.0 if pos else -1.0) * 36.0, features)
    edges = bin_edges(train, features, key, growth.bins)
    blocks, path = _write_blocks(train, validation, features, label, key, edges, 0.0, counts.n)
    grower = Grower(blocks, path, growth, edges, neg / pos)
    judge = validation is not None and growth.patience is not None
    trees, best, best_at = [], -1.0, 0
    while True:
        tree, seen = grower.grow(len(trees), judge)
        if judge and trees:
            now = auc(seen)
            if now > best:
                best, best_at = now, len(trees)
            if len(trees) - best_at >= growth.patience:
                break
        if len(trees) == growth.rounds:
            break
        grower.add(tree)
        trees.append(tree)
    drop_stage(train.sparkSession, grower.path)
    return TreeModel(trees[:best_at] if judge else trees, 0.0, features)
