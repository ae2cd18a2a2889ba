"""Out-of-fold scores, meta models, score fusion and its weight search."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.columns import total_of
from riskweave.ml.models import fit_gbt, fit_logreg
from riskweave.operators.prep import standardize
from riskweave.session import drop_stage, materialize, ship_package, write_stage

Fitter = Callable[[DataFrame], object]


@dataclass
class OutOfFold:
    scores: DataFrame
    models: dict[str, list]

    def score_test(self, df: DataFrame) -> DataFrame:
        """Each model's score on new rows: the mean over its fold models."""
        out = df
        for name, parts in self.models.items():
            cols = [f"_{name}_{i}" for i in range(len(parts))]
            for c, model in zip(cols, parts):
                out = model.transform(out, c)
            out = out.withColumn(name, total_of(*cols) / len(cols)).drop(*cols)
        return out


def oof(df: DataFrame, fitters: dict[str, Fitter], fold: str, keep: list[str], oversample: Callable | None = None) -> OutOfFold:
    """Score every row by models that did not see its fold.

    `oversample` is applied to the training folds only, so no synthetic row is scored
    and none is derived from a validation row. Result: `keep` columns plus one score
    column per model.
    """
    df = materialize(df, "folds")  # read once per fold and model
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    models: dict[str, list] = {name: [] for name in fitters}
    parts = []
    for i in folds:
        train, held = df.where(F.col(fold) != i), df.where(F.col(fold) == i)
        if oversample:
            train = materialize(oversample(train), "fold")
        for name, fit in fitters.items():
            model = fit(train)
            models[name].append(model)
            held = model.transform(held, name)
        parts.append(held.select(*keep, *fitters))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return OutOfFold(materialize(scores, "oof"), models)


def fit_meta(scores: DataFrame, names: list[str], label: str, kind: str = "logreg", **params):
    """Meta model on out-of-fold scores: logistic regression on scaled scores, or boosted trees."""
    if kind == "gbt":
        return fit_gbt(scores, names, label, **{"rounds": 200, "depth": 3, **params})
    return fit_logreg(scores, names, label, **{"C": 1.0, "balanced": False, **params})


def scale_scores(train: DataFrame, test: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    return standardize(train, test, names)


# Searched range (first, end, step) of the first three fusion weights, and bounds of the fourth.
WEIGHT_RANGES = [(0.2, 0.6, 0.05), (0.1, 0.5, 0.05), (0.1, 0.4, 0.05)]
LAST_WEIGHT = (0.05, 0.35)


def weight_candidates(ranges=WEIGHT_RANGES, last=LAST_WEIGHT) -> list[tuple[float, float, float, float]]:
    """Weight vectors that sum to one, in search order."""
    axes = [np.arange(*r) for r in ranges]
    grid = ((float(a), float(b), float(c), float(round(1.0 - a - b - c, 2))) for a in axes[0] for b in axes[1] for c in axes[2])
    return [w for w in grid if last[0] <= w[3] <= last[1]]


#: Steps of the fused score that rows are counted in, and rows that one task orders.
SCORE_STEPS, ORDERED_ROWS = 1024, 1_000_000
#: Rows whose cells travel together, and cells of the fused score for each row of the table.
BLOCK_ROWS, ROW_CELLS = 1 << 17, 256


def _fused(rows: pa.RecordBatch, names: list[str], label: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Component scores and labels of the rows that have all scores."""
    parts = [rows.column(n).to_numpy(zero_copy_only=False).astype(np.float64) for n in names]
    known = ~np.isnan(np.sum(parts, axis=0)) if len(rows) else np.zeros(0, bool)
    positive = np.array([v == 1 for v in rows.column(label).to_pylist()], dtype=bool)
    return [x[known] for x in parts], positive[known]


def _score(weights: tuple, parts: list[np.ndarray]) -> np.ndarray:
    out = 0.0
    for w, x in zip(weights, parts):
        out = out + w * x
    return out


def _packed(cells: np.ndarray, positive: np.ndarray) -> bytes:
    """Rising cells as the bytes of their differences, byte by byte, and a bit for each label."""
    gaps = np.diff(cells, prepend=cells[:1]).astype("<i8")
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8)
    planes = gaps.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return np.array([cells[0], len(cells), width], dtype="<i8").tobytes() + planes + np.packbits(positive).tobytes()


def _unpacked(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    first, n, width = np.frombuffer(data, "<i8", 3).tolist()
    raw = np.frombuffer(data, np.uint8, offset=24)
    gaps = np.zeros((n, 8), dtype=np.uint8)
    gaps[:, :width] = raw[: n * width].reshape(width, n).T
    return first + np.cumsum(gaps.view("<i8")[:, 0]), np.unpackbits(raw[n * width :], count=n) == 1


def weight_grid(
    df: DataFrame, names: list[str], label: str, candidates: list[tuple] | None = None, steps: int = SCORE_STEPS, ordered_rows: int = ORDERED_ROWS,
    block_rows: int = BLOCK_ROWS, row_cells: int = ROW_CELLS,
) -> DataFrame:
    """AUC of every weight vector: (weight_id, weights, auc_roc).

    A first pass counts the classes in equal steps of the fused score, for each weight
    vector: a bounded number of counts, whatever the rows. They settle all pairs of rows in
    different steps. Rows of steps that hold both classes are ordered in two more passes. First
    their cells travel, about `row_cells` equal parts of the score for each row of the table: sorted,
    as packed differences, some two bytes a row, one packet for each block of rows, weight
    vector and run of steps of at most `ordered_rows` rows (more only where one step holds them).
    They settle pairs in different cells. The few cells with both classes go back to the blocks
    that have them, whose rows there travel as exact scores with counts. Rows with a null score
    are left out; one class alone gives a null AUC.
    """
    spark = df.sparkSession
    candidates = [tuple(c) for c in candidates or weight_candidates()]
    rows = df.select(*names, label)
    span = rows.agg(*[f(F.when(~F.isnan(F.col(n).cast("double")), F.col(n).cast("double"))).alias(f"{k}{i}") for i, n in enumerate(names) for k, f in (("a", F.min), ("z", F.max))]).first()
    ends = [[span[f"{k}{i}"] or 0.0 for i in range(len(names))] for k in "az"]
    low = [sum(min(w * a, w * z) for w, a, z in zip(c, *ends)) for c in candidates]
    high = [sum(max(w * a, w * z) for w, a, z in zip(c, *ends)) for c in candidates]

    def step_of(i: int, score: np.ndarray) -> np.ndarray:
        # Rising with the score, so rows of a lower step have lower scores.
        return np.clip((score - low[i]) / max(high[i] - low[i], 1e-300) * steps, 0, steps - 1).astype(np.int64)

    def count(batches):
        held = np.zeros((len(candidates), 2 * steps), dtype=np.int64)
        for batch in batches:
            parts, positive = _fused(batch, names, label)
            for i, c in enumerate(candidates):
                held[i] += np.bincount(2 * step_of(i, _score(c, parts)) + positive, minlength=2 * steps)
        seen = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(held.reshape(-1)[seen])], names=["key", "n"])

    ship_package(spark)
    table = rows.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(candidates) * 2 * steps, dtype=np.int64)
    counts[table.column("key").to_numpy()] = table.column("n").to_numpy()
    neg, pos = np.moveaxis(counts.reshape(len(candidates), steps, 2), 2, 0)
    # Twice the pairs in the right order, as whole numbers of any size.
    doubled = [sum(int(p) * 2 * int(b) for p, b in zip(pos[i], np.cumsum(neg[i]) - neg[i]) if p) for i in range(len(candidates))]
    both = (pos > 0) & (neg > 0)
    run = np.cumsum(np.where(both, pos + neg, 0), axis=1) // ordered_rows

    # Cells cut steps by a power of two, so a row's cell lies in its step.
    finer = min(40, max(0, math.ceil(math.log2(max(1, row_cells * int((neg[0] + pos[0]).sum()) / steps)))))

    def cell_of(i: int, score: np.ndarray) -> np.ndarray:
        return np.clip((score - low[i]) / max(high[i] - low[i], 1e-300) * steps * (1 << finer), 0, (steps << finer) - 1).astype(np.int64)

    def cut(batches):
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            parts, positive = [np.concatenate(x) for x in zip(*[p for p, _ in held])], np.concatenate([y for _, y in held])
            values = ((task << 32) + number, np.stack(parts).tobytes(), positive.tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int64(), pa.binary(), pa.binary()))], names=["block", "x", "y"])

        for batch in batches:
            for at in range(0, len(batch), block_rows):
                held.append(_fused(batch.slice(at, block_rows), names, label))
                size += len(held[-1][1])
                if size >= block_rows:
                    yield block()
                    number, held, size = number + 1, [], 0
        if size:
            yield block()

    def parts_of(x: pa.Scalar, y: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(x.as_buffer(), np.float64).reshape(len(names), -1), np.frombuffer(y.as_buffer(), bool)

    def runs_of(i: int, cells: np.ndarray) -> list[tuple[int, int, int]]:
        """Run, start and end of each part of rising cells that lies in one run of steps."""
        runs = run[i][cells >> finer]
        cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), len(cells)]
        return [(int(runs[at]), at, end) for at, end in zip(cuts[:-1], cuts[1:])]

    def pack(batches):
        for batch in batches:
            for number, x, y in zip(*(batch.column(c) for c in ("block", "x", "y"))):
                parts, positive = parts_of(x, y)
                for i, c in enumerate(candidates):
                    cells = cell_of(i, _score(c, parts))
                    use = np.flatnonzero(both[i][cells >> finer])
                    if len(use):
                        use = use[np.argsort(cells[use])]
                        cells, told = cells[use], positive[use]
                        values = [(i, k, number.as_py(), _packed(cells[at:end], told[at:end])) for k, at, end in runs_of(i, cells)]
                        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*values), kinds)], names=["weight_id", "run", "block", "cells"])

    def before(group: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Sum of the n in front of each place in its group of neighbouring places."""
        first = np.flatnonzero(np.diff(group, prepend=-1))
        sums = np.cumsum(n) - n
        return sums - np.repeat(sums[first], np.diff(first, append=len(group)))

    def settle(packets: pa.Table) -> pa.Table:
        """Pairs of rows in different cells, and the cells that each block must tell more about."""
        i, k = (packets.column(c)[0].as_py() for c in ("weight_id", "run"))
        own = [_unpacked(v.as_buffer()) for v in packets.column("cells")]
        value, place = np.unique(np.concatenate([c for c, _ in own]), return_inverse=True)
        told = np.concatenate([y for _, y in own])
        p, n = (np.bincount(place[y], minlength=len(value)).astype(np.int64) for y in (told, ~told))
        pairs = int((p.astype(object) * 2 * before(value >> finer, n)).sum())
        mixed, ends = (p > 0) & (n > 0), np.cumsum([0, *[len(c) for c, _ in own]])
        rows = [(i, k, None, str(pairs), None)]
        for number, (cells, _), at, end in zip(packets.column("block").to_pylist(), own, ends[:-1], ends[1:]):
            asked = np.unique(cells[mixed[place[at:end]]])
            if len(asked):
                rows.append((i, k, number, None, asked.tobytes()))
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["weight_id", "run", "block", "pairs", "cells"])

    def tell(block: pa.Table, asked: pa.Table) -> pa.Table:
        """Exact scores of a block's rows in the cells asked for."""
        out = {c: [] for c in ("weight_id", "run", "score", "pos", "neg")}
        parts, positive = parts_of(block.column("x")[0], block.column("y")[0]) if len(block) else (None, None)
        asked = asked.sort_by("weight_id")
        scored = None
        for i, k, cells in zip(asked.column("weight_id").to_pylist(), asked.column("run").to_pylist(), asked.column("cells")):
            if scored is None or scored[0] != i:
                score = _score(candidates[i], parts)
                scored = i, score, cell_of(i, score)
            use = np.flatnonzero(np.isin(scored[2], np.frombuffer(cells.as_buffer(), np.int64)))
            value, place = np.unique(scored[1][use], return_inverse=True)
            sums = [np.bincount(place, weights=w, minlength=len(value)).astype(np.int64) for w in (positive[use], ~positive[use])]
            for c, v in zip(out, (i, k, value.tobytes(), sums[0].tobytes(), sums[1].tobytes())):
                out[c].append(v)
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    def order(packets: pa.Table) -> pa.Table:
        i = packets.column("weight_id")[0].as_py()
        get = lambda name, kind: np.concatenate([np.frombuffer(v.as_buffer(), dtype=kind) for v in packets.column(name)])
        score, p, n = get("score", np.float64), get("pos", np.int64), get("neg", np.int64)
        value, place = np.unique(score, return_inverse=True)
        p, n = (np.bincount(place, weights=x, minlength=len(value)).astype(np.int64) for x in (p, n))
        pairs = (p.astype(object) * (2 * before(cell_of(i, value), n) + n)).sum()
        return pa.table({"weight_id": pa.array([i], pa.int32()), "pairs": pa.array([str(int(pairs))])})

    blocks, blocks_path = write_stage(rows.mapInArrow(cut, "block long, x binary, y binary"), "blocks")
    packets = blocks.mapInArrow(pack, "weight_id int, run long, block long, cells binary")
    settled, settled_path = write_stage(packets.groupBy("weight_id", "run").applyInArrow(settle, "weight_id int, run long, block long, pairs string, cells binary"), "cells")
    asked = settled.where(F.col("block").isNotNull()).select("weight_id", "run", "block", "cells")
    exact = asked.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(lambda a, b: tell(b, a), "weight_id int, run long, score binary, pos binary, neg binary")
    inside = exact.groupBy("weight_id", "run").applyInArrow(order, "weight_id int, pairs string")
    found = settled.where(F.col("block").isNull()).select("weight_id", "pairs").unionByName(inside)
    for r in found.groupBy("weight_id").agg(F.sum(F.col("pairs").cast("decimal(38,0)")).alias("pairs")).collect():
        doubled[r.weight_id] += int(r.pairs)
    drop_stage(spark, blocks_path)
    drop_stage(spark, settled_path)
    out = []
    for i, c in enumerate(candidates):
        whole = int(pos[i].sum()) * int(neg[i].sum())
        out.append((i, doubled[i] / 2 / whole if whole else None, [float(w) for w in c]))
    return spark.createDataFrame(out, "weight_id int, auc_roc double, weights array<double>")


def best_weights(grid: DataFrame) -> DataFrame:
    """The first candidate with the highest AUC."""
    return grid.orderBy(F.col("auc_roc").desc(), "weight_id").limit(1)
