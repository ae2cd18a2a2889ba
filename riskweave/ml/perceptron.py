"""Multilayer perceptron with rectified units, trained by Adam on batches of rows.

Rows lie in written blocks. For each step the tasks sum the gradients of their rows of the
batch; the sums are added up in three levels, in a fixed order, so what reaches the driver is
one vector as long as the parameters, whatever the number of tasks. The driver holds
parameters and Adam's two moments, which do not grow with the rows. A lost task repeats its
own sum and nothing else.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.hashing import hash_order
from riskweave.ml.trees import matrix
from riskweave.session import drop_stage, ship_package, write_stage

PRIME = 2147483647


def shapes(sizes: list[int]) -> list[tuple[int, int]]:
    return list(zip(sizes[:-1], sizes[1:]))


def initial(sizes: list[int], seed: int) -> np.ndarray:
    """Weights and biases, layer by layer, drawn evenly within the bound of Glorot and Bengio."""
    rng, parts = np.random.default_rng(seed), []
    for a, b in shapes(sizes):
        bound = math.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def layers(parameters: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in shapes(sizes):
        out.append((parameters[at : at + a * b].reshape(a, b), parameters[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(parameters: np.ndarray, sizes: list[int], x: np.ndarray) -> list[np.ndarray]:
    """Outputs of all layers; the last one is the log odds."""
    out = [x]
    for i, (w, b) in enumerate(layers(parameters, sizes)):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0.0) if i + 2 < len(sizes) else z)
    return out


def probability(z: np.ndarray) -> np.ndarray:
    return np.where(z >= 0, 1.0 / (1.0 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1.0 + np.exp(-np.abs(z))))


def loss_gradient(parameters: np.ndarray, sizes: list[int], x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Sum of the logistic loss over the rows, and its gradient."""
    out = forward(parameters, sizes, x)
    z = out[-1][:, 0]
    loss = float(np.sum(np.logaddexp(0.0, z) - y * z))
    delta, parts = (probability(z) - y)[:, None], []
    for i in range(len(sizes) - 2, -1, -1):
        w, _ = layers(parameters, sizes)[i]
        parts += [delta.sum(axis=0), (out[i].T @ delta).ravel()]
        if i:
            delta = (delta @ w.T) * (out[i] > 0)
    return loss, np.concatenate(parts[::-1])


class Adam:
    """Steps along a running mean of gradients, scaled by that of their squares (Kingma and Ba, 2015)."""

    def __init__(self, n: int, rate: float, beta1: float = 0.9, beta2: float = 0.999, small: float = 1e-8):
        self.m, self.v, self.t = np.zeros(n), np.zeros(n), 0
        self.rate, self.beta1, self.beta2, self.small = rate, beta1, beta2, small

    def step(self, parameters: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = self.beta1 * self.m + (1 - self.beta1) * gradient
        self.v = self.beta2 * self.v + (1 - self.beta2) * gradient**2
        scale = self.rate * math.sqrt(1 - self.beta2**self.t) / (1 - self.beta1**self.t)
        return parameters - scale * self.m / (np.sqrt(self.v) + self.small)


def weight_mask(sizes: list[int]) -> np.ndarray:
    """1 for weights, which the penalty shrinks, 0 for biases."""
    return np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in shapes(sizes)])


def batch_of(row: np.ndarray, epoch: int, batches: int) -> np.ndarray:
    """Batch of each row in an epoch: dealt anew each time by the row's own number in [1, PRIME)."""
    return row * (1 + (48271 * (epoch + 1)) % (PRIME - 1)) % PRIME * batches // PRIME


@dataclass
class Perceptron:
    parameters: np.ndarray
    sizes: list[int]
    features: list[str]
    history: list[float]

    def transform(self, df: DataFrame, out: str = "score") -> DataFrame:
        parameters, sizes = self.parameters, self.sizes

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            return pd.Series(probability(forward(parameters, sizes, matrix(columns))[-1][:, 0]))

        ship_package(df.sparkSession)
        return df.withColumn(out, score(*[F.col(c).cast("double") for c in self.features]))


def _blocks(df: DataFrame, features: list[str], label: str, key: str, validation: float) -> tuple[DataFrame, str]:
    digits = lambda seed: F.conv(F.substring(hash_order(key, seed=seed), 1, 8), 16, 10).cast("long")
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(features)]
    held = (digits(11) < int(validation * (1 << 32))).cast("int")
    numbered = df.select(*columns, (digits(13) % (PRIME - 1) + 1).alias("row"), F.col(label).cast("double").alias("y"), held.alias("held"))

    def run(batches):
        for rows in batches:
            if len(rows):
                get = lambda c: rows.column(c).to_numpy(zero_copy_only=False)
                x = np.column_stack([get(f"x{i}") for i in range(len(features))])
                values = x.tobytes(), get("row").tobytes(), get("y").tobytes(), get("held").astype(np.int8).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], names=["x", "row", "y", "held"])

    ship_package(df.sparkSession)
    return write_stage(numbered.mapInArrow(run, "x binary, row binary, y binary, held binary"), "rows")


def _add(packets: pa.Table) -> pa.Table:
    """One packet from several, their gradients added in the order of tasks."""
    packets = packets.sort_by("task")
    total = np.sum([np.frombuffer(g.as_buffer(), np.float64) for g in packets.column("gradient")], axis=0)
    values = [packets.column("part")[0].as_py(), packets.column("task")[0].as_py(), total.tobytes(), *[sum(packets.column(c).to_pylist()) for c in NAMES[3:]]]
    return pa.table({c: pa.array([v], t) for c, v, t in zip(NAMES, values, KINDS)})


def _added(packets: DataFrame, groups: int) -> DataFrame:
    """At most one packet: the sum of the parts, each the sum of its tasks.

    A part's packet has its lowest task, which is its number, so parts are added in order too.
    """
    parts = packets.groupBy("part").applyInArrow(_add, SCHEMA)
    if groups == 1:
        return parts
    return parts.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInArrow(_add, SCHEMA)


def fit_perceptron(
    train: DataFrame, features: list[str], label: str, key: str, hidden: tuple = (256, 128, 64), alpha: float = 0.001, rate: float = 0.001,
    batch: int = 512, most_steps: int = 64, epochs: int = 100, patience: int = 10, tolerance: float = 1e-4, validation: float = 0.1, seed: int = 42,
) -> Perceptron:
    """A perceptron with one logistic output.

    A batch holds about `batch` rows; beyond `most_steps` batches an epoch it grows instead,
    as every step is a pass. `validation` of the rows, chosen by a hash of `key`, is kept
    back: training ends when their accuracy has not risen by `tolerance` for `patience` epochs,
    and the parameters of the best epoch are the model. Null features count as 0, rows without a
    label are left out; without rows the model keeps its initial parameters.
    """
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    sizes = [len(features), *hidden, 1]
    written, path = _blocks(train, features, label, key, validation)
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    blocks = own.read.schema(written.schema).parquet(path)
    tasks = max(1, blocks.rdd.getNumPartitions())
    groups = math.isqrt(tasks - 1) + 1
    own.conf.set("spark.sql.shuffle.partitions", str(groups))
    n = train.count()
    batches = max(1, min(most_steps, round(n * (1 - validation) / batch)))
    width, mask = len(features), weight_mask(sizes)

    def summed(parameters: np.ndarray, epoch: int, number: int) -> tuple[np.ndarray, float, int, int, int]:
        """Gradient and loss over a batch, its rows, and of the validation rows all and those told right."""

        def run(parts):
            total, loss, rows, seen, right = np.zeros(len(parameters)), 0.0, 0, 0, 0
            for part in parts:
                for x, row, y, held in zip(*(part.column(c) for c in ("x", "row", "y", "held"))):
                    x, y = np.frombuffer(x.as_buffer(), np.float64).reshape(-1, width), np.frombuffer(y.as_buffer(), np.float64)
                    held = np.frombuffer(held.as_buffer(), np.int8) == 1
                    use = ~held & (batch_of(np.frombuffer(row.as_buffer(), np.int64), epoch, batches) == number)
                    if use.any():
                        some, gradient = loss_gradient(parameters, sizes, x[use], y[use])
                        total, loss, rows = total + gradient, loss + some, rows + int(use.sum())
                    if number == 0 and held.any():
                        z = forward(parameters, sizes, x[held])[-1][:, 0]
                        seen, right = seen + int(held.sum()), right + int(((z > 0) == (y[held] == 1)).sum())
            task = TaskContext.get().partitionId()
            values = (task % groups, task, total.tobytes(), loss, rows, seen, right)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, KINDS)], names=NAMES)

        got = _added(blocks.mapInArrow(run, SCHEMA), groups).toArrow()
        gradient = np.frombuffer(got.column("gradient")[0].as_buffer(), np.float64) if len(got) else np.zeros(len(parameters))
        return gradient, *[sum(got.column(c).to_pylist()) for c in NAMES[3:]]

    parameters = initial(sizes, seed)
    adam, best, best_score, stale, history = Adam(len(parameters), rate), parameters, -math.inf, 0, []
    for epoch in range(epochs + 1 if n else 0):
        for number in range(batches):
            gradient, _, rows, seen, right = summed(parameters, epoch, number)
            if number == 0 and epoch and seen:
                # Counted in this pass: the accuracy after the epoch before.
                history.append(right / seen)
                stale = stale + 1 if history[-1] < best_score + tolerance else 0
                if history[-1] > best_score:
                    best_score, best = history[-1], parameters
            if epoch == epochs or stale >= patience:
                break
            if rows:
                parameters = adam.step(parameters, (gradient + alpha * mask * parameters) / rows)
        if stale >= patience:
            break
    drop_stage(spark, path)
    return Perceptron(best if history else parameters, sizes, features, history)


NAMES = ["part", "task", "gradient", "loss", "rows", "seen", "told"]
KINDS = (pa.int64(), pa.int64(), pa.binary(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
SCHEMA = "part long, task long, gradient binary, loss double, rows long, seen long, told long"
