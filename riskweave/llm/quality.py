"""Quality classifier: a linear support vector machine on naive Bayes features.

Features are indicators of hashed n-grams: of words, and of word shapes (case, digits, signs,
last byte, repetition of the word before). They are scaled by the log-count ratio of the two
classes (Wang and Manning, 2012); the hinge-loss model is fitted by dual coordinate descent
(Hsieh et al., 2008), and margins become probabilities by a logistic curve.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fold
from riskweave.llm.labelled import platt, sample
from riskweave.llm.words import WHITE, mix, text_slices, word_hashes
from riskweave.session import materialize, ship_package

SLICE = 1 << 20
#: Bits: lower case, upper case, digit, sign, byte of a character outside ASCII.
_KIND = np.full(256, 8, dtype=np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 4, 16
_KIND[WHITE] = 0
#: Last bytes tell words apart only where they are signs.
_LAST = np.where(_KIND == 8, np.arange(256), 0).astype(np.uint64)


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of the n-grams of each row, ordered by row."""
    hashes, counts = word_hashes(data, offsets)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(hashes):
        return row, row
    white = WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(~white & (np.concatenate([[True], white[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(~white & (np.concatenate([white[1:], [True]]) | edge[1:]))
    kind = np.bitwise_or.reduceat(_KIND[data], starts).astype(np.uint64)
    first_upper = (_KIND[data[starts]] == 2).astype(np.uint64)
    again = np.zeros(len(hashes), dtype=np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    shape = mix((kind << np.uint64(16)) | (first_upper << np.uint64(12)) | (again << np.uint64(11)) | _LAST[data[ends]])
    grams, owner = [], []
    for tag, base, longest in ((1, hashes, 2), (2, shape, 3)):
        gram = base
        for n in range(1, longest + 1):
            if n > 1:
                gram = mix(gram[:-1] * np.uint64(0xD6E8FEB86659FD93) + base[n - 1 :])
            same = row[: len(gram)] == row[n - 1 :]
            grams.append(mix(gram[same] + np.uint64(16 * tag + n)) >> np.uint64(64 - bits))
            owner.append(row[n - 1 :][same])
    both = np.unique((np.concatenate(owner).astype(np.uint64) << np.uint64(bits)) | np.concatenate(grams))
    return (both >> np.uint64(bits)).astype(np.int64), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def log_ratios(rows: list[np.ndarray], y: np.ndarray, size: int, alpha: float = 1.0) -> np.ndarray:
    """log of the normalised counts of each feature in class 1 by those in class 0."""
    sums = []
    for c in (1, 0):
        own = [r for r, label in zip(rows, y) if label == c]
        sums.append(alpha + np.bincount(np.concatenate(own) if own else np.zeros(0, np.int64), minlength=size))
    return np.log(sums[0] / sums[0].sum()) - np.log(sums[1] / sums[1].sum())


def dual_descent(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, cost: float, rounds: int = 30, close: float = 1e-3, seed: int = 1) -> np.ndarray:
    """Weights of the hinge-loss model; the last weight is the intercept.

    Each step solves for the dual variable of one row exactly, in random order, until the
    largest projected gradient of a round is under `close`.
    """
    sign = np.where(y == 1, 1.0, -1.0)
    # Rows are scaled to length one, so the cost means the same for short and long texts.
    scaled = [values[r] / max(np.sqrt((values[r] ** 2).sum()), 1e-9) for r in rows]
    norm = np.array([(v**2).sum() + 1.0 for v in scaled])
    dual, w, draw = np.zeros(len(rows)), np.zeros(len(values) + 1), np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in draw.permutation(len(rows)):
            at, v = rows[i], scaled[i]
            slope = sign[i] * (w[at] @ v + w[-1]) - 1
            moved = min(max(dual[i] - slope / norm[i], 0.0), cost)
            worst = max(worst, abs(moved - dual[i]) * norm[i])
            if moved != dual[i]:
                step = (moved - dual[i]) * sign[i]
                w[at] += step * v
                w[-1] += step
                dual[i] = moved
        if worst < close:
            break
    return w


class Model:
    """Weights over features and the curve from margin to probability; bounded by `bits`."""

    def __init__(self, bits: int, ratio: np.ndarray, weights: np.ndarray, curve: tuple[float, float]):
        self.bits, self.curve, self.bias = bits, curve, float(weights[-1])
        self.push, self.square = (weights[:-1] * ratio), ratio**2

    def margins(self, owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """Of n rows with the given (row, feature) pairs."""
        size = np.sqrt(np.bincount(owner, self.square[found], minlength=n))
        return np.bincount(owner, self.push[found], minlength=n) / np.maximum(size, 1e-9) + self.bias

    def scores(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * margins + self.curve[1], -500, 500)))


def fit_rows(rows: list[np.ndarray], y: np.ndarray, bits: int, cost: float) -> Model:
    """Without rows of both classes all texts get the share of class 1 (one half without rows)."""
    none = np.zeros((1 << bits) + 1)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(bits, none[:-1], none, (0.0, float(np.log(share / (1 - share)))))

    def train(use):
        part, own = [rows[i] for i in use], y[use]
        ratio = log_ratios(part, own, 1 << bits)
        return Model(bits, ratio, dual_descent(part, ratio, own, cost), (1.0, 0.0))

    # The curve is fitted to margins of rows that the model had not seen.
    turn, margin = np.arange(len(rows)) % 5, np.zeros(len(rows))
    for k in range(5):
        use, rest = np.flatnonzero(turn != k), np.flatnonzero(turn == k)
        if len(set(y[use].tolist())) == 2 and len(rest):
            owner = np.repeat(np.arange(len(rest)), [len(rows[i]) for i in rest])
            margin[rest] = train(use).margins(owner, np.concatenate([rows[i] for i in rest]), len(rest))
    model = train(np.arange(len(rows)))
    model.curve = platt(margin, y)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, held: int = 0, most: int = 6_000,
        bits: int = 17, cost: float = 1.0) -> Model:
    """Learn from at most `most` labelled rows; see `labelled.sample`. Their features, not their texts, come to the driver."""

    def run(batches):
        for rows, data, offsets in text_slices(batches, SLICE):
            owner, found = features(data, offsets, bits)
            cuts = np.searchsorted(owner, np.arange(len(offsets)))
            found = found.astype("<i4")
            blobs = [found[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([rows.column("y"), pa.array(blobs, pa.binary())], names=["y", "found"])

    ship_package(docs.sparkSession)
    chosen = materialize(sample(docs, labels, label, parts, held, most).select("y", "text").mapInArrow(run, "y int, found binary"), "quality-fit")
    got = sorted((r["y"], bytes(r["found"])) for r in chosen.toLocalIterator())
    order = np.random.default_rng(0).permutation(len(got))
    rows = [np.frombuffer(got[i][1], dtype="<i4").astype(np.int32) for i in order]
    return fit_rows(rows, np.array([got[i][0] for i in order], dtype=np.int64), bits, cost)


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns `keep` and score, the probability of class 1, of every row's `text`."""
    kept = docs.select(*keep, "text")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept.schema if f.name != "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for rows, data, offsets in text_slices(batches, SLICE):
            owner, found = features(data, offsets, model.bits)
            own = model.scores(model.margins(owner, found, len(offsets) - 1))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], pa.array(own)], names=[*keep, "score"])

    ship_package(docs.sparkSession)
    return kept.mapInArrow(run, f"{schema}score double")


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", parts: int = 5, held: int = 0, least: float = 0.3, **how) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`.

    Null text counts as empty, which has a score of its own; null ids fall into fold 0.
    Repeated rows are scored alike.
    """
    model = fit(docs, labels, label, parts, held, **how)
    own = docs.select("doc_id", "text", (fold(F.col("doc_id"), parts) == held).alias("held_out"))
    return score(own, model, "doc_id", "held_out").withColumn("predicted", (F.col("score") >= least).cast("int"))
