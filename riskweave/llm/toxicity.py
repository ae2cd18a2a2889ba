"""Toxicity by compression distance.

Two zstandard dictionaries are made, one of what toxic texts say and other texts do not, one
of ordinary text. Each window of a text is compressed with either; a window that the toxic
dictionary shortens much more is a sign of toxicity. The margin is calibrated on labelled
texts.

A frame has fixed costs of about the size of a word, and below them nothing is compressed.
Each window therefore follows an anchor, a fixed run of bytes that ends both dictionaries:
the anchor pays the fixed costs, and what is left is the cost of the window itself.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fold, map_texts
from riskweave.llm.labelled import sample
from riskweave.session import materialize

WORD = re.compile(r"\w+")
ANCHOR = bytes(range(128, 176))
LEVEL = 3


def windows(text: str) -> set[str]:
    """The distinct windows of a text: its words, so that no window is cut within one."""
    return set(WORD.findall(text.lower()))


class Gauge:
    """Bytes that the toxic dictionary saves on a window, as a share of the window's bytes."""

    def __init__(self, ordinary: bytes, toxic: bytes, kept: int = 400_000):
        import zstandard

        self.known, self.kept = {}, kept
        self.compressors = []
        for content in (ordinary, toxic):
            data = zstandard.ZstdCompressionDict(content + ANCHOR, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            ))

    def share(self, window: str) -> float:
        if window not in self.known:
            if len(self.known) >= self.kept:
                self.known.clear()
            data = window.encode("utf-8", "replace")
            plain, toxic = (len(c.compress(ANCHOR + b" " + data + b" ")) for c in self.compressors)
            self.known[window] = max(0.0, (plain - toxic) / len(data))
        return self.known[window]

    def largest(self, text: str) -> float:
        return max(map(self.share, windows(text)), default=0.0)


def one_of_each_family(chosen: DataFrame, keys: int = 3) -> DataFrame:
    """Of texts of one class that share the least hash of their three-word shingles, under any of
    `keys` hash functions, one is left, so a text copied many times is one witness."""

    def make():
        from xxhash import xxh64_intdigest

        def step(rows, texts):
            least = [[] for _ in range(keys)]
            for text in texts:
                words = text.lower().split()
                shingles = [" ".join(words[i : i + 3]).encode("utf-8", "replace") for i in range(max(1, len(words) - 2))]
                for k, own in enumerate(least):
                    own.append(min(xxh64_intdigest(s, k) for s in shingles) >> 1)
            kept = [rows.column("y"), pa.array(texts, pa.string()), *[pa.array(v, pa.int64()) for v in least]]
            return pa.RecordBatch.from_arrays(kept, names=["y", "text", *[f"k{i}" for i in range(keys)]])

        return step

    out = map_texts(chosen.select("y", "text"), make, ", ".join(["y int, text string", *[f"k{i} long" for i in range(keys)]]))
    for i in range(keys):
        out = out.dropDuplicates(["y", f"k{i}"])
    return out.select("y", "text")


def count_windows(chosen: DataFrame) -> DataFrame:
    """window, toxic, ordinary: the number of texts of each class that hold it."""

    def make():
        def step(rows, texts):
            counts = (Counter(), Counter())
            for y, text in zip(rows.column("y").to_pylist(), texts):
                counts[y].update(windows(text))
            names = list(counts[0].keys() | counts[1].keys())
            own = [pa.array([c[w] for w in names], pa.int64()) for c in counts]
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), own[1], own[0]], names=["window", "toxic", "ordinary"])

        return step

    counted = map_texts(chosen.select("y", "text"), make, "window string, toxic long, ordinary long")
    return counted.groupBy("window").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def dictionaries(chosen: DataFrame, ordinary_windows: int = 2_000, toxic_windows: int = 3_000, share: float = 0.01, times: float = 12.0) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary from labelled texts (y, text).

    The ordinary one has the windows most frequent in ordinary texts. The toxic one has
    windows in at least `share` of the toxic texts, three at least, and `times` as frequent
    there as in ordinary ones. What is most frequent comes last, where zstandard reaches it
    at the least cost. Both sizes are bounded by these numbers.
    """
    n = {r["y"]: r["n"] for r in chosen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, plain = n.get(1, 0), n.get(0, 0)
    counted = materialize(count_windows(chosen), "toxicity-windows")
    often = counted.where("ordinary > 0").orderBy(F.desc("ordinary"), "window").limit(ordinary_windows)
    rate = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("ordinary") + 0.5) / (plain + 1))
    marked = counted.where((F.col("toxic") >= max(3, share * toxic)) & (rate >= times)).orderBy(F.desc("toxic"), "window").limit(toxic_windows)
    return tuple(f" {' '.join(r['window'] for r in reversed(part.collect()))} ".encode() for part in (often, marked))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds and the probability from each on: the isotonic fit, with one virtual text of
    either class in each step drawn towards the overall share."""
    base = (y.sum() + 1) / (len(y) + 2)
    steps = []
    for value in np.unique(x):
        own = y[x == value]
        steps.append([value, float(own.sum()) + base, len(own) + 1.0])
        while len(steps) > 1 and steps[-2][1] / steps[-2][2] >= steps[-1][1] / steps[-1][2]:
            _, hits, size = steps.pop()
            steps[-1][1] += hits
            steps[-1][2] += size
    if not steps:
        steps = [[0.0, base, 1.0]]
    return np.array([s[0] for s in steps]), np.array([s[1] / s[2] for s in steps])


class Model:
    """Two dictionaries and a calibrated curve; its size is bounded by the dictionaries."""

    def __init__(self, ordinary: bytes, toxic: bytes, cuts: np.ndarray, levels: np.ndarray):
        self.ordinary, self.toxic, self.cuts, self.levels = ordinary, toxic, cuts, levels

    def scores(self, x: np.ndarray) -> np.ndarray:
        return self.levels[np.maximum(np.searchsorted(self.cuts, x, side="right") - 1, 0)]


def distances(docs: DataFrame, ordinary: bytes, toxic: bytes, *keep: str) -> DataFrame:
    """Columns `keep` and distance: the largest share saved on a window of `text` (none: 0)."""
    kept = docs.select(*keep, "text")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept.schema if f.name != "text")

    def make():
        gauge = _gauge(ordinary, toxic)

        def step(rows, texts):
            own = pa.array([gauge.largest(t) for t in texts], pa.float64())
            return pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], own], names=[*keep, "distance"])

        return step

    return map_texts(kept, make, f"{schema}distance double")


_gauges: dict[tuple[bytes, bytes], Gauge] = {}


def _gauge(ordinary: bytes, toxic: bytes) -> Gauge:
    """Kept over the tasks of a Python worker."""
    if (ordinary, toxic) not in _gauges:
        _gauges.clear()
        _gauges[ordinary, toxic] = Gauge(ordinary, toxic)
    return _gauges[ordinary, toxic]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held: int = 2, most: int = 20_000) -> Model:
    """Learn from at most `most` labelled rows; see `labelled.sample`. Without labels all texts
    get one half; without toxic ones all get a low score."""
    chosen = materialize(sample(docs, labels, label, parts, held, most), "toxicity-fit")
    ordinary, toxic = dictionaries(materialize(one_of_each_family(chosen), "toxicity-families"))
    told = distances(chosen, ordinary, toxic, "y").collect()
    x, y = np.array([r["distance"] for r in told]), np.array([r["y"] for r in told])
    return Model(ordinary, toxic, *calibrate(x, y))


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held: int = 2, least: float = 0.3, **how) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`.

    Null text counts as empty: it has no window and the score of distance 0. A null id counts
    as empty text for its fold. Repeated rows are scored alike.
    """
    model = fit(docs, labels, label, parts, held, **how)
    own = docs.select("doc_id", "text", (fold(F.col("doc_id"), parts) == held).alias("held_out"))
    told = distances(own, model.ordinary, model.toxic, "doc_id", "held_out")
    cuts = list(zip(model.cuts.tolist(), model.levels.tolist()))
    score = F.lit(cuts[0][1])
    for cut, level in cuts[1:]:
        score = F.when(F.col("distance") >= cut, F.lit(level)).otherwise(score)
    return told.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= least).cast("int"))
