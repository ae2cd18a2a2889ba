"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last eight bytes sets the boundaries of chunks, each chunk gives one
character, and a fingerprint holds the signature at a block size fitting the text and at the
two next larger ones. Fingerprints are compared by edit distance at the finest block size
that both have.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.words import mix
from riskweave.session import ship_package

LONGEST = 64
SCALES = 3
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_ROLL = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)
_STEP = 0x01000193
_BACK = pow(_STEP, -1, 1 << 32)
_powers = {_STEP: np.ones(1, dtype=np.uint32), _BACK: np.ones(1, dtype=np.uint32)}


def _power(base: int, n: int) -> np.ndarray:
    held = _powers[base]
    while len(held) < n:
        held = np.concatenate([held, held * np.uint32(pow(base, len(held), 1 << 32))])
    _powers[base] = held
    return held[:n]


def _rolled(data: np.ndarray) -> np.ndarray:
    """Hash of the eight bytes up to each place, built from windows of one, two and four."""
    out = _ROLL[data]
    for i in (1, 2, 4):
        longer = out.copy()
        longer[i:] += out[:-i] * np.uint32(pow(0x9E3779B1, i, 1 << 32))
        out = longer
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x85EBCA6B)
    return out ^ (out >> np.uint32(13))


def fingerprint(data: bytes) -> str:
    """level:signature:signature:signature; a block of level k holds 2^k bytes on average.

    The level is the smallest at which fewer than 64 boundaries lie in the text, so every
    byte counts and a signature never has more than 64 characters.
    """
    if not data:
        return "0:::"
    data = np.frombuffer(data, dtype=np.uint8)
    rolled = _rolled(data)
    low = max(0, (len(data) // LONGEST).bit_length() - 3)
    while True:
        ends = np.flatnonzero((rolled & np.uint32((1 << low) - 1)) == 0)
        if low == 0 or len(ends) >= LONGEST:
            break
        low = max(0, low - 3)
    values = rolled[ends].astype(np.int64) | (1 << 32)
    levels = np.frexp((values & -values).astype(np.float64))[1] - 1
    level = low
    while (levels >= level).sum() >= LONGEST:
        level += 1
    weighted = (data.astype(np.uint32) + np.uint32(1)) * _power(_BACK, len(data))
    parts = []
    for k in range(level, level + SCALES):
        cuts = ends[levels >= k] + 1
        starts = np.concatenate([[0], cuts[cuts < len(data)]])
        chunks = np.add.reduceat(weighted, starts, dtype=np.uint32) * _power(_STEP, len(data))[starts]
        parts.append(LETTERS[mix(chunks.astype(np.uint64)) >> np.uint64(58)].tobytes().decode())
    return ":".join([str(level), *parts])


def likeness(frame: DataFrame, **pairs: tuple[str, str]) -> DataFrame:
    """`frame` with a column for each pair of fingerprint columns: 1 for equal signatures, 0 for
    texts without a common block size, else one minus the edit distance by the longer signature."""
    own = sorted({c for pair in pairs.values() for c in pair})
    out = frame.withColumns({f"_{c}": F.split(c, ":") for c in own})
    for name, (a, b) in pairs.items():
        a, b = f"_{a}", f"_{b}"
        la, lb = F.col(a)[0].cast("int"), F.col(b)[0].cast("int")
        level = F.greatest(la, lb)
        sides = F.get(F.col(a), level - la + 1), F.get(F.col(b), level - lb + 1)
        out = out.withColumns({f"{name}_a": F.when(level - la < SCALES, sides[0]), f"{name}_b": F.when(level - lb < SCALES, sides[1])})
        a, b = F.col(f"{name}_a"), F.col(f"{name}_b")
        longer = F.greatest(F.length(a), F.length(b))
        like = F.when(a == b, 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(1.0 - F.levenshtein(a, b) / longer)
        out = out.withColumn(name, like)
    return out.drop(*[f"_{c}" for c in own], *[f"{n}_{s}" for n in pairs for s in "ab"])


def with_next(docs: DataFrame, per_part: int = 4) -> DataFrame:
    """Rows (doc_id, text) placed so that each meets the next in descending doc_id.

    Parts are ranges of doc_id. The first row of a part is copied behind the end of the part
    before it, and the first row of all behind the last part, so texts are shuffled once and
    neighbours meet in one sorted stream. Columns: part, extra, doc_id, text.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / (n * per_part) for i in range(1, n * per_part)]
    cuts = sorted(set(docs.select("doc_id").dropna().approxQuantile("doc_id", shares, 0.2 / (n * per_part))), reverse=True)
    # Descending: part 0 has the largest ids, and rows without an id are the last part.
    edges = F.lit(",".join(str(int(c)) for c in cuts))
    above = F.filter(F.split(edges, ",").cast("array<bigint>"), lambda c: c > F.col("doc_id")) if cuts else F.array()
    part = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(F.size(above))
    tops = docs.select("doc_id", part.alias("part")).groupBy("part").agg(F.max("doc_id").alias("top")).orderBy("part").collect()
    goes = [(tops[i]["top"], tops[i - 1]["part"]) for i in range(len(tops))]
    # One row for each part.
    firsts = F.broadcast(spark.createDataFrame(goes, "top long, before int"))
    placed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), part.alias("own")).join(
        firsts, F.col("doc_id").eqNullSafe(F.col("top")), "left"
    )
    homes = F.array_compact(F.array(
        F.struct(F.col("own").alias("part"), F.lit(False).alias("extra")),
        F.when(F.col("before").isNotNull(), F.struct(F.col("before").alias("part"), F.lit(True).alias("extra"))),
    ))
    placed = placed.select("doc_id", "text", F.explode(homes).alias("home")).select("home.part", "home.extra", "doc_id", "text")
    return placed.repartition(n, "part").sortWithinPartitions("part", "extra", F.desc_nulls_last("doc_id"), F.desc("text"))


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string"


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of each text; of its edited form whose last half is replaced by
    the start of the next document (edited_sha256, edited_fingerprint); and next_fingerprint.

    Null text counts as empty. Documents follow in descending doc_id, rows without an id come
    last, repeated ids by text; after the last comes the first, a single document after itself.
    """

    def run(batches):
        # The row that waits for the next: part, doc_id, text, fingerprint.
        wait, done = None, []

        def finish(text, code):
            _, key, own, first = wait
            half = len(own) // 2
            edited = (own[: len(own) - half] + text[:half]).encode()
            done.append((key, len(own), hashlib.sha256(edited).hexdigest(), first, fingerprint(edited), code))

        def table():
            rows = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), *[pa.string()] * 4))],
                names=[c.split()[0] for c in OUT.split(", ")],
            )
            done.clear()
            return rows

        for batch in batches:
            for row in range(batch.num_rows):
                part, extra, key, text = (c[row].as_py() for c in batch.columns)
                if extra and (wait is None or wait[0] != part):
                    continue  # the part has met its first follower already
                code = fingerprint(text.encode())
                if wait is not None:
                    finish(text, code)
                wait = None if extra else (part, key, text, code)
                if len(done) >= 1000:
                    yield table()
        if done:
            yield table()

    ship_package(docs.sparkSession)
    return with_next(docs.select("doc_id", "text")).mapInArrow(run, OUT)


def edit_report(docs: DataFrame) -> DataFrame:
    """`fingerprints` with near_edited and near_next, the likeness to the edited text and to the next document."""
    found = likeness(fingerprints(docs), near_edited=("fingerprint", "edited_fingerprint"), near_next=("fingerprint", "next_fingerprint"))
    return found.drop("next_fingerprint")
