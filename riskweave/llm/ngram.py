"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and scored from sorted arrays.

Words are 64-bit hashes. Counting tasks count the n-grams of a few million tokens at a time
and send sorted blocks of them to buckets; a bucket adds its blocks up and writes sorted
arrays of n-grams and of contexts to the shared folder. The continuation counts of the next
lower order come from the distinct n-grams of a bucket and go the same way. Scoring tasks
map the arrays into memory and look up sorted queries.

A bucket holds whole contexts, apart from contexts made of frequent words alone: their
n-grams are spread over all buckets, and only the sums of such a context, a number bounded
by the number of buckets, are added up at the end.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import fold
from riskweave.llm.words import BEGIN, mix, text_slices, token_stream, word_hashes
from riskweave.session import materialize, ship_package, stage_path

BLOCK = "bucket int, words binary, counts binary"
FOUND = "kind string, bucket int, words binary, counts binary, stats array<long>"
SLICE = 1 << 22


def mounted(path: str) -> str:
    """The shared folder as every machine mounts it; arrays can only be mapped from there."""
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError("memory-mapped arrays need spark.checkpoint.dir to be a mounted folder")
    return url.path


def write_array(path: str, values: np.ndarray) -> None:
    """A repeated or concurrent attempt of a task writes the same file; the last one stays."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        np.save(f, values)
    os.replace(own, path)


_open: dict[str, np.ndarray] = {}


def read_array(path: str) -> np.ndarray | None:
    if path not in _open:
        _open[path] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
    return _open[path]


def context_hash(words: np.ndarray) -> np.ndarray:
    """Hash of the columns of `words` (rows x m) in order; one column stands for itself."""
    out = words[:, 0]
    for i in range(1, words.shape[1]):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words[:, i])
    return out


def gram_hash(words: np.ndarray) -> np.ndarray:
    return mix(context_hash(words) + np.uint64(words.shape[1]))


def bucket_of(contexts: np.ndarray, grams: np.ndarray, spread: np.ndarray, bits: int) -> np.ndarray:
    """Top bits of the context, or of the n-gram where the context is spread."""
    shift = np.uint64(64 - bits)
    return (np.where(spread, grams, mix(contexts)) >> shift).astype(np.int64) if bits else np.zeros(len(grams), np.int64)


def frequent(words: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Rows whose words are all among the sorted `hot` words."""
    at = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
    return (hot[at] == words).all(axis=1)


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where each first stands, and the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _blocks(words: np.ndarray, counts: np.ndarray, buckets: np.ndarray):
    """Rows bucket, words, counts; within a bucket ordered by first word, so equal bytes lie together."""
    order = np.lexsort((words[:, 0], buckets))
    words, counts, buckets = words[order], counts[order], buckets[order]
    cuts = np.flatnonzero(np.concatenate([[True], buckets[1:] != buckets[:-1], [True]])) if len(buckets) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(buckets[a]), np.ascontiguousarray(words[a:b].T).tobytes(), counts[a:b].astype("<u4").tobytes()


def _table(rows: list, schema: str = BLOCK) -> pa.RecordBatch:
    kinds = {"kind": pa.string(), "bucket": pa.int32(), "words": pa.binary(), "counts": pa.binary(), "stats": pa.list_(pa.int64())}
    names = [c.split()[0] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[n]) for i, n in enumerate(names)], names=names)


def _gathered(table: pa.Table, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Words (rows x order) and counts of all blocks of a bucket."""
    words = [np.frombuffer(w, dtype="<u8").reshape(order, -1).T for w in table.column("words").to_pylist()]
    counts = [np.frombuffer(c, dtype="<u4") for c in table.column("counts").to_pylist()]
    return np.concatenate(words), np.concatenate(counts).astype(np.int64)


def _count_blocks(docs: DataFrame, order: int, bits: int, hot: np.ndarray, gathered: int = 1_000_000) -> DataFrame:
    """Blocks of the n-grams of `text`, counted over about `gathered` tokens at a time."""

    def run(batches):
        held, size = [], 0

        def flush():
            words = np.concatenate(held)
            grams = gram_hash(words)
            grams, at, counts = _summed(grams, np.ones(len(grams), dtype=np.int64))
            words = words[at]
            if order > 1:
                buckets = bucket_of(context_hash(words[:, :-1]), grams, frequent(words[:, :-1], hot), bits)
            else:
                buckets = bucket_of(words[:, 0], grams, np.zeros(len(words), dtype=bool), bits)
            return _table(list(_blocks(words, counts, buckets)))

        for _, data, offsets in text_slices(batches, SLICE):
            tokens, begins = token_stream(*word_hashes(data, offsets), pad=order - 1)
            last = np.ones(len(tokens), dtype=bool)
            for i in range(order - 1):
                last[begins[:-1] + i] = False
            last = np.flatnonzero(last)
            for a in range(0, len(last), gathered):
                place = last[a : a + gathered]
                held.append(np.stack([tokens[place - i] for i in range(order - 1, -1, -1)], axis=1))
                size += len(place)
                if size >= gathered:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    ship_package(docs.sparkSession)
    return docs.select("text").mapInArrow(run, BLOCK)


def _number_counts(counts: np.ndarray) -> list[int]:
    """How many n-grams occur once, twice, three and four times."""
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def _sum_words(blocks: DataFrame, root: str, share: int) -> DataFrame:
    """Word counts of each bucket as arrays; rows kind=total (tokens, distinct) and kind=frequent.

    A word with over 1/`share` of all tokens has over 1/`share` of its bucket's.
    """

    def run(table: pa.Table) -> pa.Table:
        words, counts = _gathered(table, 1)
        bucket = table.column("bucket")[0].as_py()
        keys, _, counts = _summed(words[:, 0], counts)
        write_array(f"{root}/words/{bucket}.npy", keys)
        write_array(f"{root}/words/{bucket}-n.npy", counts)
        total = int(counts.sum())
        rows = [("total", bucket, None, None, [total, len(keys)])]
        often = counts * share >= total
        rows += [("frequent", bucket, k.tobytes(), None, [int(c)]) for k, c in zip(keys[often], counts[often])]
        return pa.Table.from_batches([_table(rows, FOUND)])

    return blocks.groupBy("bucket").applyInArrow(run, FOUND)


def _sum_grams(blocks: DataFrame, root: str, order: int, bits: int, hot: np.ndarray) -> DataFrame:
    """N-grams and contexts of each bucket as arrays; rows kind=numbers, kind=context (sums of
    spread contexts) and kind=lower (blocks of the next lower order)."""

    def run(table: pa.Table) -> pa.Table:
        words, counts = _gathered(table, order)
        bucket = table.column("bucket")[0].as_py()
        grams, at, counts = _summed(gram_hash(words), counts)
        words = words[at]
        write_array(f"{root}/grams{order}/{bucket}.npy", grams)
        write_array(f"{root}/grams{order}/{bucket}-n.npy", counts.astype(np.uint32))
        rows = [("numbers", bucket, None, None, _number_counts(counts))]
        parts = np.stack([counts, counts == 1, counts == 2, counts >= 3], axis=1).astype(np.int64)
        keys, first, sums = _summed(context_hash(words[:, :-1]), parts)
        spread = frequent(words[first, :-1], hot)
        write_array(f"{root}/contexts{order}/{bucket}.npy", keys[~spread])
        write_array(f"{root}/contexts{order}/{bucket}-n.npy", sums[~spread].astype(np.uint32))
        rows += [("context", bucket, k.tobytes(), None, s.tolist()) for k, s in zip(keys[spread], sums[spread])]
        rest = words[:, 1:]
        lower, first, kinds = _summed(gram_hash(rest), np.ones(len(rest), dtype=np.int64))
        rest = rest[first]
        if order > 2:
            goes = bucket_of(context_hash(rest[:, :-1]), lower, frequent(rest[:, :-1], hot), bits)
        else:
            goes = bucket_of(rest[:, 0], lower, np.zeros(len(rest), dtype=bool), bits)
        rows += [("lower", b, w, c, None) for b, w, c in _blocks(rest, kinds, goes)]
        return pa.Table.from_batches([_table(rows, FOUND)])

    return blocks.groupBy("bucket").applyInArrow(run, FOUND)


def _sum_unigrams(blocks: DataFrame, root: str) -> DataFrame:
    """Continuation counts of words as arrays; rows kind=numbers with their sum at the end."""

    def run(table: pa.Table) -> pa.Table:
        words, counts = _gathered(table, 1)
        bucket = table.column("bucket")[0].as_py()
        keys, _, counts = _summed(words[:, 0], counts)
        write_array(f"{root}/grams1/{bucket}.npy", keys)
        write_array(f"{root}/grams1/{bucket}-n.npy", counts.astype(np.uint32))
        some = _number_counts(counts) + [int((counts >= 3).sum()), int(counts.sum())]
        return pa.Table.from_batches([_table([("numbers", bucket, None, None, some)], FOUND)])

    return blocks.groupBy("bucket").applyInArrow(run, FOUND)


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Amounts taken from counts of one, two, and three or more (Chen and Goodman, 1998);
    0.5, 1 and 1.5 where a corpus is too small to estimate them."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    each = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.0), i + 1.0) for i, d in enumerate(each))


@dataclass
class Model:
    """What scoring needs beside the arrays under `root`; bounded by orders and buckets."""

    root: str
    order: int
    bits: int
    word_bits: int
    tokens: int
    distinct: int
    hot: np.ndarray
    cut: dict[int, tuple[float, float, float]] = field(default_factory=dict)
    unigram: tuple[float, float] = (0.0, 1.0)
    contexts: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)


def _stats(found: DataFrame, kind: str, n: int) -> list[int]:
    row = found.where(F.col("kind") == kind).agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(n)]).first()
    return [int(v or 0) for v in row]


def train(docs: DataFrame, order: int = 2, per_bucket: int = 2_000_000) -> Model:
    """Model of all rows of `docs` (column text; null counts as empty).

    Every n-gram of every text is counted. The number of buckets grows with the tokens, so
    a bucket holds about `per_bucket` n-grams.
    """
    if order < 2:
        raise ValueError("order must be at least 2")
    spark = docs.sparkSession
    root = mounted(stage_path(spark, "ngram-model"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    word_bits = max(4, (parts - 1).bit_length())
    none = np.zeros(1, dtype=np.uint64)
    words = materialize(_sum_words(_count_blocks(docs, 1, word_bits, none), root, 4 << word_bits), "ngram-words")
    tokens, distinct = _stats(words, "total", 2)
    bits = max(word_bits, (tokens // per_bucket).bit_length())
    often = words.where((F.col("kind") == "frequent") & (F.col("stats")[0] * (4 << bits) >= tokens)).select("words").collect()
    hot = np.array(sorted([int(BEGIN), *[int(np.frombuffer(r["words"], dtype="<u8")[0]) for r in often]]), dtype=np.uint64)
    model = Model(root, order, bits, word_bits, tokens, distinct, hot)
    blocks = _count_blocks(docs, order, bits, hot)
    for k in range(order, 1, -1):
        found = materialize(_sum_grams(blocks, root, k, bits, hot), f"ngram-{k}")
        model.cut[k] = discounts(*_stats(found, "numbers", 4))
        sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(4)]
        spread = sorted((int(np.frombuffer(r["words"], dtype="<u8")[0]), *r[1:]) for r in found.where("kind = 'context'").groupBy("words").agg(*sums).collect())
        model.contexts[k] = (np.array([r[0] for r in spread], dtype=np.uint64), np.array([r[1:] for r in spread], dtype=np.int64).reshape(-1, 4))
        blocks = found.where("kind = 'lower'").select("bucket", "words", "counts")
    n1, n2, n3, n4, over, total = _stats(materialize(_sum_unigrams(blocks, root), "ngram-1"), "numbers", 6)
    model.cut[1] = discounts(n1, n2, n3, n4)
    d1, d2, d3 = model.cut[1]
    model.unigram = (float(total), (d1 * n1 + d2 * n2 + d3 * over) / total if total else 1.0)
    return model


def lookup(root: str, kind: str, keys: np.ndarray, buckets: np.ndarray, width: int = 1) -> np.ndarray:
    """Values stored under `keys` in the arrays of their buckets; 0 where there are none."""
    out = np.zeros((len(keys), width) if width > 1 else len(keys), dtype=np.int64)
    order = np.lexsort((keys, buckets))
    cuts = np.flatnonzero(np.concatenate([[True], np.diff(buckets[order]) != 0, [True]])) if len(keys) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        place = order[a:b]
        stored = read_array(f"{root}/{kind}/{buckets[place[0]]}.npy")
        if stored is None or not len(stored):
            continue
        asked = keys[place]
        at = np.minimum(np.searchsorted(stored, asked), len(stored) - 1)
        hit = stored[at] == asked
        out[place[hit]] = read_array(f"{root}/{kind}/{buckets[place[0]]}-n.npy")[at[hit]]
    return out


def _cut(model: Model, k: int, counts: np.ndarray) -> np.ndarray:
    """Counts less their discount."""
    return counts - np.array([0.0, *model.cut[k]])[np.minimum(counts, 3)]


class Scorer:
    """Probabilities of hashed tokens under a model."""

    def __init__(self, model: Model):
        self.model = model

    def unigrams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and continuation probability of each word."""
        m = self.model
        own, back = np.unique(words, return_inverse=True)
        own_grams = gram_hash(own[:, None])
        none = np.zeros(len(own), dtype=bool)
        counts = lookup(m.root, "words", own, bucket_of(own, own_grams, none, m.word_bits))
        follows = lookup(m.root, "grams1", own, bucket_of(own, own_grams, none, m.bits))
        total, left = m.unigram
        p = _cut(m, 1, follows) / max(total, 1.0) + left / (m.distinct + 1)
        return counts[back], p[back]

    def context(self, k: int, keys: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """Sum of counts, and number of n-grams seen once, twice, more often, of each context."""
        m = self.model
        own, first, back = np.unique(keys, return_index=True, return_inverse=True)
        sums = lookup(m.root, f"contexts{k}", own, bucket_of(own, own, np.zeros(len(own), dtype=bool), m.bits), 4)
        known, held = m.contexts[k]
        if len(known):
            at = np.minimum(np.searchsorted(known, own), len(known) - 1)
            hit = (known[at] == own) & spread[first]
            sums[hit] = held[at[hit]]
        return sums[back]

    def probabilities(self, tokens: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training count and probability of the token at each `place`, given those before it."""
        m = self.model
        counts, p = self.unigrams(tokens[place])
        for k in range(2, m.order + 1):
            words = np.stack([tokens[place - i] for i in range(k - 1, -1, -1)], axis=1)
            keys, grams, spread = context_hash(words[:, :-1]), gram_hash(words), frequent(words[:, :-1], m.hot)
            seen = lookup(m.root, f"grams{k}", grams, bucket_of(keys, grams, spread, m.bits))
            sums = self.context(k, keys, spread)
            total = np.maximum(sums[:, 0], 1)
            left = sums[:, 1:] @ np.array(m.cut[k]) / total
            p = np.where(sums[:, 0] > 0, _cut(m, k, seen) / total + left * p, p)
        return counts, p


def score(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns `keep`, n_tokens, n_known, base_score and score (log10) of every row's `text`.

    The perplexity of a text is 10 ** (-score / n_tokens).
    """
    kept = docs.select(*keep, "text")
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in kept.schema if f.name != "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ("n_tokens", "n_known", "base_score", "score")

    def run(batches):
        model = shared.value
        scorer, pad = Scorer(model), model.order - 1
        for rows, data, offsets in text_slices(batches, SLICE):
            tokens, begins = token_stream(*word_hashes(data, offsets), pad=pad)
            place = np.ones(len(tokens), dtype=bool)
            for i in range(pad):
                place[begins[:-1] + i] = False
            place = np.flatnonzero(place)
            logs = np.zeros((len(place), 3))
            for a in range(0, len(place), SLICE):
                counts, p = scorer.probabilities(tokens, place[a : a + SLICE])
                base = np.log10((counts + 1) / (model.tokens + (model.distinct + 1)))
                logs[a : a + SLICE] = np.stack([counts > 0, base, np.log10(p)], axis=1)
            first = np.searchsorted(place, begins[:-1])
            known, base, own = np.add.reduceat(logs, first, axis=0).T
            n = np.diff(np.append(first, len(place)))
            out = [pa.array(n, pa.int64()), pa.array(known.round().astype(np.int64)), pa.array(base), pa.array(own)]
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], *out], names=[*keep, *names])

    ship_package(docs.sparkSession)
    return kept.mapInArrow(run, f"{schema}n_tokens long, n_known long, base_score double, score double")


def score_corpus(docs: DataFrame, parts: int = 7, held: int = 2, order: int = 2) -> DataFrame:
    """Scores of every row of `docs`; learned from the rows outside fold `held` of `parts`.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null text counts
    as empty: its end is its one token. Repeated rows and null ids take part like all others.
    """
    own = docs.select("doc_id", "text", (fold(F.col("doc_id"), parts) == held).alias("held_out"))
    model = train(own.where(~F.col("held_out")), order)
    scored = score(own, model, "doc_id", "held_out")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
