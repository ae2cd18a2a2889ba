"""Ranked lexical search in reverse: the items are indexed, the documents stream past.

The terms of a block of items form an inverted index that every task holds: a bounded number
of postings, whatever the size of the corpus. One pass over the documents counts them, their
terms and the documents of each item term; a second pass looks each document's term counts
up in the index, adds up scores and keeps the best documents of each item. Only these few
rows per task and item are shuffled, and merged in two steps so no task meets all of them.
More items than a block holds are taken block by block.

A document without a term, null or empty, is not counted and never ranked. Rows that share a
doc_id are ranked each on its own, a null doc_id after all numbers. Rows of one item_id are
one item with the terms of all; items without a term give no rows, and neither do empty tables.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import grouped_texts
from riskweave.session import drop_stage, ship_package, write_stage

#: Postings (item, term) of one block of items; also the most that is sent to a task.
POSTINGS = 2_000_000
#: Bytes of a term hold digits, letters and all code points from 128; A-Z are lower-cased.
TERM_BYTES = bytes(c if c > 127 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))
#: Scale of term frequency, and the weights of document length (in hundredths).
SATURATION, LENGTH_SHARE = 1_000_000_000, 90


def term_blocks(text: str, block: int = 1 << 22) -> Iterator[list[bytes]]:
    """Terms of a text in order; a long text comes in blocks that end between terms."""
    data = text.encode().translate(TERM_BYTES)
    at = 0
    while len(data) - at > block:
        cut = data.find(b" ", at + block)
        if cut < 0:
            break
        yield data[at:cut].split()
        at = cut
    yield (data[at:] if at else data).split()


def term_counts(text: str) -> Counter:
    counts = Counter()
    for terms in term_blocks(text):
        counts.update(terms)
    # bytes.split takes only ASCII white space for a separator, and the table leaves just blanks.
    return counts


class Index:
    """Inverted index over the terms of some items: postings by term, in one array."""

    def __init__(self, postings: Iterable[tuple[int, bytes]]):
        self.places: dict[bytes, int] = {}
        held = sorted({(self.places.setdefault(term, len(self.places)), item) for item, term in postings})
        pairs = np.array(held, dtype=np.int64).reshape(-1, 2)
        self.items = pairs[:, 1]
        self.starts = np.searchsorted(pairs[:, 0], np.arange(len(self.places) + 1))

    def weigh(self, documents: int, frequency: dict[bytes, int]) -> None:
        self.weights = np.zeros(len(self.places), dtype=np.int64)
        for term, place in self.places.items():
            self.weights[place] = math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency.get(term, 0) + 1)))


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Columns item (the id) and term, each pair once."""

    def run(batches):
        for rows, texts in grouped_texts(batches):
            pairs = [(i, t) for i, text in enumerate(texts) for t in term_counts(text)]
            places = pa.array([i for i, _ in pairs], pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("item").take(places), pa.array([t for _, t in pairs], pa.binary())], names=["item", "term"])

    ship_package(items.sparkSession)
    held = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    return held.mapInArrow(run, f"item {held.schema['item'].dataType.simpleString()}, term binary").distinct()


def _count(docs: DataFrame, index: Index) -> tuple[int, int, dict[bytes, int]]:
    """Documents with a term, all terms, and the documents of each indexed term: sums of tasks, bounded by the index."""
    places = index.places

    def run(batches):
        documents = total = 0
        frequency = Counter()
        for rows, texts in grouped_texts(batches):
            for text in texts:
                counts = term_counts(text)
                if counts:
                    documents += 1
                    total += counts.total()
                    frequency.update(counts.keys() & places.keys())
        out = {"term": [None, *frequency], "documents": [documents, *frequency.values()], "terms": [total, *[0] * len(frequency)]}
        yield pa.RecordBatch.from_arrays([pa.array(out["term"], pa.binary()), pa.array(out["documents"], pa.int64()), pa.array(out["terms"], pa.int64())], names=list(out))

    sums = docs.select("text").mapInArrow(run, "term binary, documents long, terms long").groupBy("term").agg(
        F.sum("documents").alias("documents"), F.sum("terms").alias("terms")
    )
    found = {None if r.term is None else bytes(r.term): r for r in sums.toLocalIterator()}
    whole = found.pop(None, None)
    return (whole.documents, whole.terms, {t: r.documents for t, r in found.items()}) if whole else (0, 0, {})


class Best:
    """The k best (score, doc_id) of each item so far: higher scores first, then smaller ids, null last."""

    def __init__(self, items: int, k: int):
        self.k, self.rows = k, [[] for _ in range(items)]
        self.floor = np.zeros(items, dtype=np.int64)

    def offer(self, scores: np.ndarray, ids: list) -> None:
        """Scores of documents (rows) by items (columns); those under an item's floor can't enter."""
        docs, items = np.nonzero((scores > 0) & (scores >= self.floor))
        if not len(docs):
            return
        order = np.lexsort((docs, -scores[docs, items], items))
        docs, items = docs[order], items[order]
        cuts = np.flatnonzero(np.diff(items, prepend=-1))
        for at, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(items)]):
            i = int(items[at])
            new = [((-int(scores[d, i])), ids[d] is None, ids[d] or 0) for d in docs[at:end].tolist()]
            self.rows[i] = sorted(self.rows[i] + new)[: self.k]
            if len(self.rows[i]) == self.k:
                self.floor[i] = -self.rows[i][-1][0]


def _stream(docs: DataFrame, index: Index, documents: int, total: int, items: int, k: int, block: int = 256) -> DataFrame:
    """item (its place), doc_id, score: the best `k` documents of each item in each task."""
    places, weights, starts, postings = index.places, index.weights, index.starts, index.items

    def score(batch: list[Counter]) -> np.ndarray:
        """Scores of documents by items; all sums are of 64-bit integers."""
        doc, place, tf, size = [], [], [], []
        for i, counts in enumerate(batch):
            n = counts.total()
            known = counts.keys() & places.keys()
            doc.extend([i] * len(known)), size.extend([n] * len(known))
            place.extend(map(places.__getitem__, known)), tf.extend(map(counts.__getitem__, known))
        doc, place, tf = (np.array(a, dtype=np.int64) for a in (doc, place, tf))
        # n * N may pass 64 bits on a huge corpus, so lengths are divided as Python integers.
        m = np.array([100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // total for n in size], dtype=np.int64)
        part = weights[place] * ((SATURATION * tf) // (1000 * tf + 8 * m))
        width = starts[place + 1] - starts[place]
        at = np.repeat(starts[place] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        out = np.zeros(len(batch) * items, dtype=np.int64)
        np.add.at(out, np.repeat(doc, width) * items + postings[at], np.repeat(part, width))
        return out.reshape(len(batch), items)

    def run(batches):
        best, together = Best(items, k), max(1, min(block, (1 << 22) // items))
        for rows, texts in grouped_texts(batches):
            ids = rows.column("doc_id").to_pylist()
            for at in range(0, len(texts), together):
                best.offer(score([term_counts(t) for t in texts[at : at + together]]), ids[at : at + together])
        rows = [(i, None if missing else doc, -negative) for i, held in enumerate(best.rows) for negative, missing, doc in held]
        arrays = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def _merge(rows: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """The best `k` rows of each item: first of each part of an item's rows, then of what these keep."""
    order = F.desc("score"), F.asc_nulls_last("doc_id")
    parted = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    some = parted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("part")


def search(docs: DataFrame, items: DataFrame, k: int = 10, *, item_id: str = "item_id", text: str = "text", postings: int = POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the `k` best rows of `docs` (doc_id, text) for each row of `items`."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms, path = write_stage(item_terms(items, item_id, text), "terms")
    sizes = terms.groupBy("item").agg(F.count(F.lit(1)).alias("terms"))
    order = Window.orderBy(F.asc_nulls_first("item")).rowsBetween(Window.unboundedPreceding, 0)
    # The number of an item's block comes from a running sum over one row per item.
    numbered, numbers = write_stage(sizes.withColumn("block", F.floor((F.sum("terms").over(order) - 1) / postings)), "blocks")
    blocks = [r.block for r in numbered.select("block").distinct().orderBy("block").collect()]
    found = []
    for block in blocks:
        chosen = [r.item for r in numbered.where(F.col("block") == block).select("item").orderBy(F.asc_nulls_first("item")).collect()]
        place = {item: i for i, item in enumerate(chosen)}
        here = terms.join(numbered.where(F.col("block") == block).select(F.col("item").alias("own")), F.col("item").eqNullSafe(F.col("own")), "left_semi")
        index = Index((place[r.item], bytes(r.term)) for r in here.toLocalIterator())
        documents, total, frequency = _count(docs, index)
        if not documents:
            break
        index.weigh(documents, frequency)
        best = _merge(_stream(docs, index, documents, total, len(chosen), k), k)
        names = F.array(*[F.lit(c) for c in chosen])
        found.append(write_stage(best.select(F.get(names, F.col("item").cast("int")).alias(item_id), "rank", "doc_id", "score"), "ranked")[0])
    kind = terms.schema["item"].dataType.simpleString()
    drop_stage(spark, path), drop_stage(spark, numbers)
    out = spark.createDataFrame([], f"{item_id} {kind}, rank int, doc_id long, score long")
    for part in found:
        out = out.unionByName(part)
    return out
