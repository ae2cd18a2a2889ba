"""Spelling variants by a frequency-vector trie.

Letters are put into groups of about equal weight; a word's vector holds its letter count in
each group. One inserted, deleted or replaced letter adds at most one surplus and one deficit
to the vector, so the words are arranged in a trie by successive counts, and a depth-first
search goes down with a budget of one each. The words at the leaves it reaches are verified.

The trie is cut by the first counts into cells. A word is stored in its own cell and looks
into those cells within the budget that come at or after its own, so each pair is found
once, wherever its cells lie. The words of a large cell are dealt into parts, and so are the
words that look into it; each part of the one meets each of the other. A task holds one
part at a time and streams the words that look into it.

Null texts have no words; equal rows count each; the length of a text is not bounded; no
words, or an empty table, give no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import grouped_texts
from riskweave.session import drop_stage, ship_package, write_stage

#: Letters of a word; all are code points below 256, so a word is held as Latin-1 bytes.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
GROUPS, PREFIX = 16, 4
#: Words of one part of a cell, words that look into it together, words of a leaf.
PART, TOGETHER, LEAF = 10_000, 20_000, 16
#: Longer words are verified one by one, and distinct words counted before a task passes its counts on.
WIDE, HELD = 64, 300_000


def spelled(doc_id, run: str, every: int = 97) -> str:
    """The run, less one letter if the hash of id and run says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _runs(text: str, block: int = 1 << 20) -> Iterator[Counter]:
    lowered = text.encode().translate(LOWER).decode()
    if len(lowered) <= block:
        yield Counter(RUN.findall(lowered))
        return
    found = (m[0] for m in RUN.finditer(lowered))
    while counts := Counter(islice(found, block)):
        yield counts


def count_words(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """word, n: spelled words of at least `shortest` letters and their occurrences, from `least` on."""

    def run(batches):
        held = Counter()

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return rows

        for rows, texts in grouped_texts(batches):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts):
                for counts in _runs(text):
                    for found, n in counts.items():
                        word = spelled(doc_id, found)
                        if len(word) >= shortest:
                            held[word] += n
                    if len(held) > HELD:
                        yield out()
        yield out()

    ship_package(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each code point below 256: the next frequent letter joins the lightest group."""

    def run(batches):
        total = np.zeros(256, dtype=np.int64)
        for rows in batches:
            total += np.bincount(np.frombuffer("".join(rows.column("word").to_pylist()).encode("latin-1"), np.uint8), minlength=256)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["letter", "n"])

    weight, of = np.zeros(groups, dtype=object), np.arange(256) % groups
    rows = words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()
    for r in sorted(rows, key=lambda r: (-r.n, r.letter)):
        lightest = int(np.argmin(weight))
        of[r.letter] = lightest
        weight[lightest] += r.n
    return of.astype(np.int64)


def vectors(words: list[bytes], of: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Letter counts of each word by group."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = of[np.frombuffer(b"".join(words), dtype=np.uint8)]
    place = np.repeat(np.arange(len(words)), lengths) * groups + flat
    return np.bincount(place, minlength=len(words) * groups).reshape(len(words), groups).astype(np.int32)


def cell(counts) -> int:
    """The first counts as one number, ordered like the counts themselves."""
    out = 0
    for c in counts:
        out = out << 15 | min(int(c), 0x7FFF)
    return out


def _moves(prefix: int) -> list[tuple[int, ...]]:
    """Changes of the first counts within one surplus and one deficit."""
    return [m for m in product((-1, 0, 1), repeat=prefix) if m.count(1) <= 1 and m.count(-1) <= 1]


def cells_around(first: np.ndarray) -> list[tuple[int, list[int]]]:
    """Each word's own cell, and those it looks into: itself and later ones within the budget."""
    moves, known, out = _moves(first.shape[1]), {}, []
    for counts in map(tuple, first.tolist()):
        if counts not in known:
            own = cell(counts)
            near = (tuple(c + m for c, m in zip(counts, move)) for move in moves)
            known[counts] = own, sorted({c for n in near if min(n) >= 0 and (c := cell(n)) >= own})
        out.append(known[counts])
    return out


def is_near(a: bytes, b: bytes) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    short, long = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[at + (len(a) == len(b)) :] == long[at + 1 :]


class Words:
    """Words with their vectors, and their letters in rows of equal width."""

    def __init__(self, words: list[bytes], of: np.ndarray):
        self.words, self.vectors = words, vectors(words, of)
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        width = min(WIDE, int(self.lengths.max(initial=0))) + 1
        self.letters = np.frombuffer(b"".join(w[:width].ljust(width, b"\0") for w in words), dtype=np.uint8).reshape(len(words), width)

    def padded(self, rows: np.ndarray, width: int) -> np.ndarray:
        out = np.zeros((len(rows), width), dtype=np.uint8)
        out[:, : self.letters.shape[1]] = self.letters[rows]
        return out


def verify(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Which of the pairs (a[i], b[j]) are near."""
    width = max(a.letters.shape[1], b.letters.shape[1])
    x, y, m, n = a.padded(i, width), b.padded(j, width), a.lengths[i], b.lengths[j]
    swap = m < n
    x[swap], y[swap] = y[swap], x[swap]
    other = x != y
    out = (m == n) & (other.sum(axis=1) == 1)
    # One letter more: equal up to the first difference, and equal behind it one place on.
    one = np.flatnonzero(np.abs(m - n) == 1)
    first = other[one].argmax(axis=1)
    behind = x[one, 1:] != y[one, :-1]
    out[one] = ~(behind & (np.arange(width - 1) >= first[:, None])).any(axis=1)
    for k in np.flatnonzero(np.maximum(m, n) > WIDE):
        out[k] = is_near(a.words[i[k]], b.words[j[k]])
    return out


class Trie:
    """Words ordered by their vectors: a node of the trie is a range of rows and a level."""

    def __init__(self, words: list[bytes], of: np.ndarray):
        by_vector = np.lexsort(vectors(words, of).T[::-1]) if words else []
        self.held = Words([words[i] for i in by_vector], of)

    def near(self, sought: Words, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row of `sought`, row of the trie) of near words, by depth-first search for all sought words together."""
        rows, counts = self.held.vectors, sought.vectors
        levels, none = rows.shape[1], np.zeros(len(counts), dtype=np.int32)
        stack = [(0, len(rows), 0, np.arange(len(counts)), none, none)]
        while stack:
            low, high, level, alive, up, down = stack.pop()
            if not len(alive) or low == high:
                continue
            if high - low > LEAF and level < levels:
                column = rows[low:high, level]
                cuts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist(), high - low]
                own = counts[alive, level]
                for at, end in zip(cuts[:-1], cuts[1:]):
                    d = own - column[at]
                    new_up, new_down = up + np.maximum(d, 0), down + np.maximum(-d, 0)
                    stay = np.flatnonzero((new_up <= 1) & (new_down <= 1))
                    stack.append((low + at, low + end, level + 1, alive[stay], new_up[stay], new_down[stay]))
                continue
            step = max(1, most // (high - low))
            for at in range(0, len(alive), step):
                some = alive[at : at + step]
                d = counts[some, None, level:] - rows[None, low:high, level:]
                fits = (np.maximum(d, 0).sum(axis=2) + up[at : at + step, None] <= 1) & (np.maximum(-d, 0).sum(axis=2) + down[at : at + step, None] <= 1)
                q, w = np.nonzero(fits)
                if len(q):
                    q, w = some[q], w + low
                    found = verify(sought, q, self.held, w)
                    yield q[found], w[found]


def near_pairs(words: DataFrame, of: np.ndarray, part: int = PART) -> DataFrame:
    """a, a_n, b, b_n: each pair of near words once. `words` (word, n) must be a written table."""

    def first_counts(rows) -> np.ndarray:
        return vectors([w.encode("latin-1") for w in rows.column("word").to_pylist()], of)[:, :PREFIX]

    def sizes(batches):
        held = Counter()
        for rows in batches:
            held.update(own for own, _ in cells_around(first_counts(rows)))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["cell", "n"])

    ship_package(words.sparkSession)
    counted = words.select("word").mapInArrow(sizes, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    # Only cells of more than one part are listed: at most one for each `part` words.
    parts = {r.cell: -(-r.n // part) for r in counted.where(F.col("n") > part).collect()}

    def route(batches):
        for rows in batches:
            out = []
            for i, (w, (own, around)) in enumerate(zip(rows.column("word").to_pylist(), cells_around(first_counts(rows)))):
                code, m = zlib.crc32(w.encode()), parts.get(own, 1)
                out.extend((i, own, code % m * m + asking, 0) for asking in range(m))
                for c in around:
                    m = parts.get(c, 1)
                    out.extend((i, c, held * m + code // 7 % m, 1 if c == own else 2) for held in range(m))
            place, cells, numbers, roles = (np.array(x, dtype=np.int64) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
            for at in range(0, len(place), 100_000):
                cut = slice(at, at + 100_000)
                arrays = [pa.array(cells[cut]), pa.array(numbers[cut], pa.int64()), pa.array(roles[cut].astype(np.int8))]
                taken = rows.take(pa.array(place[cut]))
                yield pa.RecordBatch.from_arrays([*arrays, taken.column("word"), taken.column("n")], names=["cell", "part", "role", "word", "n"])

    def search(batches):
        now, trie, stored, asked = None, None, [], []

        def answer():
            nonlocal trie
            if trie is None:
                trie = Trie([w.encode("latin-1") for w, _ in stored], of)
                numbers.clear()
                numbers.update(stored)
            sought = Words([w.encode("latin-1") for w, _, _ in asked], of)
            pairs = []
            for q, w in trie.near(sought):
                for i, j in zip(q.tolist(), w.tolist()):
                    (a, n, role), b = asked[i], trie.held.words[j].decode("latin-1")
                    # In its own cell a word looks for greater ones only, so the pair comes once.
                    if role == 2 or a < b:
                        pairs.append((a, n, b, numbers[b]))
            asked.clear()
            columns = list(zip(*pairs)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["a", "a_n", "b", "b_n"])

        numbers = {}
        for rows in batches:
            for c, p, role, word, n in zip(*(rows.column(k).to_pylist() for k in ("cell", "part", "role", "word", "n"))):
                if (c, p) != now:
                    if asked:
                        yield answer()
                    now, trie = (c, p), None
                    stored.clear()
                if role == 0:
                    stored.append((word, n))
                elif stored:
                    asked.append((word, n, role))
                    if len(asked) >= TOGETHER:
                        yield answer()
        if asked:
            yield answer()

    routed = words.select("word", "n").mapInArrow(route, "cell long, part long, role byte, word string, n long")
    ordered = routed.repartition("cell", "part").sortWithinPartitions("cell", "part", "role")
    return ordered.mapInArrow(search, "a string, a_n long, b string, b_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word of the chain of forms, for each row of `forms` (word, form) that has one.

    Each round doubles the steps a word has gone. A form occurs at least twice as often as
    its word, so chains are short.
    """
    spark = forms.sparkSession
    now, path = write_stage(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after, new_path = write_stage(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not after.where("moved").isEmpty()
        drop_stage(spark, path)
        now, path = after.drop("moved"), new_path
        if not moved:
            return now


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of `docs` (doc_id, text).

    A word's form is its most frequent near word (ties: the smallest) if that occurs at
    least twice as often.
    """
    words, _ = write_stage(count_words(docs), "words")
    pairs = near_pairs(words, letter_groups(words))
    both = F.explode(F.array(
        F.struct(F.col("a").alias("word"), (-F.col("b_n")).alias("less"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("word"), (-F.col("a_n")).alias("less"), F.col("a").alias("other")),
    )).alias("e")
    best = pairs.select(both).select("e.*").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("less", "other")).alias("best"))
    chosen = words.join(best, "word", "left").withColumn("frequent", -F.col("best.less") >= 2 * F.col("n"))
    forms, _ = write_stage(chosen.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("frequent"), F.col("best.other")).alias("form"), F.when(F.col("frequent"), -F.col("best.less")).alias("form_n"),
    ), "forms")
    found = forms.join(roots(forms), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
