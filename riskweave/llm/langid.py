"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, found by a forward
pass; a text is scored by its words, and languages are compared by their posteriors.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskweave.llm.common import fold, map_texts, worker_state

WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The vocabulary: pieces of letters with a mark for the start of a word, and single bytes."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        self.size = self.model.get_piece_size()
        self.byte = np.full(256, self.model.unk_id(), dtype=np.int64)
        for i in range(self.size):
            if self.model.is_byte(i):
                self.byte[int(self.model.id_to_piece(i)[3:-1], 16)] = i

    def automaton(self):
        """All pieces of two or more characters; their values hold length and number."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for i, piece in self.letters():
            if len(piece) > 1:
                found.add_word(piece, len(piece) * self.size + i)
        found.make_automaton()
        return found

    def letters(self):
        for i in range(self.size):
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)):
                yield i, self.model.id_to_piece(i)


_pieces: dict[str, Pieces] = {}


def pieces(vocabulary: str) -> Pieces:
    if vocabulary not in _pieces:
        _pieces[vocabulary] = Pieces(vocabulary)
    return _pieces[vocabulary]


def count_pieces(docs: DataFrame, vocabulary: str, kept: int = 300_000) -> DataFrame:
    """lang, piece, n: pieces of the vocabulary's own segmentation of all words, by language.

    Each slice counts its distinct words first and emits at most one row for each language
    and piece, so what is shuffled does not grow with the length of texts.
    """

    def make():
        known, cache = pieces(vocabulary), {}

        def step(rows, texts):
            words: dict[str, Counter] = {}
            for lang, text in zip(rows.column("lang").to_pylist(), texts):
                words.setdefault(lang, Counter()).update(WORDS.findall(text.lower()))
            out: tuple[list, list, list] = ([], [], [])
            for lang, counts in words.items():
                fresh = [w for w in counts if w not in cache]
                if len(cache) + len(fresh) > kept:
                    cache.clear()
                    fresh = list(counts)
                cache.update(zip(fresh, known.model.encode(fresh, num_threads=1)))
                total = Counter()
                for w, n in counts.items():
                    for i in cache[w]:
                        total[i] += n
                out[0].extend([lang] * len(total))
                out[1].extend(total.keys())
                out[2].extend(total.values())
            kinds = (pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, kinds)], names=["lang", "piece", "n"])

        return step

    counted = map_texts(docs.select("lang", "text"), make, "lang string, piece long, n long")
    return counted.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities of pieces (pieces x languages) and log priors; its size depends on the
    vocabulary and the number of languages alone."""

    def __init__(self, vocabulary: str, langs: list[str], log_piece: np.ndarray, log_prior: np.ndarray):
        self.vocabulary, self.langs, self.log_piece, self.log_prior = vocabulary, langs, log_piece, log_prior


def fit(docs: DataFrame, learn: Column, vocabulary: str | None = None, smoothing: float = 0.1) -> Model:
    """Learn from the rows of `docs` (lang, text) where `learn` holds and lang is not null.

    Every piece gets `smoothing` added to its count, so no word has probability zero. The
    prior of a language is its share of the documents that hold a letter or not.
    """
    vocabulary = vocabulary or default_vocabulary()
    used = docs.where(learn & F.col("lang").isNotNull())
    shares = {r["lang"]: r["n"] for r in used.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs, size = sorted(shares), pieces(vocabulary).size
    counts = np.full((size, len(langs)), smoothing)
    at = {lang: i for i, lang in enumerate(langs)}
    for r in count_pieces(used, vocabulary).toLocalIterator():
        counts[r["piece"], at[r["lang"]]] += r["n"]
    prior = np.array([shares[lang] for lang in langs], dtype=float)
    return Model(vocabulary, langs, np.log(counts / counts.sum(axis=0)), np.log(prior / max(prior.sum(), 1)))


class Scorer:
    """Log probability of words under each language; at most `kept` words are remembered."""

    def __init__(self, model: Model, kept: int = 600_000):
        self.model, self.kept = model, kept
        self.pieces = pieces(model.vocabulary)
        self.found = self.pieces.automaton()
        self.single = {p: i for i, p in self.pieces.letters() if len(p) == 1}
        self.at: dict[str, int] = {}
        self.held = np.zeros((1024, len(model.langs)))
        self.letter = np.zeros(1024, dtype=bool)

    def _char(self, char: str) -> np.ndarray:
        """log of the ways to spell one character: its own piece, or the pieces of its bytes."""
        code = np.frombuffer(char.encode("utf-8", "replace"), dtype=np.uint8)
        out = self.model.log_piece[self.pieces.byte[code]].sum(axis=0)
        return np.logaddexp(out, self.model.log_piece[self.single[char]]) if char in self.single else out

    def forward(self, words: list[str]) -> np.ndarray:
        """log of the sum over all segmentations, words x languages."""
        words = ["▁" + w for w in words]
        with np.errstate(divide="ignore"):
            out = np.log(self._passes(words, np.exp, np.multiply, np.add))
        # Where probabilities of a long word leave the range of numbers, add their logarithms.
        weak = np.flatnonzero((out < -600).any(axis=1))
        if len(weak):
            out[weak] = self._passes([words[i] for i in weak], np.positive, np.add, np.logaddexp)
        return out

    def _passes(self, words: list[str], scale, times, plus) -> np.ndarray:
        """The forward pass with given arithmetic. Words come in order of length and are laid
        behind one another; pieces ending at the same place of their word are added for all
        words at once, place by place."""
        joined = "\n".join(words)
        lengths = np.array([len(w) for w in words])
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        flat = np.fromiter(chain.from_iterable(self.found.iter(joined)), dtype=np.int64).reshape(-1, 2)
        ends, (sizes, ids) = flat[:, 0], np.divmod(flat[:, 1], self.pieces.size)
        own, code = np.unique(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4"), return_inverse=True)
        char = scale(np.array([self._char(chr(c)) for c in own]))[code]
        place = np.arange(len(joined)) - np.repeat(begin, lengths + 1)[: len(joined)]
        step = place[ends].astype(np.int16 if lengths.max() < 30_000 else np.int64)
        order = np.argsort(step, kind="stable")
        ends, sizes, logs = ends[order], sizes[order], scale(self.model.log_piece[ids[order]])
        cuts = np.searchsorted(step[order], np.arange(int(lengths.max()) + 1))
        # total[x] is the mass of all ways to reach the front of place x.
        total = np.zeros((len(joined) + 1, logs.shape[1]))
        total[begin] = scale(np.zeros(1))
        longer = np.searchsorted(lengths, np.arange(int(lengths.max()) + 1), side="right")
        for t, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            front = begin[longer[t] :] + t
            total[front + 1] = times(total[front], char[front])
            if a < b:
                reach = times(total[ends[a:b] + 1 - sizes[a:b]], logs[a:b])
                first = np.flatnonzero(np.concatenate([[True], ends[a + 1 : b] != ends[a : b - 1]]))
                at = ends[a:b][first] + 1
                total[at] = plus(total[at], plus.reduceat(reach, first, axis=0))
        return total[begin + lengths]

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of the remembered words in `held`."""
        fresh = [w for w in words if w not in self.at]
        if len(self.at) + len(fresh) > self.kept and self.at:
            self.at.clear()
            fresh = words
        fresh = sorted(fresh, key=len)
        need = len(self.at) + len(fresh)
        if need > len(self.held):
            grow = max(need, 2 * len(self.held)) - len(self.held)
            self.held = np.concatenate([self.held, np.zeros((grow, self.held.shape[1]))])
            self.letter = np.concatenate([self.letter, np.zeros(grow, dtype=bool)])
        start, held = 0, 0
        for i, w in enumerate(fresh):
            held += len(w)
            if held > 200_000 or i == len(fresh) - 1:
                part, base = fresh[start : i + 1], len(self.at)
                self.held[base : base + len(part)] = self.forward(part)
                self.letter[base : base + len(part)] = [any(map(str.isalpha, w)) for w in part]
                self.at.update(zip(part, range(base, base + len(part))))
                start, held = i + 1, 0
        return np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))

    def log_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum over words for each text and language, and whether the text holds a letter."""
        counts = [Counter(WORDS.findall(t.lower())) for t in texts]
        distinct = list(set().union(*counts))
        row = dict(zip(distinct, self.rows(distinct).tolist())) if distinct else {}
        sums, some = np.zeros((len(texts), self.held.shape[1])), np.zeros(len(texts), dtype=bool)
        for i, c in enumerate(counts):
            if c:
                at = np.fromiter(map(row.__getitem__, c), dtype=np.int64, count=len(c))
                sums[i] = np.fromiter(c.values(), dtype=float, count=len(c)) @ self.held[at]
                some[i] = self.letter[at].any()
        return sums, some


def scorer_of(shared) -> Scorer:
    """The scorer of a broadcast model, kept over the tasks of a Python worker."""
    key, scorers = id(shared.value), worker_state("langid")
    if key not in scorers:
        scorers.clear()
        scorers[key] = Scorer(shared.value)
    return scorers[key]


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns `keep`, lang_pred and score (posterior of the language) of each row's `text`.

    Null text and text without a letter get 'und' and score 0, as do all rows if no language
    was learned.
    """
    kept = docs.select(*dict.fromkeys([*keep, "text"]))
    told = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    schema = StructType([*[kept.schema[c] for c in keep], *told])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = scorer_of(shared) if shared.value.langs else None

        def step(rows, texts):
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if scorer:
                sums, some = scorer.log_texts(texts)
                sums = sums + scorer.model.log_prior
                best = sums.argmax(axis=1)
                share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(some):
                    names[i], scores[i] = scorer.model.langs[best[i]], share[i]
            out = [*[rows.column(c) for c in keep], pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            return pa.RecordBatch.from_arrays(out, names=[*keep, "lang_pred", "score"])

        return step

    return map_texts(kept, make, schema, "langid")


def identify(docs: DataFrame, parts: int = 5, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from rows outside fold 0 of `parts`.

    Only `text` enters a prediction. Null languages teach nothing; null ids fall into fold 0.
    """
    own = docs.select("doc_id", "lang", "text", (fold(F.col("doc_id"), parts) == 0).alias("held_out"))
    return predict(own, fit(own, ~F.col("held_out"), vocabulary), "doc_id", "held_out")


def accepted(least: float = 0.5) -> Column:
    return (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
