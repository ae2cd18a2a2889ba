"""Words of texts as 64-bit hashes, computed for many texts at once on their UTF-8 bytes.

A-Z are lower-cased; words are what stands between ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_VALUES = np.where(WHITE, np.uint64(0), _VALUES[LOWER])
_powers = {_ODD: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of `base` modulo 2^64."""
    held = _powers[base]
    while len(held) < n:
        held = np.concatenate([held, held * np.uint64(pow(base, len(held), 1 << 64))])
    _powers[base] = held
    return held[:n]


def text_slices(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of about `most` bytes of column `text` (or one row): rows, bytes, offsets of the rows."""
    for batch in batches:
        texts = batch.column("text")
        _, ends, data = texts.buffers()
        offsets = np.frombuffer(ends, dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
        start = 0
        while start < len(texts):
            stop = int(max(start + 1, np.searchsorted(offsets, offsets[start] + most, side="right") - 1))
            yield batch.slice(start, stop - start), data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start]
            start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, block: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each row."""
    white = WHITE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets[:-1]] = True
    begins = ~white
    begins[1:] &= white[:-1] | first[1:-1]
    starts = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(starts, offsets))
    if len(data) <= block:
        return _hash(data, starts), counts
    # A long text goes through in blocks of whole words.
    parts, at = [], 0
    while at < len(starts):
        to = int(max(at + 1, np.searchsorted(starts, starts[at] + block)))
        end = starts[to] if to < len(starts) else len(data)
        parts.append(_hash(data[starts[at] : end], starts[at:to] - starts[at]))
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), counts


def _hash(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.add.reduceat(_VALUES[data] * _power(_ODD, len(data)), starts)
    return mix(sums * _power(_INVERSE, len(data))[starts])


def hash_word(word: str) -> int:
    """The hash of one word, character by character, for tests."""
    total = sum(int(_VALUES[b]) * pow(_ODD, i, 1 << 64) for i, b in enumerate(word.encode()))
    return int(mix(np.array([total % (1 << 64)], dtype=np.uint64))[0])


#: Stands for the end of a text, and for what is before its first word. They are not words.
END, BEGIN = np.uint64(1), np.uint64(2)


def token_stream(hashes: np.ndarray, counts: np.ndarray, pad: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """All rows behind one another: `pad` BEGIN marks, the words, one END mark; and where each row starts."""
    sizes = counts + pad + 1
    begins = np.concatenate([[0], np.cumsum(sizes)])
    out = np.full(begins[-1], END, dtype=np.uint64)
    row = np.repeat(np.arange(len(counts)), counts)
    out[np.arange(len(hashes)) + (row + 1) * pad + row] = hashes
    for i in range(pad):
        out[begins[:-1] + i] = BEGIN
    return out, begins
