"""Packing of tokenised documents by power-of-two decomposition.

A document of n tokens becomes n // longest pieces of the longest length and one piece for
each bit of the rest, so every piece has a power of two as its length. A sequence is one
piece: it never crosses documents and carries no padding, and training takes batches from
the bucket of one length (Pouransari et al., 2024).
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import map_texts

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkIds(dict):
    """Little-endian unsigned 32-bit ids of each blank-separated part of a text.

    The vocabulary drops white space and never joins what white space separates, so a part
    is encoded once and remembered. Parts of plain Latin letters, digits and signs are put
    together from words, which are remembered too; all others go through the whole
    tokenizer. At most `kept` parts and as many words are held.
    """

    plain = re.compile("[!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    words = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, vocabulary: str, kept: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.tokenizer, self.kept, self.known = Tokenizer.from_file(vocabulary), kept, {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        signs = (chr(i) for i in [*range(33, 127), *range(0xDF, 0x100)])
        self.bytes = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in signs}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.kept:
            self.clear()
        if self.plain.fullmatch(part) and not ("<|" in part and any(t in part for t in self.special)):
            ids = b"".join([self.known.get(w) or self._word(w) for w in self.words.findall(part.lower())])
        else:
            ids = np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if len(self.known) >= self.kept:
            self.known.clear()
        tokens = self.tokenizer.model.tokenize(word.translate(self.bytes))
        self.known[word] = ids = b"".join([t.id.to_bytes(4, "little") for t in tokens])
        return ids

    def encode(self, text: str) -> bytes:
        # Separators that only Python takes for white space stay inside their part.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return b"".join(map(self.__getitem__, re.findall("[^ \t\n\r]+", text)))
        return b"".join(map(self.__getitem__, text.split()))


_encoders: dict[str, ChunkIds] = {}


def encoder(vocabulary: str) -> ChunkIds:
    """One encoder for each vocabulary and Python worker, kept over tasks."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = ChunkIds(vocabulary)
    return _encoders[vocabulary]


def piece_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens, largest first."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, doc_id: Column | None = None, text: Column | None = None, *, longest: int = 4096,
         end_id: int = 2, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (binary), sequence_id, offset.

    `longest` must be a power of two. Null and empty texts hold the end id alone; rows with
    the same or a null id are packed one by one; an empty table gives no pieces. A piece is
    its own sequence (offset 0); ids of sequences are unique in the table.
    """
    if longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    vocabulary = vocabulary or default_vocabulary()
    end = np.array([end_id], dtype="<u4").tobytes()

    def make():
        known = encoder(vocabulary)

        def step(rows, texts):
            out = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "ids")}
            for key, ids in zip(rows.column("doc_id").to_pylist(), map(known.encode, texts)):
                ids += end
                n, at = len(ids) // 4, 0
                for m in piece_lengths(n, longest):
                    for k, v in zip(out, (key, at, m, n, ids[4 * at : 4 * (at + m)])):
                        out[k].append(v)
                    at += m
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

        return step

    doc_id, text = F.col("doc_id") if doc_id is None else doc_id, F.col("text") if text is None else text
    pieces = map_texts(docs.select(doc_id.cast("long").alias("doc_id"), text.alias("text")), make, PIECES)
    return pieces.withColumns({"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length: a reader of one folder gets sequences of equal length."""
    pieces.write.partitionBy("length").parquet(path)


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
