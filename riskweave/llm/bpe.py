"""Byte-level BPE encoding and decoding with recursive DuckDB queries in each partition.

A word of the splitting pattern is a run of rows (word, position, token), one for each byte
at first. A recursive query joins neighbouring rows with the merge table and contracts each
word's leftmost pair of least rank until no pair of it is in the table. Decoding joins the
ids with the vocabulary and puts the pieces together by an ordered aggregation. Nothing is
shuffled: a task keeps the distinct words it has met, so each is contracted once.

Null texts count as empty and have no ids; equal rows give equal results, row by row; an
empty table gives no rows. A text of any length goes through in blocks of whole words, so
memory follows the block and the longest single word.
"""

from __future__ import annotations

import base64
import hashlib
import re
import warnings
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import grouped_texts, map_texts, with_row
from riskweave.session import ship_package

#: Words up to this many bytes are contracted one pair a round; longer ones many pairs a round.
SHORT = 48
#: Words and tokens of one block.
BLOCK = 1 << 20
#: Words that one recursive query contracts.
TOGETHER = 30_000
#: Distinct words that a task remembers before it starts afresh.
KEPT = 1_000_000

# Rows are chained by the position and token that follow. A word is done in its last round.
CONTRACT_SHORT = """
with recursive state as (
  select wid, pos, id, lead(pos) over w as next_pos, lead(id) over w as next_id, 0 as round
  from start window w as (partition by wid order by pos)
  union all
  (with pairs as (
     select s.wid, s.pos, s.next_pos, m.rank from state s join merges m on m.left_id = s.id and m.right_id = s.next_id),
   least as (
     select wid, min(rank) as rank, arg_min({'pos': pos, 'gone': next_pos}, (rank::bigint << 32) | pos) as hit
     from pairs group by wid),
   hits as (
     select l.wid, l.rank, l.hit.pos as pos, l.hit.gone as gone, s.next_pos, s.next_id
     from least l join state s on s.wid = l.wid and s.pos = l.hit.gone)
   select s.wid, s.pos, case when s.pos = h.pos then h.rank else s.id end,
          case when s.pos = h.pos then h.next_pos else s.next_pos end,
          case when s.pos = h.pos then h.next_id when s.next_pos = h.pos then h.rank else s.next_id end, s.round + 1
   from state s join hits h on s.wid = h.wid and s.pos <> h.gone)
),
last as (select wid, max(round) as round from state group by wid)
select wid, pos, id from state join last using (wid, round) order by wid, pos
"""

# The same fixpoint in fewer rounds: from the left, all pairs of the least rank that do not
# overlap are contracted at once, up to the first that puts a pair of lower rank in its place.
# Only the latest state of a position is held; a row with a null id is gone.
CONTRACT_LONG = """
with recursive state(wid, pos, id) using key (wid, pos) as (
  select wid, pos, id from start
  union all
  (with pairs as (
     select s.*, m.rank, min(m.rank) over (partition by wid) as low
     from (select *, lead(id) over w as next_id from state where id is not null window w as (partition by wid order by pos)) s
     left join merges m on m.left_id = s.id and m.right_id = s.next_id),
   runs as (
     select *, lag(rank, 1, -1) over w is distinct from low as fresh, row_number() over w as n from pairs where low is not null
     window w as (partition by wid order by pos)),
   chosen as (
     select *, rank is not distinct from low
               and (n - max(case when fresh and rank = low then n end) over (partition by wid order by pos)) % 2 = 0 as chosen
     from runs),
   around as (
     select *, case when lag(chosen, 2, false) over w then low else lag(id) over w end as left_id, lead(id, 2) over w as right_id
     from chosen window w as (partition by wid order by pos)),
   judged as (
     select a.*, coalesce(a.chosen and (l.rank < a.low or r.rank < a.low), false) as lower
     from around a left join merges l on l.left_id = a.left_id and l.right_id = a.low
                   left join merges r on r.left_id = a.low and r.right_id = a.right_id),
   hits as (
     select *, chosen and coalesce(sum(lower::int) over (partition by wid order by pos rows between unbounded preceding and 1 preceding), 0) = 0 as hit
     from judged)
   select wid, pos, case when lag(hit, 1, false) over (partition by wid order by pos) then null when hit then low else id end from hits)
)
select wid, pos, id from state where id is not null order by wid, pos
"""

DECODE = "select part, list(piece order by place) as pieces from coded join pieces using (id) group by part order by part"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=4)
def splitter(pattern: str) -> tuple[re.Pattern, re.Pattern]:
    """`pattern` with its classes \\p{L}, \\p{N}, \\s and \\S written out as ranges of code points: for
    texts of the first plane, and for all others.

    The ranges are those of the library's own regular expressions, asked for all code points
    at once, so a letter of a later Unicode version can't make a difference.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    spans = {}
    for name in ("\\p{L}", "\\p{N}", "\\s"):
        single = tiktoken.Encoding(name, pat_str=name, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        codes = np.array([ord(c) for c in bytes(single.encode_ordinary(every)).decode()])
        cuts = np.flatnonzero(np.diff(codes) > 1)
        spans[name] = list(zip(codes[np.r_[0, cuts + 1]].tolist(), codes[np.r_[cuts, len(codes) - 1]].tolist()))

    def written_out(last: int) -> re.Pattern:
        inside = {k: "".join(f"\\U{a:08x}-\\U{min(b, last):08x}" for a, b in v if a <= last) for k, v in spans.items()}
        out, depth = [], 0
        for part in re.findall(r"\\p\{[LN]\}|\\[sS]|\\.|.", pattern, re.S):
            depth += (part == "[") - (part == "]")
            if part == "\\S":
                if depth:
                    raise ValueError("\\S inside a set can't be written out")
                out.append(f"[^{inside['\\s']}]")
            elif part in inside:
                out.append(inside[part] if depth else f"[{inside[part]}]")
            else:
                out.append(part)
        return re.compile("".join(out))

    return written_out(0xFFFF), written_out(0x10FFFF)


_BEYOND = re.compile("[\U00010000-\U0010ffff]")


def words(text: str, pattern: str) -> Iterator[list[str]]:
    """The matches of the pattern in a text, in blocks."""
    first_plane, full = splitter(pattern)
    split = full if _BEYOND.search(text) else first_plane
    if len(text) <= BLOCK:
        yield split.findall(text)
        return
    found = (m[0] for m in split.finditer(text))
    while block := list(islice(found, BLOCK)):
        yield block


class _Places(dict):
    """Place of each word in the order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        return place


class Coder:
    """Encoder and decoder of one Python worker: the merge table, the pieces, the words met so far."""

    def __init__(self, vocabulary: str, pattern: str):
        import duckdb

        self.pattern, self.ranks = pattern, read_ranks(vocabulary)
        if max(self.ranks.values(), default=0) >= 1 << 31:
            raise ValueError("ids must be below 2^31")
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": ""})
        pairs = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, rank = np.array(pairs, dtype=np.int32).reshape(-1, 3).T
        self._table("merges", left_id=left, right_id=right, rank=rank)
        self._table("pieces", id=np.array(list(self.ranks.values()), dtype=np.int32), piece=pa.array(list(self.ranks), pa.binary()))
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self._forget()

    def _table(self, name: str, **columns) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self.db.register(name, pa.table(columns))
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            out = self.db.execute(sql).to_arrow_table()
        self.db.unregister(name)
        return out.combine_chunks()

    def _forget(self) -> None:
        self.places, self.known = _Places(), 0
        self.flat, self.sizes, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _contract(self, sql: str, given: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words behind one another, and their number for each word."""
        lengths = np.array([len(w) for w in given], dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        wid = np.repeat(np.arange(len(given), dtype=np.int32), lengths)
        ids = self.byte_ids[np.frombuffer(b"".join(given), dtype=np.uint8)]
        pos = (np.arange(len(ids)) - np.repeat(begins, lengths)).astype(np.int32)
        out = self._query(sql, "start", wid=wid, pos=pos, id=ids)
        return out.column("id").to_numpy(), np.bincount(out.column("wid").to_numpy(), minlength=len(given))

    def _learn(self) -> None:
        """Contract the words met since the last time; a word that is a token as a whole stays that token."""
        fresh = [w.encode() for w in islice(self.places, self.known, None)]
        whole = np.array([self.ranks.get(w, -1) for w in fresh], dtype=np.int32)
        long = np.array([len(w) > SHORT for w in fresh], dtype=bool)
        groups = [np.flatnonzero(whole >= 0)]
        flats, sizes = [whole[groups[0]]], [np.ones(len(groups[0]), np.int64)]
        for sql, these in ((CONTRACT_SHORT, np.flatnonzero((whole < 0) & ~long)), (CONTRACT_LONG, np.flatnonzero((whole < 0) & long))):
            for at in range(0, len(these), TOGETHER):
                some = these[at : at + TOGETHER]
                flat, size = self._contract(sql, [fresh[i] for i in some])
                groups.append(some), flats.append(flat), sizes.append(size)
        flat, size = np.concatenate(flats), np.concatenate(sizes)
        starts = np.empty(len(fresh), np.int64)
        starts[np.concatenate(groups)] = np.cumsum(size) - size + len(self.flat)
        counts = np.empty(len(fresh), np.int64)
        counts[np.concatenate(groups)] = size
        self.flat = np.concatenate([self.flat, flat])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, counts])
        self.known = len(self.places)

    def encode(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lists of words, all behind one another, and their number for each list."""
        if len(self.places) > KEPT:
            self._forget()
        place = self.places
        at = np.fromiter((place[w] for part in parts for w in part), dtype=np.int64)
        if len(place) > self.known:
            self._learn()
        sizes = self.sizes[at]
        before = np.cumsum(sizes) - sizes
        ids = self.flat[np.repeat(self.starts[at] - before, sizes) + np.arange(int(sizes.sum()))]
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([len(p) for p in parts], dtype=np.int64)] if parts else np.zeros(0, np.int64)
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[memoryview]:
        """Bytes of lists of ids that lie behind one another. An id that is not in the vocabulary raises."""
        out = [memoryview(b"")] * len(sizes)
        part = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        pieces = self._query(DECODE, "coded", part=part, place=np.arange(len(ids), dtype=np.int32), id=ids.astype(np.int32))
        if not pieces.num_rows:
            if len(ids):
                raise ValueError("ids outside the vocabulary")
            return out
        lists = pieces.column("pieces").chunk(0)
        if len(lists.values) != len(ids):
            raise ValueError("ids outside the vocabulary")
        values = lists.values
        kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
        _, ends, data = values.buffers()
        cuts = np.frombuffer(ends, dtype=kind)[values.offset : values.offset + len(values) + 1]
        data, bounds = memoryview(data) if data else memoryview(b""), cuts[lists.offsets.to_numpy()]
        for i, p in enumerate(pieces.column("part").to_numpy()):
            out[p] = data[bounds[i] : bounds[i + 1]]
        return out


@lru_cache(maxsize=2)
def coder(vocabulary: str, pattern: str) -> Coder:
    """One coder for each vocabulary and Python worker, kept over tasks."""
    return Coder(vocabulary, pattern)


def _blocks(texts: list[str], pattern: str) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Rows and their words; about a block of words at a time, so a long text comes in several turns."""
    rows, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for part in words(text, pattern):
            rows.append(i), parts.append(part)
            held += len(part)
            if held >= BLOCK:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every row of `docs` as struct `row`, and `ids`, the token ids of its whole `text` in order."""
    vocabulary, pattern = vocabulary or default_vocabulary(), pattern or default_pattern()
    held = with_row(docs, text=F.col("text"))

    def make():
        known = coder(vocabulary, pattern)

        def step(rows, texts):
            own = [[np.zeros(0, np.int32)] for _ in texts]
            for places, parts in _blocks(texts, pattern):
                ids, sizes = known.encode(parts)
                for i, part in zip(places, np.split(ids, np.cumsum(sizes)[:-1])):
                    own[i].append(part)
            lists = [np.concatenate(p) for p in own]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int32)))
            return pa.RecordBatch.from_arrays([rows.column("row"), ids], names=["row", "ids"])

        return step

    return map_texts(held, make, f"row {held.schema['row'].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Struct `row` and `data`, the bytes of the column `ids` (null: none) of every row of `coded`."""
    vocabulary, pattern = vocabulary or default_vocabulary(), default_pattern()
    held = coded.select("row", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches):
        known = coder(vocabulary, pattern)
        for rows in batches:
            lists, start = rows.column("ids"), 0
            ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
            while start < len(rows):
                done = ends[start - 1] if start else 0
                stop = int(max(start + 1, np.searchsorted(ends, done + BLOCK, side="right")))
                part = lists.slice(start, stop - start)
                own = known.decode(part.flatten().to_numpy(), np.diff(part.offsets.to_numpy()))
                data = pa.array([bytes(d) for d in own], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("row").slice(start, stop - start), data], names=["row", "data"])
                start = stop

    ship_package(coded.sparkSession)
    return held.mapInArrow(run, f"row {held.schema['row'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of `docs` (doc_id, text).

    Each block of words is encoded, hashed, decoded and hashed again, so no text or list of
    ids is ever held whole beside its row.
    """
    vocabulary, pattern = vocabulary or default_vocabulary(), pattern or default_pattern()
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        known = coder(vocabulary, pattern)
        for rows, texts in grouped_texts(batches, 1 << 22):
            counts, of_ids, of_bytes = np.zeros(len(texts), np.int64), [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
            for places, parts in _blocks(texts, pattern):
                ids, sizes = known.encode(parts)
                little = memoryview(ids.astype("<u4")).cast("B")
                ends = np.cumsum(sizes)
                for i, n, end, data in zip(places, sizes.tolist(), ends.tolist(), known.decode(ids, sizes)):
                    counts[i] += n
                    of_ids[i].update(little[4 * (end - n) : 4 * end])
                    of_bytes[i].update(data)
            digests = [pa.array([h.hexdigest() for h in each], pa.string()) for each in (of_ids, of_bytes)]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(counts), *digests], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
