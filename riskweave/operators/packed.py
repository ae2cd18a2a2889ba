"""Blocks of packed vectors that meet in a product of two tables, and the nearest rows found there.

A block is one row: its ids and its vectors are columns of bytes. Spark's Cartesian product
reads the shuffled rows of both sides again for each pair of partitions, so no vector is
written more than once, however many blocks it meets. A task holds one block of queries and
one of the base at a time and keeps the k nearest rows met so far of each of its queries.

A matrix product bounds the squared distances from below; distances are only taken, as plain
differences of doubles, for the rows that may be among the k nearest. Products are made in
single precision about the centre of the queries, and again in double precision where that
is too coarse to tell rows apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

#: Bytes of the vectors of a block, and blocks of the base that a task packs and keeps.
BLOCK_BYTES, PART_BLOCKS = 8 << 20, 8
#: Rows of a block at least, where there are as many.
LEAST_ROWS = 1_024
#: Queries and base rows whose product is made at once.
TILE_QUERIES, TILE_ROWS = 512, 4_096
#: Found rows that wait for their distances.
MERGE_ROWS = 1 << 14
#: Stands for an id that is null; such rows are never the same.
NO_ID = np.iinfo(np.int64).min
_CHUNK = 4_000_000


def block_rows(rows: DataFrame) -> int:
    """Rows of a block; the first vector tells how long they are."""
    first = rows.select(F.size("vec").alias("dim")).first()
    each = 4 if rows.schema["vec"].dataType == ArrayType(FloatType()) else 8
    return max(LEAST_ROWS, min(1 << 15, BLOCK_BYTES // (each * max(1, first["dim"] if first else 1))))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows, of the type they have; null elements are nan."""
    if column.null_count:
        raise ValueError("a vector is null")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), sizes[0] if len(sizes) else 0)


def _pack(longs: list[str], rows: int, prefix: str):
    def one(no: int, pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
        x = np.concatenate([matrix(p.column("vec")) for p in pieces])
        numbers = {c: np.concatenate([p.column(c).fill_null(NO_ID).to_numpy(zero_copy_only=False) for p in pieces]).astype(np.int64) for c in longs}
        packed = {"no": [no], "size": [len(x)], "width": [x.dtype.itemsize], **{c: [v.tobytes()] for c, v in numbers.items()}, "vec": [x.tobytes()]}
        return pa.RecordBatch.from_pydict({prefix + c: pa.array(v, pa.binary() if isinstance(v[0], bytes) else pa.int32()) for c, v in packed.items()})

    def pack(batches):
        no, held, size = 0, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, rows - size)
                held, size, at = [*held, piece], size + piece.num_rows, at + piece.num_rows
                if size == rows:
                    yield one(no, held)
                    no, held, size = no + 1, [], 0
        if held:
            yield one(no, held)

    return pack


def blocks(df: DataFrame, longs: list[str], rows: int, prefix: str) -> DataFrame:
    """The rows of each partition, in their order, as blocks of up to `rows` of them."""
    kinds = [f"{prefix}{c} int" for c in ("no", "size", "width")] + [f"{prefix}{c} binary" for c in (*longs, "vec")]
    return df.select(*[F.col(c).cast("long").alias(c) for c in longs], "vec").mapInArrow(_pack(longs, rows, prefix), ", ".join(kinds))


class Block:
    """Ids, other numbers and vectors of a packed block; `x` has the vectors as they came."""

    def __init__(self, batch: pa.RecordBatch, i: int, prefix: str, key: str):
        value = lambda c: batch.column(prefix + c)[i]
        self._value, size = value, value("size").as_py()
        self.ids = self.numbers(key)
        kind = np.float32 if value("width").as_py() == 4 else np.float64
        x = np.frombuffer(value("vec").as_buffer(), kind).copy()
        self.x = x.reshape(size, len(x) // size)

    def numbers(self, name: str) -> np.ndarray:
        return np.frombuffer(self._value(name).as_buffer(), np.int64).copy()

    def __len__(self) -> int:
        return len(self.ids)

    def centre(self, at: np.ndarray) -> None:
        """Squares about a centre; matrices for products are made when they are asked for."""
        moved = self.x.astype(np.float64) - at
        self.square, self._moved, self._made = np.einsum("ij,ij->i", moved, moved), moved, {}

    def sharp(self, kind, query: bool) -> np.ndarray:
        """Rows whose products are 2qb - (1 - error) b², for queries q and base rows b."""
        if kind not in self._made:
            last = np.ones(len(self)) if query else -(1 - _error(self, kind)) * self.square
            self._made[kind] = np.column_stack([(2.0 if query else 1.0) * self._moved, last]).astype(kind)
        return self._made[kind]


def _error(block: Block, kind) -> float:
    """Bounds the rounding of a product, as a share of q² + b²."""
    return (4 * block.x.shape[1] + 32) * float(np.finfo(kind).eps)


def _set_bits(mask: np.ndarray) -> np.ndarray:
    """Positions that are true, of which there are few: eight at a time are passed over."""
    flat = mask.ravel()
    whole = len(flat) // 8 * 8
    eights = flat[:whole].reshape(-1, 8)
    some = np.flatnonzero(flat[:whole].view(np.uint64))
    at, bit = np.nonzero(eights[some])
    return np.concatenate([some[at] * 8 + bit, whole + np.flatnonzero(flat[whole:])])


class Nearest:
    """The k nearest rows that each query of a block has met so far; equal distances keep the smaller id."""

    def __init__(self, queries: Block, k: int, exclude_self: bool, distinct: bool):
        self.queries, self.k, self.exclude_self, self.distinct = queries, k, exclude_self, distinct
        self.ids, self.d = np.zeros((len(queries), k), np.int64), np.full((len(queries), k), np.inf)
        self.limit, self.found, self.waiting = np.full(len(queries), np.inf), [], 0
        x = queries.x.astype(np.float64)
        finite = np.isfinite(x)
        self.at = np.where(finite, x, 0).sum(axis=0) / np.maximum(1, finite.sum(axis=0))
        self.own = x
        queries.centre(self.at)

    def _same(self, at: np.ndarray, base: Block, near: np.ndarray) -> np.ndarray:
        return (self.queries.ids[at] == base.ids[near]) & (base.ids[near] != NO_ID)

    def _candidates(self, at: np.ndarray, base: Block, s: int, e: int, kind) -> tuple[np.ndarray, np.ndarray]:
        """Positions of queries and of rows s..e that may be among their k nearest."""
        error, own, square = _error(base, kind), self.queries.square[at], base.square[s:e]
        with np.errstate(invalid="ignore", over="ignore"):
            score, limit = self.queries.sharp(kind, True)[at] @ base.sharp(kind, False)[s:e].T, self.limit[at].copy()
            new = np.flatnonzero(~np.isfinite(limit))
            if len(new) and e - s >= self.k:
                high = (1 + error) * own[new, None] + 2 * error * square - score[new]
                if self.exclude_self:
                    high[self._same(at[new, None], base, np.arange(s, e)[None, :])] = np.inf
                high[~np.isfinite(high)] = np.inf
                limit[new] = np.partition(high, self.k - 1, axis=1)[:, self.k - 1]
                self.limit[at[new]] = limit[new]
            least = (1 - error) * own - limit - 1e4 * float(np.finfo(kind).tiny)
            found, near = np.divmod(_set_bits(score >= least.astype(kind)[:, None]), e - s)
        return found, near + s

    def meet(self, at: np.ndarray, base: Block, s: int, e: int) -> None:
        """Queries at the positions `at` meet the rows s..e of the base."""
        step = max(1, _CHUNK // (e - s))
        for i in range(0, len(at), step):
            some = at[i : i + step]
            # Squares beyond that range have no product in single precision.
            coarse = max(np.fmax.reduce(self.queries.square[some]), np.fmax.reduce(base.square[s:e])) < 1e30
            found, near = self._candidates(some, base, s, e, np.float32) if coarse else (None, None)
            if found is None or len(found) > (16 * self.k + 64) * len(some):
                found, near = self._candidates(some, base, s, e, np.float64)
            if len(found):
                self.found.append((some[found], near))
                self.waiting += len(found)
                if self.waiting >= MERGE_ROWS:
                    self.merge(base)

    def merge(self, base: Block) -> None:
        """Distances of what was found in this block of the base, and the k nearest anew."""
        if not self.found:
            return
        at, near = (np.concatenate(c) for c in zip(*self.found))
        self.found, self.waiting = [], 0
        if self.exclude_self:
            other = ~self._same(at, base, near)
            at, near = at[other], near[other]
        d, cut = np.empty(len(at)), max(1, _CHUNK // max(1, base.x.shape[1]))
        for j in range(0, len(at), cut):
            gap = self.own[at[j : j + cut]] - base.x[near[j : j + cut]].astype(np.float64)
            d[j : j + cut] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        well = np.isfinite(d) & (d <= self.d[at, -1])
        at, near, d = at[well], near[well], d[well]
        if not len(at):
            return
        touched = np.unique(at)
        known = np.isfinite(self.d[touched])
        row, column = np.nonzero(known)
        queries = np.concatenate([touched[row], at])
        ids = np.concatenate([self.ids[touched[row], column], base.ids[near]])
        d = np.concatenate([self.d[touched[row], column], d])
        order = np.lexsort((ids, d, queries))
        queries, ids, d = queries[order], ids[order], d[order]
        if self.distinct:
            new = np.ones(len(d), bool)
            new[1:] = (queries[1:] != queries[:-1]) | (ids[1:] != ids[:-1]) | (d[1:] != d[:-1])
            queries, ids, d = queries[new], ids[new], d[new]
        rank = np.arange(len(d)) - np.searchsorted(queries, queries)
        first = rank < self.k
        self.d[touched], self.ids[touched] = np.inf, 0
        self.d[queries[first], rank[first]], self.ids[queries[first], rank[first]] = d[first], ids[first]
        self.limit[touched] = np.minimum(self.limit[touched], self.d[touched, -1] ** 2 * (1 + 1e-12))

    def rows(self) -> pa.RecordBatch:
        at, rank = np.nonzero(np.isfinite(self.d))
        queries, ids = self.queries.ids[at], self.ids[at, rank]
        long = lambda v: pa.array(v, pa.int64(), mask=v == NO_ID)
        return pa.RecordBatch.from_pydict({"query_id": long(queries), "neighbor_id": long(ids), "distance": pa.array(self.d[at, rank])})


def nearest(left: DataFrame, right: DataFrame, k: int, exclude_self: bool, meets: Callable[[Block, Block], Iterator], distinct: bool = False) -> DataFrame:
    """(query_id, neighbor_id, distance): up to k rows for each query and partition of the base.

    `meets` yields which queries of a block meet which rows of another: positions, first and last row.
    """

    def best(batches):
        no, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if held is None or batch.column("q_no")[i].as_py() != no:
                    if held is not None:
                        yield held.rows()
                    no = batch.column("q_no")[i].as_py()
                    held = Nearest(Block(batch, i, "q_", "query_id"), k, exclude_self, distinct)
                base = Block(batch, i, "b_", "id")
                base.centre(held.at)
                for at, s, e in meets(held.queries, base):
                    held.meet(at, base, s, e)
                held.merge(base)
        if held is not None:
            yield held.rows()

    # The hint keeps the product from being made by a broadcast, which would pass the driver.
    pairs = left.crossJoin(right.hint("shuffle_replicate_nl"))
    return pairs.mapInArrow(best, "query_id long, neighbor_id long, distance double")
