"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks of bytes that are hashed on their own. The hash of a whole text
is the sum of its chunk hashes, each shifted by the length of what follows it, modulo fixed
primes, so chunks of a huge document may be hashed anywhere and in any order. Texts with
equal fingerprints are then compared chunk by chunk, and a class whose texts differ is split.

Only texts that may have a copy are moved: a sieve of fixed size, made of the codes of all
texts with an equal fingerprint, tells them where they lie. A sieve that is too full lets
more texts through, never fewer.

Null text counts as empty and equals other empty texts. A null doc_id comes after all
numbers. Rows repeated in full are copies like others. A very long text is hashed and
compared by chunks. An empty table gives an empty result. Further columns of the input may
have any name.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import WHITE, release_states, row_columns, with_row
from riskweave.session import materialize, ship_package

#: Primes below 2^31 with a base each; four give 124 bits.
FIELDS = ((2147483647, 1103515245), (2147483629, 1664525), (2147483587, 22695477), (2147483579, 134775813))
CHUNK = 1 << 16
#: Words of 64 bits in the sieve: 8 MB, whatever the size of the corpus.
SIEVE_WORDS = 1 << 20


def normalised(text: Column) -> Column:
    """Null as empty, each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")


def chunks(data: Column, size: int) -> Column:
    """Array of (index, bytes after the chunk, bytes) over a binary column; one empty chunk if it is empty."""
    total = F.octet_length(data).cast("long")
    count = F.greatest(F.lit(1), F.ceil(total / size)).cast("int")

    def one(i: Column) -> Column:
        after = F.greatest(F.lit(0).cast("long"), total - (i + 1).cast("long") * size)
        return F.struct(i.alias("index"), after.alias("after"), F.substring(data, i * size + 1, F.lit(size)).alias("part"))

    return F.transform(F.sequence(F.lit(0), count - 1), one)


def _names(fields) -> list[str]:
    return [f"h{i}" for i in range(len(fields))]


def _keys(fields) -> list[str]:
    """What a class of equal fingerprints is found by."""
    return ["bytes", *_names(fields)]


def _powers(fields, size: int) -> list[np.ndarray]:
    """For each field the powers of its base from size - 1 down to 0."""
    powers = []
    for p, base in fields:
        out = [1]
        for _ in range(size - 1):
            out.append(out[-1] * base % p)
        powers.append(np.array(out[::-1], dtype=np.int64))
    return powers


def _hash_chunk(part, fields, powers, size: int) -> list[int]:
    # One is added to each byte, so leading zero bytes count too.
    data = np.frombuffer(part, dtype=np.uint8).astype(np.int64) + 1
    return [int(data @ power[size - len(data) :]) % p for (p, _), power in zip(fields, powers)]


def chunk_hashes(parts: DataFrame, *keep: str, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """Columns `keep` and h0, h1, ...: the shifted hash of each chunk `part` with `after` bytes behind it.

    The sum over the chunks of a text, modulo each prime, is the text's hash. A table that
    already holds its documents in parts can be hashed by this function directly.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema if f.name in keep)

    def run(batches):
        release_states()
        powers = _powers(fields, size)
        for rows in batches:
            sums = [[] for _ in fields]
            for part, after in zip(rows.column("part"), rows.column("after").to_pylist()):
                for (p, base), own, held in zip(fields, _hash_chunk(part.as_buffer(), fields, powers, size), sums):
                    held.append(own * pow(base, after, p) % p if after else own)
            kept = [rows.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, *[pa.array(h, pa.int64()) for h in sums]], names=[*keep, *_names(fields)])

    ship_package(parts.sparkSession)
    return parts.select(*keep, "after", "part").mapInArrow(run, ", ".join([schema, *[f"{n} long" for n in _names(fields)]]))


def fingerprints(docs: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """uid, doc_id, sha, look, bytes and h0... of every row of `docs` (doc_id, text); look is the code of the sieve."""
    given = ["doc_id", "sha", "look", "bytes"]
    normal = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", normalised(F.col("text")).alias("norm"))
    parts = normal.select(
        "uid", "doc_id", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("look"), F.octet_length("norm").cast("long").alias("bytes"),
        F.explode(chunks(F.col("norm").cast("binary"), size)).alias("c"),
    ).select("uid", *given, "c.after", "c.part")
    hashed = chunk_hashes(parts, "uid", *given, fields=fields, size=size)
    sums = [(F.sum(n) % p).alias(n) for n, (p, _) in zip(_names(fields), fields)]
    return hashed.groupBy("uid").agg(*[F.first(c).alias(c) for c in given], *sums)


def with_fingerprint(rows: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """`rows` with bytes and h0... of their column `norm`; no row moves, the chunk hashes are combined in place."""

    @F.arrow_udf(", ".join(f"{n} long" for n in _names(fields)))
    def whole(data: pa.Array) -> pa.Array:
        release_states()
        powers = _powers(fields, size)
        out = []
        for value in data:
            value, held = memoryview(value.as_buffer()), (0,) * len(fields)
            for start in range(0, len(value), size):
                part = value[start : start + size]
                held = combine(held, _hash_chunk(part, fields, powers, size), len(part), fields)
            out.append(held)
        sums = [pa.array([h[i] for h in out], pa.int64()) for i in range(len(fields))]
        return pa.StructArray.from_arrays(sums, names=_names(fields))

    ship_package(rows.sparkSession)
    hashed = rows.withColumns({"bytes": F.octet_length("norm").cast("long"), "_h": whole(F.col("norm").cast("binary"))})
    return hashed.withColumns({n: F.col(f"_h.{n}") for n in _names(fields)}).drop("_h")


def sieve(looks: DataFrame) -> DataFrame:
    """Words (word, bits) of a filter in which each `look` of the table has set a bit: at most `SIEVE_WORDS` rows."""
    at = looks.select(F.col("look").bitwiseAND(F.lit(64 * SIEVE_WORDS - 1)).alias("at"))
    words = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits"))
    return materialize(words, "exact-sieve")


def sifted(rows: DataFrame, words: DataFrame, look: Column) -> DataFrame:
    """`rows` with `maybe`: true for every code of the sieve, and for few others."""
    coded = rows.withColumn("_look", look)
    coded = coded.withColumn("word", F.shiftright(F.col("_look").bitwiseAND(F.lit(64 * SIEVE_WORDS - 1)), 6))
    bit = F.expr("shiftleft(1L, cast(_look & 63 as int))")
    found = coded.join(F.broadcast(words), "word", "left")
    return found.withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False))).drop("_look", "word", "bits")


def _first_of(uid: Column) -> Column:
    """Order in which the rows of a class come."""
    return F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), uid.alias("uid"))


def classes(docs: DataFrame, fields=FIELDS, size: int = CHUNK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Codes of the rows of `docs` (doc_id, text), the classes of two or more equal fingerprints, and the sieve of their texts.

    The classes have bytes, h0..., `first` (doc_id and uid of the row that stays), `n` rows,
    and `kept_rows` with the doc_id that stays.
    """
    keys = _keys(fields)
    coded = materialize(fingerprints(docs, fields, size), "exact-codes")
    each = coded.groupBy(*keys, "doc_id").agg(F.min(_first_of(F.col("uid"))).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = each.groupBy(*keys).agg(
        F.min("first").alias("first"), F.sum("n").alias("n"), F.min(F.struct("first", "n")).alias("least")
    ).where(F.col("n") > 1)
    copies = materialize(groups.select(*keys, "first", "n", F.col("least.n").alias("kept_rows")), "exact-classes")
    looks = coded.select(*keys, "look").distinct().join(copies.select(*keys).hint("shuffle_merge"), keys, "left_semi")
    return coded, copies, sieve(looks.select("look"))


def differing(rows: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """The classes (bytes, h0...) of `rows` (norm, bytes, h0...) whose texts are not all equal.

    For each chunk place of a class the least and the greatest chunk are streamed together,
    first inside a task, so a class of any size meets as a few rows. They agree at every
    place if and only if all texts of the class are equal.
    """
    keys = _keys(fields)
    parts = rows.select(*keys, F.explode(chunks(F.col("norm").cast("binary"), size)).alias("c"))
    places = parts.groupBy(*keys, F.col("c.index").alias("index")).agg(F.min("c.part").alias("low"), F.max("c.part").alias("high"))
    return materialize(places.where(F.col("low") != F.col("high")).select(*keys).distinct(), "exact-differing")


def told_apart(rows: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """`rows` (uid, norm, bytes, h0...) with `variant`, equal for equal texts of a class and for no others.

    Each different chunk at a place of a class is named by the least uid that has it; the
    names of a text in order say which text it is.
    """
    keys = _keys(fields)
    parts = rows.select("uid", *keys, F.explode(chunks(F.col("norm").cast("binary"), size)).alias("c")).select("uid", *keys, "c.index", "c.part")
    names = parts.groupBy(*keys, "index", "part").agg(F.min("uid").alias("name"))
    named = parts.join(names.hint("shuffle_merge"), [*keys, "index", "part"])
    variants = named.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("index", "name"))).alias("variant"))
    return rows.drop("norm").join(variants, "uid")


def exact_duplicates(docs: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the smallest doc_id stays, and of rows with the same doc_id and equal
    texts one is kept.
    """
    keys = _keys(fields)
    docs = docs.select("doc_id", "text")
    coded, copies, words = classes(docs, fields, size)
    suspects = _suspects(sifted(docs.select("doc_id", normalised(F.col("text")).alias("norm")), words, F.xxhash64("norm")), fields, size)
    split = differing(suspects, fields, size)

    def told(rows: DataFrame) -> DataFrame:
        alone = F.col("n").isNull()
        return rows.select(
            "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).alias("group_size"),
            (alone | (F.col("uid") == F.col("first.uid"))).alias("kept"), F.col("sha").alias("text_sha256"),
        )

    if split.isEmpty():
        return told(coded.join(copies, keys, "left"))
    apart = told_apart(_rows_of(suspects.withColumn("sha", F.sha2("norm", 256)), split, keys), fields, size)
    groups = apart.groupBy(*keys, "variant").agg(F.min(_first_of(F.col("uid"))).alias("first"), F.count(F.lit(1)).alias("n"))
    return told(coded.join(split, keys, "left_anti").join(copies, keys, "left")).unionByName(told(apart.join(groups, [*keys, "variant"])))


def _suspects(rows: DataFrame, fields, size: int) -> DataFrame:
    """The sifted rows (with `norm`) whose text may have a copy, with bytes and h0..."""
    return with_fingerprint(rows.where("maybe").drop("maybe"), fields, size)


def _rows_of(rows: DataFrame, split: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the classes `split`, written with a uid of their own."""
    found = rows.join(split.hint("shuffle_merge"), keys, "left_semi")
    return materialize(found.withColumn("uid", F.monotonically_increasing_id()), "exact-split")


def drop_exact_duplicates(docs: DataFrame, fields=FIELDS, size: int = CHUNK) -> DataFrame:
    """The rows of `docs` that `exact_duplicates` keeps, with the columns of `docs`.

    Of rows with the same doc_id and equal texts any one may stay.
    """
    keys = _keys(fields)
    _, copies, words = classes(docs.select("doc_id", "text"), fields, size)
    held = sifted(with_row(docs, doc_id=F.col("doc_id"), norm=normalised(F.col("text"))), words, F.xxhash64("norm"))
    suspects = _suspects(held, fields, size)
    split = differing(suspects.drop("row"), fields, size)
    found = suspects.drop("norm").join(copies.select(*keys, F.col("first.id").alias("first"), "kept_rows").hint("shuffle_merge"), keys, "left")
    stay = found.where(F.col("kept_rows").isNull() | F.col("doc_id").eqNullSafe(F.col("first")))
    kept = held.where(~F.col("maybe")).select("row")
    if not split.isEmpty():
        stay = stay.join(split, keys, "left_anti")
        apart = told_apart(_rows_of(suspects, split, keys), fields, size)
        kept = kept.unionByName(apart.groupBy(*keys, "variant").agg(F.min_by("row", _first_of(F.col("uid"))).alias("row")).select("row"))
    if copies.where("kept_rows > 1").isEmpty():
        return row_columns(kept.unionByName(stay.select("row")), docs.columns)
    # The doc_id that stays comes with several rows of equal text: one of them is taken.
    again = F.coalesce(F.col("kept_rows") > 1, F.lit(False))
    repeated = stay.where(again).groupBy(*keys).agg(F.first("row").alias("row"))
    return row_columns(kept.unionByName(stay.where(~again).select("row")).unionByName(repeated.select("row")), docs.columns)


def combine(left: tuple[int, ...], right: tuple[int, ...], right_bytes: int, fields=FIELDS) -> tuple[int, ...]:
    """Hash of a text from the hashes of its two parts."""
    return tuple((a * pow(base, right_bytes, p) + b) % p for a, b, (p, base) in zip(left, right, fields))


def fold_hash(data: bytes, fields=FIELDS) -> tuple[int, ...]:
    """Byte by byte, for tests of the chunked form."""
    return tuple(reduce(lambda h, c: (h * base + c + 1) % p, data, 0) for p, base in fields)
