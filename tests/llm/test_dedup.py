import random

import brute
import pytest
import xxhash
from pyspark.sql import functions as F

from riskweave.llm import exact, simhash
from riskweave.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_simhash_against_brute_force(spark):
    docs, codes = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect(), {}
    for r in docs:
        words = brute.WORD.findall(brute.ascii_lower(r.text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        codes[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    least = {i: i for i in codes}

    def top(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in codes:
        for b in codes:
            if a < b and (codes[a] ^ codes[b]).bit_count() <= 3:
                x, y = sorted((top(a), top(b)))
                least[y] = x
    got = QUERIES["op3_simhash"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{c:016x}", top(i)) for i, c in codes.items()}
    assert len({top(i) for i in codes}) < len(codes)


@pytest.mark.parametrize("distance,segments", [(3, 2), (3, 4), (5, 2)])
def test_links_are_complete(spark, distance, segments):
    rng = random.Random(distance)
    codes = {rng.getrandbits(64) for _ in range(60)}
    for c in list(codes):
        for bits in range(1, 7):
            codes.add(c ^ sum(1 << b for b in rng.sample(range(64), bits)))
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    got = simhash.links(spark.createDataFrame(signed, "fp long"), distance, segments).collect()
    pairs = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in got}
    want = {frozenset((a, b)) for a in codes for b in codes if a < b and (a ^ b).bit_count() <= distance}
    assert pairs == want


def test_exact_against_sql(spark):
    import oracle

    assert not oracle.compare(spark, oracle.duck(SF), "op9", QUERIES["op9_exact_dedup"], ORACLES["op9_exact_dedup"], SF)


def test_chunk_hashes_compose():
    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(1000))
    for at in (0, 1, 500, 1000):
        assert exact.combine(exact.fold_hash(data[:at]), exact.fold_hash(data[at:]), 1000 - at) == exact.fold_hash(data)
    assert exact.fold_hash(b"\0") != exact.fold_hash(b"\0\0")


@pytest.mark.parametrize("size", [3, 16, 1 << 16])
def test_fingerprints_do_not_depend_on_chunks(spark, size):
    texts = ["", "a", "abc  def", "é" * 40, "x" * 257]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in exact.fingerprints(docs, size=size).collect():
        assert (r.h0, r.h1, r.h2, r.h3) == exact.fold_hash(" ".join(texts[r.doc_id].split()).encode())


def test_colliding_fingerprints_are_told_apart(spark):
    texts = ["ab", "ba", "ab", "cd", "dc", "dc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact.exact_duplicates(docs, fields=((2, 1),), size=1).collect()}
    assert got == {0: (0, 2, True), 2: (0, 2, False), 1: (1, 1, True), 3: (3, 1, True), 4: (4, 2, True), 5: (4, 2, False)}


def test_dropped_rows_of_colliding_fingerprints(spark):
    # Rows of two names that collide in a weak field, in texts of several chunks, repeated and with a null id.
    rows = [(5, "abcdef"), (4, "badcfe"), (3, "abcdef"), (None, "badcfe"), (4, "badcfe"), (9, "abcdfe"), (8, "xy"), (None, "ef abcd"), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h0", F.lit("clash"))
    kept = exact.drop_exact_duplicates(docs, fields=((2, 1),), size=4)
    assert kept.columns == docs.columns
    got = sorted((r.text, r.doc_id) for r in kept.collect())
    assert got == [("", 7), ("abcdef", 3), ("abcdfe", 9), ("badcfe", 4), ("ef abcd", None), ("xy", 8)]
    flags = exact.exact_duplicates(docs, fields=((2, 1),), size=4).collect()
    assert len(flags) == 9 and sum(r.kept for r in flags) == 6
    assert {(r.doc_id, r.keep_id, r.group_size) for r in flags} >= {(5, 3, 2), (3, 3, 2), (4, 4, 3), (None, 4, 3), (9, 9, 1)}


def test_sieve_lets_no_copy_fall_through(spark):
    looks = spark.range(5000).select(F.xxhash64("id").alias("look"))
    words = exact.sieve(looks)
    others = spark.range(5000, 55000).select(F.xxhash64("id").alias("look"))
    assert exact.sifted(looks, words, F.col("look")).where("maybe").count() == 5000
    assert exact.sifted(others, words, F.col("look")).where("maybe").count() < 50
    assert exact.sifted(looks, exact.sieve(looks.limit(0)), F.col("look")).where("not maybe").count() == 5000


def test_whole_fingerprint_equals_chunk_sums(spark):
    texts = ["", "a", "é" * 40, "x" * 257]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, norm string")
    for r in exact.with_fingerprint(docs, size=16).collect():
        assert (r.bytes, r.h0, r.h1, r.h2, r.h3) == (len(r.norm.encode()), *exact.fold_hash(r.norm.encode()))


def test_dropped_rows_keep_one_of_each(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a  b c"), (None, "a b c"), (None, "z"), (7, "q"), (7, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit(0))
    got = sorted((r.doc_id or 0, r.text) for r in exact.drop_exact_duplicates(docs).collect())
    assert got == [(0, "z"), (1, "a b c"), (7, "q"), (7, "r")]
    near = sorted((r.doc_id or 0, r.text) for r in simhash.drop_near_duplicates(docs).collect())
    assert len(near) == 4 and (1, "a b c") in near


def test_texts_that_stay_are_not_moved_by_near_dedup(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 10)
    try:
        docs = spark.read.parquet(f"{SF}/documents.parquet")
        docs = docs.unionByName(docs.limit(9).withColumn("doc_id", F.col("doc_id") + 10**6))
        kept = simhash.drop_near_duplicates(docs)
        assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().toString()
        rows = sorted(map(str, kept.collect()))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert rows == sorted(map(str, simhash.drop_near_duplicates(docs).collect())) and len(rows) <= docs.count() - 9
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
