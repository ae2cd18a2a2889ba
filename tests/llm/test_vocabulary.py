"""Byte-level BPE, ranked search and spelling variants against plain single-machine forms."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.llm import bpe, ranked, variants
from riskweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VOCABULARY, PATTERN = bpe.default_vocabulary(), bpe.default_pattern()
LIBRARY = tiktoken.Encoding("library", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def documents(spark, texts, tmp_path, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(more)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return spark.read.parquet(f"{tmp_path}/documents.parquet")


def encode(texts):
    known, out, back = bpe.coder(VOCABULARY, PATTERN), [[] for _ in texts], [b"" for _ in texts]
    for rows, parts in bpe._blocks(texts, PATTERN):
        ids, sizes = known.encode(parts)
        for i, own, data in zip(rows, np.split(ids, np.cumsum(sizes)[:-1]), known.decode(ids, sizes)):
            out[i] += own.tolist()
            back[i] += bytes(data)
    return out, back


rng = random.Random(3)
ODD = [
    "", " ", "  a\n\n b's 'S 've  x y\x1c\x85z ", "a" * 3000, "ab" * 300, "漢字かな交じり文" * 30, "<|endoftext|> it's", "1234567890" * 30, "-" * 300, "՘֋꟎ x꟎",
    "".join(chr(rng.randrange(1, 0xD800)) for _ in range(2000)), "".join(chr(rng.choice([rng.randrange(0x10000, 0x110000), rng.randrange(32, 127)])) for _ in range(2000)),
    "".join(rng.choice("abcdeéñß") for _ in range(400)),
]


def test_encoding_is_the_library_s():
    ids, back = encode(ODD)
    for text, got, data in zip(ODD, ids, back):
        assert got == LIBRARY.encode_ordinary(text) and data == text.encode()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("abcn 's\té漢1.", max_size=200)), max_size=4))
def test_any_text(texts):
    assert encode(texts) == ([LIBRARY.encode_ordinary(t) for t in texts], [t.encode() for t in texts])


def test_long_words_by_either_query():
    """Both recursive queries reach the same fixpoint."""
    known = bpe.coder(VOCABULARY, PATTERN)
    given = [w.encode() for w in ("ab" * 60, "aaa" * 31, "nonnonnonon" * 9, "漢字" * 20, "x")]
    short, long = known._contract(bpe.CONTRACT_SHORT, given), known._contract(bpe.CONTRACT_LONG, given)
    assert all((a == b).all() for a, b in zip(short, long))


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 1000)
    text = "one two  three's\n" * 2000
    (ids,), (data,) = encode([text])
    assert ids == LIBRARY.encode_ordinary(text) and data == text.encode()


def test_unknown_ids_raise():
    with pytest.raises(ValueError):
        bpe.coder(VOCABULARY, PATTERN).decode(np.array([1, 2_000_000], dtype=np.int32), np.array([2]))


def test_encode_and_decode_tables(spark, tmp_path):
    texts = [None, "", "a b", "a b", *ODD]
    docs = documents(spark, texts, tmp_path, ids=F.lit("x"), row=F.lit(1))
    coded = bpe.encode(docs)
    for r in coded.collect():
        assert r.ids == LIBRARY.encode_ordinary(texts[r.row.doc_id] or "") and r.row.ids == "x"
    for r in bpe.decode(coded).collect():
        assert bytes(r.data) == (texts[r.row.doc_id] or "").encode()
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_op11_whole_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = LIBRARY.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    """docs: (doc_id, text); items: (item_id, text)."""
    counted = [(d, Counter(terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    total, df = sum(c.total() for _, c in counted), Counter(t for _, c in counted for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = set()
    for item, own in wanted.items():
        scores = []
        for d, c in counted:
            m = 100 - 90 + 90 * c.total() * len(counted) // total
            score = sum(math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            scores.append((-score, d is None, d or 0)) if score > 0 else None
        out |= {(item, i, None if missing else d, -s) for i, (s, missing, d) in enumerate(sorted(scores)[:k], 1)}
    return out


@pytest.mark.parametrize("postings", [ranked.POSTINGS, 7])
def test_search_against_brute_force(spark, tmp_path, postings):
    """Ties, repeated rows and items, nulls, texts without terms; the same in one block of items or in many."""
    rng = random.Random(5)
    names = ["Ab", "c1", "été", "漢", "the", "x" * 90, "İ", "d-e", "\x00q", "z\x7fz"]
    texts = [" ".join(rng.choices(names, k=rng.randrange(40))) for _ in range(150)]
    rows = [(i % 140, t) for i, t in enumerate(texts)] + [(None, "ab c1"), (None, None), (7, None), (8, ""), (9, "--"), (9, "the " * 3000)] + [(200 + i, "the c1") for i in range(30)]
    items = [(1, "The ab"), (1, "c1"), (2, "the"), (2, "the"), (3, None), (4, "unknown"), (None, "漢 été q"), (5, "z d x"), (6, "İ " + "x" * 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"item": F.lit(1), "score": F.lit("s")}).repartition(5)
    wanted = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(2))
    got = ranked.search(docs, wanted, 5, postings=postings).collect()
    assert {tuple(r) for r in got} == brute_search(rows, items, 5) and len(got) == 25


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(docs.limit(0), items).count() == ranked.search(docs, items.limit(0)).count() == 0
    assert ranked.search(docs, items).count() == 1


def test_long_text_in_blocks():
    text = "One two-three " * 5000
    assert [t for b in ranked.term_blocks(text, 1000) for t in b] == [t.encode() for t in terms(text)]
    assert ranked.term_counts("a" * 10_000)[b"a" * 10_000] == 1


def brute_variants(docs, least=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run) if h % 97 == 0 else len(run)
            counts[run[:at] + run[at + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    letters = {c for w in counts for c in w}
    out, form = {}, {}
    for w in counts:
        near = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[j:] for c in letters for i in range(len(w) + 1) for j in (i, i + 1)}
        near = sorted((-counts[v], v) for v in (near - {w}) if v in counts)
        form[w] = near[0][1] if near and -near[0][0] >= 2 * counts[w] else None
        out[w] = counts[w], len(near)
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, form[w], root, *out[w], counts.get(form[w]))
    return set(out.values())


def test_op13_whole_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_spelling_variants"](spark, SF).collect()
    assert {tuple(r) for r in got} == brute_variants(docs) and len(got) > 500
    assert sum(r.form is not None for r in got) > 10


def word_table(spark, counts, tmp_path):
    spark.createDataFrame(sorted(counts.items()), "word string, n long").repartition(4).write.parquet(f"{tmp_path}/words")
    return spark.read.parquet(f"{tmp_path}/words")


@pytest.mark.parametrize("part", [variants.PART, 40])
def test_pairs_in_crowded_cells(spark, tmp_path, part):
    """Many words of few letters: full cells, cut into parts or not, hold every pair once."""
    rng = random.Random(9)
    words = {"".join(rng.choices("abcdé", k=rng.randrange(5, 9))): rng.randrange(3, 50) for _ in range(1500)}
    words |= {"x" * 70: 3, "x" * 71: 9, "x" * 70 + "y": 4, "y" + "x" * 70: 4, "x" * 40_000: 5, "x" * 40_001: 6}
    table = word_table(spark, words, tmp_path)
    got = [tuple(r) for r in variants.near_pairs(table, variants.letter_groups(table), part).collect()]
    known = sorted(words)
    want = {(a, b) for i, a in enumerate(known) for b in known[i + 1 :] if abs(len(a) - len(b)) < 2 and variants.is_near(a.encode("latin-1"), b.encode("latin-1"))}
    assert len(got) == len(want) and {tuple(sorted((a, b))) for a, _, b, _ in got} == want
    assert all(words[a] == n and words[b] == m for a, n, b, m in got)


@settings(max_examples=200, deadline=None)
@given(st.text("abé", min_size=1, max_size=8), st.text("abé", min_size=1, max_size=8))
def test_one_letter(a, b):
    steps = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[j:] for c in "abé" for i in range(len(a) + 1) for j in (i, i + 1) if j <= len(a)}
    assert variants.is_near(a.encode("latin-1"), b.encode("latin-1")) == (b in steps - {a})


def test_chains_lead_to_their_end(spark):
    chain = [(f"w{i:02}", f"w{i + 1:02}") for i in range(21)] + [("w21", None), ("solo", None), ("v", "w05")]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w21" for w, f in chain if f}


def test_awkward_documents(spark, tmp_path):
    texts = [None, "", "naïve naïve naïve NAIVE naive naive", "colour colour color Color color color color ×÷×÷×", "gray1grey", "abcde " * 100_000, "abcdf " * 7, "abcdf"] * 2
    docs = documents(spark, texts, tmp_path, word=F.lit(1), n=F.lit("n"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {tuple(r) for r in variants.spelling_variants(docs).collect()} == brute_variants(rows)
    assert variants.spelling_variants(docs.limit(0)).count() == 0
