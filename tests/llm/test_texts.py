import hashlib
import zlib

import numpy as np
import pytest

from riskweave.llm import fuzzy, langid, packing
from riskweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def texts(spark, sf=SF):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_packing_is_an_exact_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    pieces, docs = {}, texts(spark)
    got = QUERIES["op4_packing"](spark, SF).collect()
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert pieces.keys() == docs.keys() and len({r.sequence_id for r in got}) == len(got)
    for key, own in pieces.items():
        ids = np.array(tokenizer.encode(docs[key].text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.offset, r.doc_tokens) == (at, 0, len(ids)) and r.length & (r.length - 1) == 0 and r.length <= 4096
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_parts_are_encoded_as_the_tokenizer_does():
    import random

    from tokenizers import Tokenizer

    tokenizer, own, rng = Tokenizer.from_file(packing.default_vocabulary()), packing.ChunkIds(packing.default_vocabulary(), kept=50), random.Random(1)
    signs = "abcXYZ019'-_!?.,<|>éÉßÿÀ×÷İıΣς漢字½ⅷ́­​ \x1c\x85\t\n\x0b\x0c힣ªºµ"
    for i in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) + " <|endoftext|>a" * (i % 50 == 0)
        assert own.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_buckets_hold_equal_lengths(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c " * 2000), (2, "d")], "doc_id long, text string")
    packing.write_buckets(packing.pack(docs), f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets").collect()
    assert all(len(r.ids) == 4 * r.length for r in back) and sum(r.length for r in back) == 6001 + 2
    assert packing.piece_lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and packing.piece_lengths(7, 4) == [4, 2, 1]


def brute_forward(pieces, log_piece, word):
    known = {p: i for i, p in pieces.letters()}
    word, total = "▁" + word, [np.zeros(log_piece.shape[1])]
    for end in range(1, len(word) + 1):
        ways = [total[at] + log_piece[known[word[at:end]]] for at in range(end) if word[at:end] in known]
        ways.append(total[end - 1] + sum(log_piece[pieces.byte[b]] for b in word[end - 1].encode()))
        total.append(np.logaddexp.reduce(ways))
    return total[-1]


def test_forward_sums_over_all_segmentations():
    pieces = langid.pieces(langid.default_vocabulary())
    log_piece = np.log(np.random.default_rng(0).dirichlet(np.ones(pieces.size), 3).T)
    scorer = langid.Scorer(langid.Model(langid.default_vocabulary(), ["a", "b", "c"], log_piece, np.zeros(3)), kept=4)
    words = ["the", "éléphant", "漢字", "zqß", "o", "undertaking" * 3, "w" * 300]
    for got, word in zip(scorer.forward(sorted(words, key=len)), sorted(words, key=len)):
        assert got == pytest.approx(brute_forward(pieces, log_piece, word), rel=1e-9)
    rows = [scorer.rows([w]) for w in words]
    sums, some = scorer.log_texts(["the the O", "", "12 ½", "漢字"])
    assert len(rows) == 7 and some.tolist() == [True, False, False, True]
    assert sums[0] == pytest.approx(2 * brute_forward(pieces, log_piece, "the") + brute_forward(pieces, log_piece, "o"))


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, got = texts(spark, sf), QUERIES["op7_language_id"](spark, sf).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(docs) and len(held) > 100
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.98


def plain_fingerprint(data):
    """The same signature from boundaries and chunk hashes worked out byte by byte."""
    if not data:
        return "0:::"
    levels = []
    for end in range(len(data)):
        rolled = 0
        for i, b in enumerate(reversed(data[max(0, end - 7) : end + 1])):
            rolled += int(fuzzy._ROLL[b]) * pow(0x9E3779B1, i, 1 << 32)
        x = rolled & 0xFFFFFFFF
        x ^= x >> 15
        x = x * 0x85EBCA6B & 0xFFFFFFFF
        x ^= x >> 13
        levels.append((x & -x).bit_length() - 1 if x else 32)
    level = 0
    while sum(v >= level for v in levels) >= 64:
        level += 1
    parts = []
    for k in range(level, level + 3):
        out, chunk = "", []
        for i, b in enumerate(data):
            chunk.append(b)
            if levels[i] >= k or i == len(data) - 1:
                total = sum((c + 1) * pow(fuzzy._BACK, j, 1 << 32) for j, c in enumerate(chunk)) & 0xFFFFFFFF
                out += chr(fuzzy.LETTERS[int(fuzzy.mix(np.array([total], dtype=np.uint64))[0]) >> 58])
                chunk = []
        parts.append(out)
    return ":".join([str(level), *parts])


def test_fingerprints_against_brute_force(spark):
    docs = texts(spark)
    order, got = sorted(docs, reverse=True), {r.doc_id: r for r in QUERIES["op1_fingerprints"](spark, SF).collect()}
    assert got.keys() == docs.keys()

    def like(a, b):
        (la, *sa), (lb, *sb) = a.split(":"), b.split(":")
        level = max(int(la), int(lb))
        if level - int(la) > 2 or level - int(lb) > 2:
            return 0.0
        x, y = sa[level - int(la)], sb[level - int(lb)]
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            row, last = [i], row
            for j, d in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (c != d)))
        return 1 - row[-1] / max(len(x), len(y), 1)

    for i, key in enumerate(order):
        own, following, r = docs[key].text or "", docs[order[(i + 1) % len(order)]].text or "", got[key]
        edited = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        if len(own) < 3000:
            assert (r.fingerprint, r.edited_fingerprint) == (plain_fingerprint(own.encode()), plain_fingerprint(edited.encode()))
        assert r.near_edited == pytest.approx(like(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(like(r.fingerprint, fuzzy.fingerprint(following.encode())))
    assert np.mean([r.near_edited for r in got.values()]) > np.mean([r.near_next for r in got.values()]) + 0.2


def test_small_edits_stay_near():
    rng = np.random.default_rng(0)
    text = bytes(rng.integers(97, 123, 20_000, dtype=np.uint8))
    a, b = fuzzy.fingerprint(text), fuzzy.fingerprint(text[:9000] + b"inserted" + text[9000:])
    same = sum(x == y for x, y in zip(a.split(":")[1], b.split(":")[1]))
    assert a != b and same >= 15 and fuzzy.fingerprint(b"a" * 5000).split(":")[1] and len(fuzzy.fingerprint(text).split(":")[1]) <= 64
