import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import ngram, queries
from riskweave.llm.words import hash_word, text_slices, token_stream, word_hashes

SF = "/root/testdata/sf0.001"


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    model = brute.KneserNey([r.text for r in docs if brute.fold(r.doc_id, 7) != 2], 2)
    got = {r.doc_id: r for r in queries.QUERIES["op10_lm_scoring"](spark, SF).collect()}
    n, v = sum(model.words.values()), len(model.words)
    assert len(got) == len(docs)
    for r in docs:
        tokens, own = model.tokens(r.text)[1:], got[r.doc_id]
        base = sum(math.log10((model.words[w] + 1) / (n + v + 1)) for w in tokens)
        assert own.held_out == (brute.fold(r.doc_id, 7) == 2) and own.train_tokens == n
        assert own.n_tokens == len(tokens) and own.n_known == sum(model.words[w] > 0 for w in tokens)
        assert own.base_score == pytest.approx(base, rel=1e-9) and own.score == pytest.approx(model.score(r.text), rel=1e-9)


@pytest.mark.parametrize("order", [2, 3])
def test_orders_and_spread_contexts(spark, order):
    texts = ["a b a b a c", "a a a a b", "b a A c", None, "", " ", "a b c d e f g", "a b a b a c", "a b b a d e"] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = ngram.train(docs, order)
    assert len(model.hot) > 2
    plain = brute.KneserNey(texts, order)
    for r in ngram.score(docs, model, "doc_id").collect():
        assert r.score == pytest.approx(plain.score(texts[r.doc_id]), rel=1e-9)
    # The probabilities of all known words and of an unknown one sum to one.
    scorer = ngram.Scorer(model)
    words = [hash_word(w) for w in "abcdefg"] + [1, hash_word("unseen")]
    before = [hash_word(w) for w in ("x", "a")][-(order - 1) :]
    tokens = np.array([x for w in words for x in (*before, w)], dtype=np.uint64)
    _, p = scorer.probabilities(tokens, np.arange(order - 1, len(tokens), order))
    assert p.sum() == pytest.approx(1)


def test_no_training_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    model = ngram.train(docs.where("false"))
    assert {r.score for r in ngram.score(docs, model, "doc_id").collect()} == {0.0}
    assert ngram.score(docs.where("false"), model, "doc_id").count() == 0


def test_null_ids_repeats_and_other_columns(spark):
    rows = [(1, "a b", 5), (1, "a b", 5), (None, "a c", 6), (3, None, 7), (4, "Z " * 50_000, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long").withColumn("words", F.lit(1))
    got = ngram.score_corpus(docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 3), (1, 3), (1, 3), (3, 1), (4, 50_001)]


def test_word_hashes_follow_words(spark):
    import pyarrow as pa

    texts = ["One two\tTWO ", None, "", "é\x0bx", "q" * 5000 + " one", " \n"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    for most in (1, 1 << 20):
        got = []
        for rows, data, offsets in text_slices([batch.slice(1), batch.slice(0, 1)], most):
            hashes, counts = word_hashes(data, offsets, block=64)
            got += [list(map(int, part)) for part in np.split(hashes, np.cumsum(counts)[:-1])]
        want = [[hash_word(w) for w in brute.WORD.findall(brute.ascii_lower(t or ""))] for t in [*texts[1:], texts[0]]]
        assert got == want
    tokens, begins = token_stream(np.array([7, 8, 9], dtype=np.uint64), np.array([2, 0, 1]), pad=1)
    assert tokens.tolist() == [2, 7, 8, 1, 2, 1, 2, 9, 1] and begins.tolist() == [0, 4, 6, 9]
