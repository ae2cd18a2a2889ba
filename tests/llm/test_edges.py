"""Every registered corpus query on tables of awkward rows, and on empty tables."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import common, langid
from riskweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " \t\n", "one", "One  two\nTHREE", "One two THREE", "one two three four five " * 30_000, "x" * 50_000,
    "漢字 és €uro ñandú ß İ ſ", "the the the the", "same text here", "same text here", "same  text\there", "<|endoftext|> it's 12 '", "\x1c a\x85b", "$$$ %%%",
]
CLASHES = {"row": "1", "uid": "'u'", "words": "2.0", "tokens": "cast(null as string)", "fp": "3", "h0": "4",
           "kept": "true", "part": "5", "held_out": "6", "score": "'s'", "rest": "7", "n": "8", "p": "9"}


def write(spark, path, docs, pages, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *[f"{v} as {k}" for k, v in CLASHES.items()])
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"key": F.lit(1), "file": F.lit("f")}).write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"y": F.lit(1), "domain": F.lit(2)}).write.parquet(f"{path}/labels.parquet")
    items = [(1, "One two"), (1, None), (2, ""), (None, "same TEXT"), (None, "one")] if docs else []
    spark.createDataFrame(items, "item_id long, text string").withColumns({"item": F.lit(1), "term": F.lit("t")}).write.parquet(f"{path}/benchmark.parquet")
    return str(path)


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    docs = [(i, t, ["en", None, "fr"][i % 3], None, None) for i, t in enumerate(TEXTS)]
    docs += [(3, "one", "en", "s", 3), (3, "one", "en", "s", 3), (None, "one", None, None, None), (None, None, None, None, None), (-5, "negative id", "en", "s", 0)]
    pages = [(1, "http://A.example.com:80/x?y#z", "<p>"), (2, "http://a.example.com:80/x?y", "<p>"), (2, "http://a.example.com:80/x?y", "<p>"), (None, None, None), (None, "no url\n", ""),
             (4, "http://[bad", ""), (-9, "", "é" * 70_000), (5, "https://example.org", None)]
    labels = [(0, 1, 0), (1, 0, 1), (1, 0, 1), (2, None, None), (None, 1, 1), (4, 1, 0), (9, 0, 0), (99, 1, 1), (11, 1, 0), (12, 1, 1)]
    return write(spark, tmp_path_factory.mktemp("awkward"), docs, pages, labels), len(docs), len(pages)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward_rows(spark, awkward, name):
    path, docs, pages = awkward
    got = QUERIES[name](spark, path).collect()
    if name in ("op12_ranked_search", "op13_spelling_variants"):
        # Their rows are items and words; values are compared in test_vocabulary.
        assert len(got) == len(set(got)) > 0
    elif name == "op4_packing":
        whole = [r for r in got if r.start == 0]
        assert len(whole) == docs and sum(r.length for r in got) == sum(r.doc_tokens for r in whole)
    else:
        assert len(got) == (pages if name == "op5_warc_index" else docs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_stages_on_awkward_rows(spark, awkward, empty):
    for path in (awkward[0], empty):
        docs = before = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, path).cache()
            assert docs.columns == before.columns and docs.count() <= before.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, path).collect()


def test_results_named_in_docstrings(spark, awkward):
    path = awkward[0]
    exact = QUERIES["op9_exact_dedup"](spark, path).collect()
    assert sum(r.kept for r in exact) == len({r.text_sha256 for r in exact})
    ones = [r for r in exact if r.doc_id == 3]
    assert len(ones) == 3 and sum(r.kept for r in ones) == 1 and {r.group_size for r in ones} == {4}
    langs = {r.doc_id: r for r in QUERIES["op7_language_id"](spark, path).collect()}
    assert langs[0].lang_pred == langs[1].lang_pred == langs[15].lang_pred == "und" and langs[0].score == 0
    warc = QUERIES["op5_warc_index"](spark, path).collect()
    assert sorted((r.page_id, r.record_type) for r in warc if r.refers_to == 2) == [(1, "revisit")]
    assert sum(r.page_id == 2 and r.record_type == "response" for r in warc) == 2
    simhash = [r for r in QUERIES["op3_simhash"](spark, path).collect() if r.doc_id in (0, 1, 2)]
    assert {(r.fingerprint, r.component_id) for r in simhash} == {("0" * 16, 0)}
    coded = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, path).collect()}
    assert coded[0] == coded[0] and (coded[0].n_tokens, coded[0].ids_sha256) == (coded[1].n_tokens, coded[1].decoded_sha256) and coded[0].n_tokens == 0
    ranked = QUERIES["op12_ranked_search"](spark, path).collect()
    assert {r.item_id for r in ranked} == {1, None} and all(r.score > 0 for r in ranked)
    words = {r.word: r.n for r in QUERIES["op13_spelling_variants"](spark, path).collect()}
    assert words["three"] > 29_000 and "x" * 50_000 not in words


def test_workers_give_back_what_another_operator_kept(spark):
    """A Python worker lives on: the scorer of the language stage must not lie in it beside later stages."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(16)
    langid.identify(docs).count()

    def make():
        from riskweave.llm.common import worker_state

        held = len(worker_state("langid"))
        return lambda rows, texts: pa.RecordBatch.from_arrays([pa.array([held], pa.int64())], names=["held"])

    assert common.map_texts(docs.select("text"), make, "held long").agg({"held": "max"}).first()[0] == 0
    common.worker_state("a")["x"] = 1
    common.release_states("a")
    assert common.worker_state("a") == {"x": 1}
    common.release_states("b")
    assert common.worker_state("a") == {}
