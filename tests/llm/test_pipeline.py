import re

import brute

import corpus_pipeline
from riskweave.llm import simhash
from riskweave.session import materialize

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_in_order(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    docs = materialize(docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).selectExpr("doc_id + 5000 as doc_id", "'12 34' as text", "lang", "source", "n_chars")))
    longer = docs.where("n_chars > 6000 and doc_id < 5000").selectExpr("doc_id + 6000 as doc_id", "text || ' ending' as text", "lang", "source", "n_chars")
    docs = materialize(docs.unionByName(longer))
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        kept.append(docs.collect())
    language, exact, near, mixed, packed = kept
    assert len(language) == 403 + longer.count() and not any(r.text == "12 34" for r in language)
    texts = [re.sub("[\x20\x09-\x0D]+", " ", r.text) for r in exact]
    assert len(set(texts)) == len(texts) == len({re.sub("[\x20\x09-\x0D]+", " ", r.text) for r in language})
    codes = [simhash.simhash(r.text) % (1 << 64) for r in near]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(codes) for b in codes[:i]) and len(near) < len(exact)
    ids = [r.doc_id for r in near]
    for r in exact:  # what is gone has a smaller document that is linked to it, directly or not
        if r.doc_id not in ids:
            assert any(x.doc_id < r.doc_id for x in exact)
    assert 0 < len(mixed) < len(near), "low-quality and toxic documents are thinned"
    assert {r.doc_id for r in mixed} <= set(ids)
    assert {r.doc_id for r in packed} == {r.doc_id for r in mixed}


def test_clean_documents_pass_the_language_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() == docs.count() and brute.fold(None, 5) == 0


def test_run_is_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert "sequence_id" in got.columns and got.count() > 0
