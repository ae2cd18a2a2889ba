"""The corpus operators applied to the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, exact, fuzzy, langid, mixing, ngram, packing, quality, ranked, simhash, toxicity, variants, warc
from riskweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in sequences of at most 4096 tokens."""
    return packing.digests(packing.pack(table(spark, sf_dir, "documents")))


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of equal texts of every document."""
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op9_exact_dedup"] = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from t
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain posteriors and sampling rate of every document."""
    rated = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    shares = [F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(mixing.DOMAINS)]
    return rated.select("doc_id", "tokens", *shares, "rate")


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a Kneser-Ney model of the training folds."""
    return ngram.score_corpus(table(spark, sf_dir, "documents"))


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piecewise fingerprints of every document and of its edited text, and their likeness."""
    return fuzzy.edit_report(table(spark, sf_dir, "documents"))


@query
def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back through the capture index."""
    return warc.archive(table(spark, sf_dir, "pages"))


ORACLES["op5_warc_index"] = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (
  select page_id, strlen(html) as payload_bytes, sha1(html) as h, max(page_id) over (partition by html) as top from p
)
select page_id, payload_bytes,
       array_to_string([
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::int >> (15 - 5 * (i % 4))) & 31) + 1, 1)
         for i in range(32)], '') as payload_digest,
       case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from d
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to byte-level BPE ids and decoded again."""
    return bpe.round_trip(table(spark, sf_dir, "documents"))


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = r"""
with terms as (
  select row_number() over () as d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
counted as (select d, doc_id, term, count(*) as tf from terms group by all),
sizes as (select d, sum(tf)::bigint as n from counted group by d),
whole as (select count(*) as docs, sum(n)::bigint as total from sizes),
items as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
),
weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
  from counted, whole where term in (select term from items) group by term
),
scored as (
  select item_id, d, any_value(doc_id) as doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::bigint as score
  from items join weights using (term) join counted using (term) join sizes using (d), whole
  group by item_id, d
),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 10
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words' form and root."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))
