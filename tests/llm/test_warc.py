import gzip

import oracle
from pyarrow import fs
from pyspark.sql import functions as F

from riskweave.llm import warc
from riskweave.llm.queries import ORACLES, QUERIES
from riskweave.session import materialize, stage_path

SF = "/root/testdata/sf0.01"


def test_query_against_sql(spark):
    assert not oracle.compare(spark, oracle.duck(SF), "op5", QUERIES["op5_warc_index"], ORACLES["op5_warc_index"], SF)


def test_keys_reverse_hosts_and_sort_ids():
    assert warc.reversed_url("https://www.Example.com/a/b?c=d#e") == "com,example,www)/a/b?c=d"
    assert warc.reversed_url("http://example.com:8080") == "com,example:8080)/"
    assert warc.reversed_url("http://[bad") == "http://[bad" and warc.reversed_url(None) == "" and " " not in warc.reversed_url("a b\n")
    keys = [warc.capture_key("http://x.org", i) for i in (None, -5, 3, 20)]
    assert keys == sorted(keys)


def test_lookups_read_single_blocks(spark):
    """Every key is found through the directory, across many small blocks and index files."""
    pages = spark.range(500).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "http://hot.example.com/").otherwise(F.concat(F.lit("http://h"), (F.col("id") % 7).cast("string"), F.lit(".org/"), F.col("id").cast("string"))).alias("url"),
        F.concat(F.lit("page "), (F.col("id") % 90).cast("string")).alias("html"),
    )
    path = stage_path(spark, "warc-test")
    entries = materialize(warc.write_archives(warc.plan(pages), path, most=3000), "entries")
    index = materialize(warc.write_index(entries, path, block=7), "index")
    keys = warc.capture_keys(pages.where("page_id % 5 = 0"))
    found = {(r.key, r.page_id, r.file, r.offset, r.length) for r in warc.lookup(keys, index, path).collect()}
    assert found == {tuple(r) for r in entries.where("page_id % 5 = 0").collect()}
    assert warc.lookup(spark.createDataFrame([("zz",), ("a",), ("com,",)], "key string"), index, path).count() == 0
    assert len({r[2] for r in found}) > 1
    # Archives are plain sequences of gzip members that any reader can go through.
    store, root = warc.folder(path)
    records = 0
    for info in store.get_file_info(fs.FileSelector(root)):
        if info.path.endswith(".warc.gz"):
            with store.open_input_stream(info.path, compression=None) as f:
                records += gzip.decompress(f.read()).count(b"WARC/1.1\r\n")
    assert records == 500


def test_records_round_trip_and_damage_is_found():
    data = warc.record(7, "http://e.org/\r\nX: y", "é\r\n\r\nz".encode(), None, False)
    head, http, payload = warc.parse(data)
    assert payload.decode() == "é\r\n\r\nz" and head["WARC-Target-URI"] == "http://e.org/%0D%0AX:%20y" and "X" not in head
    head, http, payload = warc.parse(warc.record(8, None, b"abc", 7, True))
    assert (head["WARC-Type"], http["Content-Length"], payload) == ("revisit", "3", b"")


def test_short_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "v", "bbbb"), (4, "w", "bbbb")], "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in warc.archive(pages, least=3).collect()}
    assert got == {1: None, 2: None, 3: 4, 4: None}
