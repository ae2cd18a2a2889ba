"""Web archives with a two-level capture index.

Captures are written as gzip members of WARC files. Index lines, keyed by the URL with its
host reversed, are sorted and cut into compressed blocks of a few thousand lines; a sparse
directory holds the first key and the place of each block. A lookup searches the directory,
reads the one block, and then reads the capture's range of the archive, nothing else.

All files lie in the shared folder. An attempt of a task writes files of its own name, and
only files of attempts that succeeded are named in the tables that lead to them.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import materialize, ship_package, stage_path

DATE = "2024-01-01T00:00:00Z"
ENTRY = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file named as Spark names it."""
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), re.sub("^file:", "", path))


def reversed_url(url: str | None) -> str:
    """com,example,www)/path?query; a URL that can't be taken apart stands for itself."""
    url = "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in (url or ""))
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    if not host:
        return url
    port = f":{parts.netloc.rpartition(':')[2]}" if re.search(r":\d+$", parts.netloc) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port}){parts.path or '/'}{query}"


def capture_key(url: str | None, page_id: int | None) -> str:
    """Sort key of a capture; ids sort as numbers, so captures of one URL spread over blocks."""
    return f"{reversed_url(url)} {'-' if page_id is None else f'{page_id + (1 << 63):020d}'}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(f"%{ord(c):02X}" if c <= " " or c == "\x7f" else c for c in (url or ""))
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head[2:2] = [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC head, HTTP head and payload of one record."""
    def fields(raw: bytes) -> dict[str, str]:
        return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:] if ": " in line)

    raw, _, rest = data.partition(b"\r\n\r\n")
    head = fields(raw)
    http, _, payload = rest[: int(head["Content-Length"])].partition(b"\r\n\r\n")
    return head, fields(http), payload


def _number(urn: str | None) -> int | None:
    text = (urn or "")[len("<urn:page:") : -1]
    return int(text) if text else None


def plan(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, refers_to, revisit: of equal payloads of at least `least` bytes the
    largest page_id is the response. A null page_id is smaller than any number."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("_sha", F.sha2("html", 256))
    first = keyed.where(size >= least).groupBy("_sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    # The list of repeated payloads grows with the crawl, so it is not broadcast.
    shared = first.where((F.col("_n") > 1) & F.col("refers_to").isNotNull()).drop("_n").hint("shuffle_merge")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return keyed.join(shared, "_sha", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("refers_to")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(planned: DataFrame, path: str, level: int = 3, most: int = 1 << 30) -> DataFrame:
    """Write a record for each row into archives of up to about `most` bytes; return their index lines."""

    def run(batches):
        store, root = folder(path)
        store.create_dir(root, recursive=True)
        out = name = None
        at = 0
        for batch in batches:
            lines = []
            for page_id, url, html, refers_to, revisit in zip(*[c.to_pylist() for c in batch.columns]):
                if out is None or at > most:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = gzip.compress(record(page_id, url, html.encode(), refers_to, revisit), level, mtime=0)
                out.write(member)
                lines.append((capture_key(url, page_id), page_id, name, at, len(member)))
                at += len(member)
            yield _rows(lines, ENTRY)
        if out is not None:
            out.close()

    ship_package(planned.sparkSession)
    return planned.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(run, ENTRY)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(columns)], names=[n for n, _ in columns]
    )


DIRECTORY = "first string, last string, file string"


def write_index(entries: DataFrame, path: str, block: int = 3000) -> DataFrame:
    """Sort index lines over range partitions and write each as one file of compressed blocks.

    Beside each file lies its directory: first key, offset and length of every block. The
    returned table has one row for each file.
    """

    def run(batches):
        store, root = folder(path)
        store.create_dir(root, recursive=True)
        name, out, at, held, places, last = uuid.uuid4().hex, None, 0, [], [], ""

        def flush():
            nonlocal at, last
            data = zlib.compress("\n".join(held).encode())
            out.write(data)
            places.append((held[0].split("\t", 1)[0], at, len(data)))
            at, last = at + len(data), held[-1].split("\t", 1)[0]
            held.clear()

        for batch in batches:
            for key, page_id, file, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                out = out or store.open_output_stream(f"{root}/{name}.cdx", compression=None)
                held.append(f"{key}\t{json.dumps([page_id, file, offset, length])}")
                if len(held) == block:
                    flush()
        if out is not None:
            if held:
                flush()
            out.close()
            with store.open_output_stream(f"{root}/{name}.idx", compression=None) as f:
                f.write(json.dumps(places).encode())
            yield _rows([(places[0][0], last, name)], DIRECTORY)

    ship_package(entries.sparkSession)
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.repartitionByRange(n, "key").sortWithinPartitions("key", "file", "offset")
    return placed.select("key", "page_id", "file", "offset", "length").mapInArrow(run, DIRECTORY)


class IndexFile:
    """One index file: binary search in its directory, then one range read for a block."""

    def __init__(self, path: str, name: str):
        store, root = folder(path)
        with store.open_input_stream(f"{root}/{name}.idx") as f:
            self.places = json.loads(f.read())
        self.firsts = [p[0] for p in self.places]
        self.file = store.open_input_file(f"{root}/{name}.cdx")
        self.block, self.keys, self.lines = -1, [], []

    def _load(self, i: int) -> None:
        if i != self.block:
            _, offset, length = self.places[i]
            self.lines = zlib.decompress(self.file.read_at(length, offset)).decode().split("\n")
            self.keys = [line.split("\t", 1)[0] for line in self.lines]
            self.block = i

    def find(self, key: str) -> list[tuple]:
        """All captures of a key; they may go on in the next blocks."""
        out = []
        for i in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            self._load(i)
            for line in self.lines[bisect_left(self.keys, key) : bisect_right(self.keys, key)]:
                out.append(tuple(json.loads(line.split("\t", 1)[1])))
        return out


def lookup(keys: DataFrame, index: DataFrame, path: str) -> DataFrame:
    """Index lines of the captures with the given `key`s (distinct).

    Keys go to the index files whose range holds them; a file gets its keys in order, so each
    of its blocks is read at most once. The ranges, one for each index file, are sent to all
    tasks: there are no more of them than shuffle partitions.
    """
    spark = keys.sparkSession
    files = sorted((r["first"], r["last"], r["file"]) for r in index.collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]

    def route(batches):
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                out += [(key, files[i][2]) for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            yield _rows(out, "key string, file string")

    def search(batches):
        name = found = None
        for batch in batches:
            out = []
            for key, file in zip(*[c.to_pylist() for c in batch.columns]):
                if file != name:
                    name, found = file, IndexFile(path, file)
                out += [(key, *line) for line in found.find(key)]
            yield _rows(out, ENTRY)

    ship_package(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    routed = keys.select("key").mapInArrow(route, "key string, file string")
    return routed.repartition(n, "file").sortWithinPartitions("file", "key").mapInArrow(search, ENTRY)


def fetch(entries: DataFrame, path: str) -> DataFrame:
    """Read the ranges of index lines from their archives, each archive in order of offsets.

    page_id, payload_bytes, payload_digest, record_type, refers_to. Payloads of responses are
    hashed again and must agree with their record.
    """

    def run(batches):
        store, root = folder(path)
        name = file = None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                if archive != name:
                    name, file = archive, store.open_input_file(f"{root}/{archive}")
                head, http, payload = parse(gzip.decompress(file.read_at(length, offset)))
                told, size, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"]), head["WARC-Type"]
                if kind == "response" and (len(payload), digest(payload)) != (size, told):
                    raise ValueError(f"record at {offset} of {archive} is damaged")
                out.append((_number(head["WARC-Record-ID"]), size, told, kind, _number(head.get("WARC-Refers-To"))))
            yield _rows(out, RECORD)

    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = entries.select("file", "offset", "length").repartition(n, "file").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(run, RECORD)


def capture_keys(pages: DataFrame) -> DataFrame:
    """Distinct capture keys of rows page_id, url."""

    def run(batches):
        for batch in batches:
            yield _rows([(capture_key(u, i),) for i, u in zip(*[c.to_pylist() for c in batch.columns])], "key string")

    return pages.select("page_id", "url").mapInArrow(run, "key string").distinct()


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write an archive of `pages` (page_id, url, html), index it, and read every page back by lookup.

    One row per page. Null html is empty, a null url the empty URL; a page without an id never
    is the response others refer to, unless all of its payload lack one, which then stay
    responses. Repeated rows are captures of their own; those with the largest id are all
    responses. An empty table gives no archive and no rows.
    """
    spark = pages.sparkSession
    path = stage_path(spark, "warc")
    entries = materialize(write_archives(plan(pages, least), path), "warc-entries")
    index = materialize(write_index(entries, path), "warc-index")
    return fetch(lookup(capture_keys(pages), index, path), path)
