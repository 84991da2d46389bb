"""WARC archives of pages, and a two-level capture index over them.

Each task writes its pages as WARC/1.1 records, one gzip member each, to files of its own.  Of records with equal payloads
one is the response and the others revisit it.  The captures (reversed-host URL key, page, file, offset, length)
are range-partitioned and sorted; each range becomes an index shard: lines in compressed blocks, and beside it a sparse
directory with the first key of each block.  A lookup finds its shard by the first keys of the shards, its block by binary
search in the directory, reads and unpacks that block alone, and the captures found are then read from the archives
by byte range, neighbours together.

Files of an attempt carry its number.  Only what a finished attempt has reported through Spark is in the index; files of
lost attempts are deleted when the job has ended.  Files are reached by pyarrow's file systems: mounted folders, HDFS, object stores.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folder, kept, partitions, small, table, workspace, written

CAPTURE = "key string, page_id long, file string, offset long, length long"
FOUND = "key string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
#: Bytes of a row of originals in a broadcast: 64 of digest, two numbers, and what a hashed relation adds.
ORIGINAL_ROW = 200
ID = "urn:x-page:"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def url_key(url: Column) -> Column:
    """The host's labels reversed and joined by commas, a port that isn't the scheme's own, ``)``, path and query; no fragment.

    Hosts are lower-cased, white space and control characters that would break a line are percent-encoded.  A text without a host is kept
    after ``)``; null is ``)`` alone.
    """
    url = F.coalesce(url, F.lit(""))
    host = F.lower(F.regexp_extract(url, SCHEME + r"(?:[^/?#@]*@)?([^/?#:]*)", 1))
    port = F.regexp_extract(url, SCHEME + r"(?:[^/?#@]*@)?[^/?#:@]*(:[0-9]+)(?=[/?#]|$)", 1)
    own = (F.lower(url).startswith("http://") & (port == ":80")) | (F.lower(url).startswith("https://") & (port == ":443"))
    path = F.regexp_extract(url, SCHEME + r"[^/?#]*([^#]*)", 1)
    named = F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.when(own, "").otherwise(port), F.lit(")"), F.when(path == "", "/").otherwise(path))
    key = F.when(host != "", named).otherwise(F.concat(F.lit(")"), F.regexp_replace(url, "#[\\s\\S]*", "")))
    for c in "\t\n\r ":
        key = F.replace(key, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return key


def store(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


class _Output:
    """One file of an attempt, opened when something is written."""

    def __init__(self, base: str, suffix: str):
        context = TaskContext.get()
        self.fs, at = store(base)
        self.fs.create_dir(at, recursive=True)
        self.name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}{suffix}"
        self.stream = self.fs.open_output_stream(f"{at}/{self.name}", compression=None)  # members are packed one by one
        self.size = 0

    def add(self, data: bytes) -> int:
        """Append; returns the offset."""
        self.stream.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        self.stream.close()


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _safe(text: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def warc_record(kind: str, page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit of page ``first`` with the HTTP head alone."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url:
        fields.append(("WARC-Target-URI", _safe(url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{ID}{first}>")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of ``FOUND`` (but the key) of a record; an error if its block or its payload isn't whole."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if not version.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or (kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest)):
        raise ValueError(f"damaged WARC record {fields.get('WARC-Record-ID')}")
    number = lambda x: int(x.strip("<>").removeprefix(ID)) if x and x != f"<{ID}>" else None
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload if kind == "response" else None}


def planned(pages: DataFrame, least: int = 100) -> DataFrame:
    """(page_id, url, payload, digest, first): ``first`` is the page that a payload of ``least`` bytes or more revisits, else null.

    Only digests and ids are added up, map-side first.  Originals of repeated payloads are broadcast while measured small; beyond that pages
    are shuffled to them, and adaptive execution splits a frequent payload.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    groups = small(written(groups.select(F.col("digest").alias("d"), "first"), "warc-originals"), ORIGINAL_ROW)
    return rows.join(groups, F.col("digest") == F.col("d"), "left").withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("d")


def write_archives(pages: DataFrame, path: str, least: int = 100, most: int = 1 << 30, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Archives of pages (page_id, url, html) in the folder ``path``; returns their captures, as a written table.

    A file holds about ``most`` bytes at most, a record whole.  Null html is an empty payload.  Of equal payloads of at least
    ``least`` bytes, rows with the smallest page_id are responses and the others revisit it; a null page_id comes after all others, and
    where only such rows hold a payload all are responses.  Repeated rows are records of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, count = None, 0
        try:
            for b in batches:
                rows = []
                for key, page, url, payload, digest, first in zip(*(b.column(c) for c in ("key", "page_id", "url", "payload", "digest", "first")), strict=True):
                    if out is None or out.size >= most:
                        if out is not None:
                            out.close()
                        out, count = _Output(path, f"-{count}.warc.gz"), count + 1
                        info = b"software: tessella\r\nformat: WARC File Format 1.1\r\n"
                        out.add(member(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:x-file:{out.name}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n".encode() + info + b"\r\n\r\n"))
                    first = first.as_py()
                    data = member(warc_record("response" if first is None else "revisit", page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), first, date))
                    rows.append((key.as_py(), page.as_py(), out.name, out.add(data), len(data)))
                yield _batch(rows, CAPTURE)
        finally:
            if out is not None:
                out.close()

    captures = written(planned(pages, least).withColumn("key", url_key(F.col("url"))).mapInArrow(run, CAPTURE), "warc-captures")
    _only(path, {r[0] for r in captures.select("file").distinct().collect()})  # a name for each task
    return captures


_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], _KINDS[kind]) for k, (_, kind) in enumerate(names)], names=[n for n, _ in names])


def _only(path: str, names: set[str]) -> None:
    """Delete the files of lost attempts."""
    from pyarrow import fs

    files, at = store(path)
    for f in files.get_file_info(fs.FileSelector(at, allow_not_found=True)):
        if f.base_name not in names:
            files.delete_file(f.path)


def _place(key: str, page: int | None) -> tuple:
    return key, page is not None, page or 0


def write_index(captures: DataFrame, path: str, lines: int = 1024) -> list[tuple[tuple, str]]:
    """An index of captures in the folder ``path``: shards of compressed blocks of ``lines`` lines, and a directory beside each.

    Returns the first place (key, page) of each shard with its file, in order: one for each partition.  Ties are parted by file
    and offset, so that a frequent URL fills many blocks and shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, directory, block, first, names = None, [], [], None, None
        schema = "key string, page_id long, file string"

        def flush() -> None:
            data = member("".join(block).encode())
            directory.append(f"{block[0].split(chr(9), 2)[0]}\t{block[0].split(chr(9), 2)[1]}\t{out.add(data)}\t{len(data)}\n")
            block.clear()

        try:
            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length")), strict=True):
                    if out is None:
                        out, first = _Output(path, ".cdx.gz"), row[:2]
                    block.append("\t".join("" if x is None else str(x) for x in row) + "\n")
                    if len(block) == lines:
                        flush()
            if out is not None:
                if block:
                    flush()
                names = _Output(path, ".cdx.idx")
                names.add(member("".join(directory).encode()))
                names.close()
                yield _batch([(*first, out.name)], schema)
        finally:
            if out is not None:
                out.close()

    order = ["key", F.col("page_id").asc_nulls_first(), "file", "offset"]
    rows = captures.repartitionByRange(partitions(captures.sparkSession), *order).sortWithinPartitions(*order)
    shards = written(rows.mapInArrow(run, "key string, page_id long, file string"), "warc-shards").collect()
    _only(path, {x for r in shards for x in (r.file, r.file.removesuffix(".gz") + ".idx")})
    return sorted((_place(r.key, r.page_id), r.file) for r in shards)


class _Index:
    """A reader of an index that keeps one directory and one block unpacked, as sorted lookups need no more."""

    def __init__(self, path: str, shards: list[tuple[tuple, str]]):
        self.fs, self.at = store(path)
        self.firsts, self.files = [x for x, _ in shards], [x for _, x in shards]
        self.directory = self.block = (None, None)

    def _blocks(self, shard: int) -> tuple[list[tuple], list[tuple[int, int]]]:
        if self.directory[0] != shard:
            with self.fs.open_input_file(f"{self.at}/{self.files[shard].removesuffix('.gz')}.idx") as f:
                rows = [x.split("\t") for x in zlib.decompress(f.readall(), 31).decode().split("\n")[:-1]]
            self.directory = shard, ([_place(k, int(p) if p else None) for k, p, _, _ in rows], [(int(o), int(n)) for _, _, o, n in rows])
        return self.directory[1]

    def _lines(self, shard: int, place: tuple[int, int]) -> tuple[list[tuple], list[tuple]]:
        if self.block[0] != (shard, place):
            with self.fs.open_input_file(f"{self.at}/{self.files[shard]}") as f:
                f.seek(place[0])
                data = zlib.decompress(f.read(place[1]), 31).decode()
            rows = [(k, int(p) if p else None, name, int(o), int(n)) for k, p, name, o, n in (x.split("\t") for x in data.split("\n")[:-1])]
            self.block = (shard, place), ([_place(*r[:2]) for r in rows], rows)
        return self.block[1]

    def find(self, low: tuple, high: tuple) -> Iterator[tuple]:
        """Captures from place ``low`` to place ``high``: binary search among shards, in a directory and in a block."""
        shard = max(0, bisect.bisect_left(self.firsts, low) - 1)
        while shard < len(self.files) and self.firsts[shard] <= high:
            firsts, places = self._blocks(shard)
            k = max(0, bisect.bisect_left(firsts, low) - 1)
            while k < len(places) and firsts[k] <= high:
                at, rows = self._lines(shard, places[k])
                yield from rows[bisect.bisect_left(at, low) : bisect.bisect_right(at, high)]
                k += 1
            shard += 1


def lookup(wanted: DataFrame, path: str, shards: list[tuple[tuple, str]]) -> DataFrame:
    """The captures of wanted keys, or of (key, page_id) where wanted has both; each wanted row counts once, and null keys find nothing.

    Lookups are sorted by range, so that each task goes through the index once.
    """
    exact = "page_id" in wanted.columns
    names = ["key", "page_id"] if exact else ["key"]
    order = [F.col(c).asc_nulls_first() for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(path, shards)
        for b in batches:
            out: list[tuple] = []
            pages = b.column("page_id").to_pylist() if exact else [None] * len(b)
            for key, page in zip(b.column("key").to_pylist(), pages, strict=True):
                low, high = (_place(key, page),) * 2 if exact else ((key, False, 0), (key, True, 1 << 63))
                if not exact:
                    low = (key, False, -(1 << 63))
                for row in index.find(low, high):
                    out.append(row)
                    if len(out) == 10000:
                        yield _batch(out, CAPTURE)
                        out = []
            yield _batch(out, CAPTURE)

    rows = wanted.where("key is not null").select(*names).distinct()
    return rows.repartitionByRange(partitions(wanted.sparkSession), *order).sortWithinPartitions(*order).mapInArrow(run, CAPTURE)


def read_captures(captures: DataFrame, path: str, payload: bool = False, most: int = 4 << 20) -> DataFrame:
    """The records of captures as ``FOUND``, without the payload unless it is asked for.

    Captures are sorted by file and offset; neighbours are read together, about ``most`` bytes at a time.  A damaged record is an error.
    """
    schema = FOUND if payload else FOUND.removesuffix(", payload binary")
    names = [x.split()[0] for x in schema.split(", ")][2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = store(path)
        name = stream = None
        try:
            for b in batches:
                rows, k = list(zip(*(b.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length")), strict=True)), 0
                while k < len(rows):
                    if rows[k][2] != name:
                        if stream is not None:
                            stream.close()
                        name, stream = rows[k][2], files.open_input_file(f"{at}/{rows[k][2]}")
                    e, end = k + 1, rows[k][3] + rows[k][4]
                    while e < len(rows) and rows[e][2:4] == (name, end) and end - rows[k][3] < most:
                        end, e = end + rows[e][4], e + 1
                    stream.seek(rows[k][3])
                    data, out = stream.read(end - rows[k][3]), []
                    for key, page, _, offset, length in rows[k:e]:
                        record = parse_record(zlib.decompress(data[offset - rows[k][3] :][:length], 31))
                        if record["page_id"] != page:
                            raise ValueError(f"the index names page {page}, the record page {record['page_id']}")
                        out.append((key, page, *(record[n] for n in names)))
                    yield _batch(out, schema)
                    k = e
        finally:
            if stream is not None:
                stream.close()

    return captures.repartitionByRange(partitions(captures.sparkSession), "file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``: archived, indexed, each looked up by its URL key and id, and read back by byte range."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    with workspace(spark):
        archive, index = folder(spark, "warc"), folder(spark, "cdx")
        shards = write_index(write_archives(pages, archive), index)
        found = lookup(pages.select(url_key(F.col("url")).alias("key"), "page_id"), index, shards)
        out = kept(written(read_captures(found, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "warc-read"))
    return out


OP13_SQL = """
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN octet_length(encode(h)) >= 100 AND page_id IS DISTINCT FROM m AND m IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN octet_length(encode(h)) >= 100 AND page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS m FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
"""
