"""WARC archives with a two-level capture index.

``write`` stores one gzip member per page; pages with an equal payload of at least ``MIN_REVISIT`` bytes become
revisit records of the page with the smallest id. ``build_index`` sorts the captures by reversed-host URL
keys into compressed blocks; a part of the index ends with a sparse directory (first key and place of
each block), and the manifest keeps the first key of every part. ``lookup`` finds the part, then the block by
binary search, and reads only that block and the records it names. ``read`` walks all index parts and
reads every record.

Defined results: a null payload is empty; a payload of any length is one record, held whole by the task that writes or reads it; a null or keyless URL has the key ""; rows with the same page id and payload as the
response are responses too; if all page ids of a payload are null, all of them are responses; null page ids
otherwise revisit; other columns are ignored; an empty table gives an archive without files. Files
have fresh names and count only when a finished task reports them, so lost tasks leave nothing that is read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh_folder, map_column, ship
from .storage import make_folder, place

#: Payloads below this size are always stored in full.
MIN_REVISIT = 100
#: Captures of an index block.
BLOCK_LINES = 2_000
GZIP_LEVEL = 4
#: Payload bytes that a reader hands over at once.
READ_BYTES = 1 << 25
TAIL = struct.Struct("<2Q8s")
MAGIC = b"MKCAPIX1"

CAPTURE = "key string, page_id long, url string, uri string, offset long, length long"


def url_key(url: str | None) -> str:
    """``http://www.Example.com:80/a?b#c`` -> ``com,example,www:80)/a?b``; without ``://`` the text itself."""
    if not url:
        return ""
    _, found, rest = url.partition("://")
    if not found:
        return url
    rest = rest.partition("#")[0]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, _, port = rest[:cut].rpartition("@")[2].lower().partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest[cut:]


def _record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """One compressed record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {date}",
        # a URL with line ends would break the header
        f"WARC-Target-URI: {json.dumps(url)[1:-1] if url else ''}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"X-Page-ID: {'' if page is None else page}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(first)}",
            f"X-Refers-To-Page-ID: {first}",
        ]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """Fields and payload of a compressed record; the digest of a stored payload is computed and compared."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if fields.get(name) else None
    return {
        "page_id": number("X-Page-ID"),
        "url": json.loads(f'"{fields["WARC-Target-URI"]}"'),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


def write(df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None, date: str = "2000-01-01T00:00:00Z") -> str:
    """Write the archive and its index under ``folder`` (a fresh shared one by default) and return it."""
    spark = df.sparkSession
    ship(spark)
    folder = folder or fresh_folder(spark, "warc")
    make_folder(folder)
    pages = df.select(
        F.col(f"`{page_id}`").cast("long").alias("page"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("html"),
    )
    pages = pages.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
    repeated = (
        pages.where(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select(F.col("digest").alias("same"), "first")
    )
    # payloads shorter than the limit are never in the table of repeated ones; its measured size decides how it is joined
    rows = pages.join(repeated, pages["digest"] == repeated["same"], "left").select("page", "url", "html", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out, at = f"{folder}/part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            found: list[list] = [[] for _ in range(6)]
            for page, target, payload, digest, first in zip(*(batch.column(i) for i in range(5))):
                page, target, first = page.as_py(), target.as_py(), first.as_py()
                revisit = first is not None and page != first
                data = record(page, target, payload.as_py().encode(), digest.as_py(), first, revisit, date)
                if out is None:
                    system, path = place(uri)
                    out = system.open_output_stream(path, compression=None)
                out.write(data)
                for values, x in zip(found, (url_key(target), page, target, uri, at, len(data))):
                    values.append(x)
                at += len(data)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            names = ["key", "page_id", "url", "uri", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=k) for v, k in zip(found, kinds)], names=names)
        if out is not None:
            out.close()

    rows.mapInArrow(run, CAPTURE).write.parquet(f"{folder}/captures")
    build_index(spark, folder)
    return folder


def build_index(spark: SparkSession, folder: str) -> None:
    """Sort the captures into index parts of compressed blocks; ``manifest`` lists the parts and their first keys."""
    ship(spark)
    captures = spark.read.parquet(f"{folder}/captures")
    order = ["key", "page_id", "uri", "offset"]
    ranged = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, out, at, total = f"{folder}/index-{uuid.uuid4().hex}", None, 0, 0
        directory: list[list] = []
        lines: list[list] = []

        def flush() -> None:
            nonlocal out, at, lines, total
            if lines:
                if out is None:
                    system, path = place(uri)
                    out = system.open_output_stream(path, compression=None)
                data = zlib.compress(json.dumps(lines).encode(), GZIP_LEVEL)
                out.write(data)
                directory.append([lines[0][0], at, len(data)])
                at, total, lines = at + len(data), total + len(lines), []

        for batch in batches:
            for line in zip(*(column.to_pylist() for column in batch.columns)):
                lines.append(list(line))
                if len(lines) == BLOCK_LINES:
                    flush()
        flush()
        if out is not None:
            data = zlib.compress(json.dumps(directory).encode())
            out.write(data)
            out.write(index_tail(at, len(data)))
            out.close()
            part = TaskContext.get().partitionId()
            columns = [pa.array([x]) for x in (part, uri, directory[0][0], total)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "uri", "first_key", "captures"])

    ranged.mapInArrow(run, "part long, uri string, first_key string, captures long").write.parquet(f"{folder}/manifest")


def index_tail(at: int, length: int) -> bytes:
    return TAIL.pack(at, length, MAGIC)


class IndexPart:
    """One part of the index: its directory is read, blocks on demand."""

    def __init__(self, uri: str) -> None:
        system, path = place(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        at, length, magic = TAIL.unpack(self._range(size - TAIL.size, TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not an index part")
        self.directory = json.loads(zlib.decompress(self._range(at, length)))
        self.keys = [first for first, _, _ in self.directory]
        self.last: tuple[int, list[list]] = (-1, [])

    def _range(self, at: int, length: int) -> bytes:
        self.file.seek(at)
        return self.file.read(length)

    def block(self, i: int) -> list[list]:
        """The lines of a block; the last one is kept, as sorted requests ask for it again."""
        if self.last[0] != i:
            _, at, length = self.directory[i]
            self.last = i, json.loads(zlib.decompress(self._range(at, length)))
        return self.last[1]

    def find(self, key: str) -> Iterator[list]:
        """The captures of a key: binary search in the directory, then in the block."""
        i = max(0, bisect.bisect_left(self.keys, key) - 1)
        while i < len(self.keys) and self.keys[i] <= key:
            lines = self.block(i)
            j = bisect.bisect_left(lines, key, key=lambda line: line[0])
            while j < len(lines) and lines[j][0] == key:
                yield lines[j]
                j += 1
            if j < len(lines):
                return
            i += 1


class Archives:
    """Range reads of records; the file of the last read stays open."""

    def __init__(self) -> None:
        self.uri, self.file = None, None

    def record(self, uri: str, offset: int, length: int) -> dict:
        if uri != self.uri:
            system, path = place(uri)
            self.uri, self.file = uri, system.open_input_file(path)
        self.file.seek(offset)
        return parse(self.file.read(length))


RECORD = {
    "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
    "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}
RECORD_DDL = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def _batches(records: Iterator[dict], extra: dict | None = None) -> Iterator[pa.RecordBatch]:
    kinds = {**RECORD, **(extra or {})}
    rows: list[dict] = []
    size = 0
    for found in records:
        rows.append(found)
        size += len(found["payload"] or b"") + 500
        if size > READ_BYTES:
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kinds))


def fetch(places: DataFrame, files: int, payload: bool = True, extra: str | None = None) -> DataFrame:
    """The records at ``uri``, ``offset`` and ``length``, dealt by place, so that a task reads a file from front to back; the column ``extra`` travels along."""
    names = ["uri", "offset", "length", *([extra] if extra else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = Archives()

        def found() -> Iterator[dict]:
            for batch in batches:
                for uri, offset, length, *more in zip(*(c.to_pylist() for c in batch.columns)):
                    row = archives.record(uri, offset, length)
                    yield {**row, "payload": row["payload"] if payload else None, **({extra: more[0]} if extra else {})}

        yield from _batches(found(), {extra: pa.string()} if extra else None)

    dealt = places.select(*names).repartitionByRange(files, "uri", "offset").sortWithinPartitions("uri", "offset")
    return dealt.mapInArrow(run, RECORD_DDL + (f", {extra} string" if extra else ""))


def files_of(spark: SparkSession, folder: str) -> int:
    """As many tasks as archives: the places themselves are small, what they stand for is not."""
    return max(1, spark.read.parquet(f"{folder}/captures").select("uri").distinct().count())


def read(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """Every record, found by walking the whole index and read by its range; with ``payload`` false that column stays null."""
    ship(spark)
    parts = spark.read.parquet(f"{folder}/manifest").select("uri")
    parts = parts.repartition(max(1, parts.count()))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                part = IndexPart(uri)
                for i in range(len(part.directory)):
                    lines = part.block(i)
                    columns = [[line[3] for line in lines], [line[4] for line in lines], [line[5] for line in lines]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["uri", "offset", "length"])

    places = parts.mapInArrow(entries, "uri string, offset long, length long")
    return fetch(places, files_of(spark, folder), payload)


def keys_of(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with the ``key`` of each URL; a null URL has the key ""."""
    return map_column(urls, url, "key", "string", lambda: lambda column: pa.array([url_key(u) for u in column.to_pylist()], pa.string()))


def locate(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``key``, ``uri``, ``offset`` and ``length`` of every capture of the distinct ``key`` values: binary search for the part, its block, and the line.

    Keys are dealt and sorted as the index is, so a task opens each of its parts and decompresses each of its blocks once. The first keys of
    the parts (one a file) travel with the job.
    """
    ship(spark)
    parts = [(r["first_key"], r["uri"]) for r in spark.read.parquet(f"{folder}/manifest").orderBy("part").collect()]
    firsts = [first for first, _ in parts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, part = None, None
        for batch in batches:
            found: list[list] = []
            for key in batch.column(0).to_pylist():
                i = max(0, bisect.bisect_left(firsts, key) - 1)
                while i < len(parts) and firsts[i] <= key:
                    if parts[i][1] != uri:
                        uri, part = parts[i][1], IndexPart(parts[i][1])
                    found += [[key, line[3], line[4], line[5]] for line in part.find(key)]
                    i += 1
            if found:
                columns = [pa.array(c, k) for c, k in zip(zip(*found), (pa.string(), pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "uri", "offset", "length"])

    wanted = keys.select("key").where("key IS NOT NULL").distinct()
    return wanted.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, "key string, uri string, offset long, length long")


def lookup_keys(spark: SparkSession, folder: str, keys: DataFrame, payload: bool = True) -> DataFrame:
    """The records of every distinct ``key``, with that key."""
    return fetch(locate(spark, folder, keys), files_of(spark, folder), payload, "key")


def lookup(spark: SparkSession, folder: str, urls: DataFrame, url: str = "url") -> DataFrame:
    """The records whose key equals that of a requested URL: ``wanted`` and the record's fields. Null URLs find nothing; each distinct URL counts once."""
    wanted = urls.select(F.col(f"`{url}`").cast("string").alias("wanted")).where(F.col("wanted").isNotNull()).distinct()
    keyed = keys_of(wanted, "wanted")
    return keyed.join(lookup_keys(spark, folder, keyed), "key").drop("key")
