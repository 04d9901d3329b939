"""WARC archives of pages and a two-level capture index over them.

``write_archives`` stores one record a page in gzip members of ``.warc.gz`` files
below a shared folder. Every attempt of a task writes files of its own name, and
a table committed by Spark says which files and records count, so a task may run
again. Of pages with equal payloads of at least ``least_bytes`` bytes, that with
the smallest page_id is a response; the others are revisits that name it and
hold no payload.

``write_index`` sorts the captures by reversed-host URL key into compressed
blocks of ``block_lines`` lines and keeps a sparse directory: a row with the
first and last key and the place of each block. Blocks are in order within a part
(what one task wrote), and parts among each other. ``Index`` searches for one
URL, ``lookup_all`` for a table of them: a binary search over the parts' first
keys, one over the sorted directory of a part, one over the lines of a block that
was read by its byte range, and then only the records' byte ranges are read. Every
payload's digest is checked.

Null html is an empty payload; null URLs are written as empty ones. A URL whose
characters can't stand in a header is kept beside it and read back as it was. Rows that
repeat a page_id are a record each; all rows with a payload's smallest page_id
are responses. A null page_id refers to the smallest known one of its payload,
and is a response where there is none. An empty table gives no files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidflow.llm.common import batch, pieces, settled, shared_dir

FILE_BYTES = 1_000_000_000
BLOCK_LINES = 3000
LEVEL = 4
#: Rows of the smallest ids are repeated so many times, so that a payload of many pages spreads over as many joins.
SALTS = 32
_RESPONSE, _REVISIT = "response", "revisit"
_NAMESPACE = uuid.UUID("6f6f4e2e-8a38-5b0e-9d0c-0c9f6f1d6c11")

_CAPTURE = "key string, page_id long, url string, file string, at long, size long, digest string, kind string"
_CAPTURE_ARROW = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("digest", pa.string()), ("kind", pa.string())])
_DIRECTORY = "first_key string, last_key string, part long, file string, at long, size long, lines long"
_DIRECTORY_ARROW = pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("part", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("lines", pa.int64())])
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
_RECORD_ARROW = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder that all executors reach."""
    return fs.FileSystem.from_uri(uri)


def url_key(url: str) -> str:
    """A URL with its host reversed: http://www.a.example/x?y becomes example,a)/x?y."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    names = host.removeprefix("www.").split(".")
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(names)) + port + ")" + (parts.path or "/") + query


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None, revisit: bool = False, date: str = "2024-01-01T00:00:00Z", place: str = "") -> bytes:
    """One WARC/1.1 record, uncompressed. Its own id follows from ``place``, where it is written; pages have no time of capture."""
    shown = "".join(c for c in url if c >= " " and c not in "\x7f\x85\u2028\u2029")
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    body = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {_REVISIT if revisit else _RESPONSE}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(_NAMESPACE, place)}>", f"WARC-Date: {date}", f"WARC-Target-URI: {shown}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if shown != url:
        lines.append(f"X-Target-URI-As-Stored: {json.dumps(url)}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-ID: {refers_to}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record's fields and payload. A payload that does not match its digest or length raises."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = top.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    body = rest[: int(fields["Content-Length"])]
    revisit, digest = fields["WARC-Type"] == _REVISIT, fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None if revisit else body[body.index(b"\r\n\r\n") + 4 :]
    if payload is not None and (base32_sha1(payload) != digest or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"damaged record of page {fields.get('X-Page-ID')}")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"), "url": json.loads(fields["X-Target-URI-As-Stored"]) if "X-Target-URI-As-Stored" in fields else fields["WARC-Target-URI"], "payload": payload}


def _squeezed(raw: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(raw) + c.flush()


class _Files:
    """Numbered files of one attempt of a task; each name is used once."""

    def __init__(self, uri: str, suffix: str, most: int):
        self.system, self.dir = store(uri)
        self.stem, self.suffix, self.most = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", suffix, most
        self.out, self.name, self.at, self.n = None, "", 0, 0

    def next(self) -> tuple[str, int]:
        """Where what is put next will stand."""
        if self.out is None or self.at >= self.most:
            self.close()
            self.name, self.at, self.n = f"{self.stem}-{self.n:04d}{self.suffix}", 0, self.n + 1
            self.out = self.system.open_output_stream(f"{self.dir}/{self.name}", compression=None)
        return self.name, self.at

    def put(self, raw: bytes) -> tuple[str, int, int]:
        place = (*self.next(), len(raw))
        self.out.write(raw)
        self.at += len(raw)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def with_first(pages: DataFrame, id_col: str, url_col: str, html_col: str, least_bytes: int) -> DataFrame:
    """page_id, url, payload and first: the smallest page_id of the same payload, null where the page is alone with it."""
    chosen = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html_col).cast("string").cast("binary"), F.lit(b"")).alias("payload"))
    chosen = chosen.withColumn("sha", F.unhex(F.sha1("payload"))).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    groups = chosen.where(F.length("payload") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    spread = groups.select("sha", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return chosen.join(spread, ["sha", "salt"], "left").select("page_id", "url", "payload", "first")


def write_archives(pages: DataFrame, at: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, file_bytes: int = FILE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write the archives to the folder ``at``; the committed captures: key, page_id, url, file, place and size in it, digest, kind."""
    system, path = store(at)
    system.create_dir(path, recursive=True)

    def write(batches):
        files = _Files(at, ".warc.gz", file_bytes)
        for b in pieces(batches, 256):
            rows = []
            for page, url, payload, first in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                digest = base32_sha1(payload)
                revisit = first is not None and first != page
                place = files.put(_squeezed(record(page, url, payload, digest, first, revisit, place="{}:{}".format(*files.next())), level))
                rows.append((url_key(url), page, url, *place, digest, _REVISIT if revisit else _RESPONSE))
            yield batch(_CAPTURE_ARROW, **{k: [r[j] for r in rows] for j, k in enumerate(_CAPTURE_ARROW.names)})
        files.close()

    return settled(with_first(pages, id_col, url_col, html_col, least_bytes).mapInArrow(write, _CAPTURE), "captures")


def write_index(captures: DataFrame, at: str, *, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted, compressed blocks to the folder ``at``; the directory: first and last key and place of each block."""
    system, path = store(at)
    system.create_dir(path, recursive=True)

    def write(batches):
        files, part, lines, keys = _Files(at, ".cdx.gz", FILE_BYTES), TaskContext.get().partitionId(), [], []

        def closed():
            place = files.put(_squeezed("".join(lines).encode(), 6))
            return batch(_DIRECTORY_ARROW, first_key=[keys[0]], last_key=[keys[-1]], part=[part], file=[place[0]], at=[place[1]], size=[place[2]], lines=[len(lines)])

        for b in batches:
            for row in b.to_pylist():
                lines.append(json.dumps([row[k] for k in ("key", "page_id", "file", "at", "size", "digest", "kind")]) + "\n")
                keys.append(row["key"])
                if len(lines) >= block_lines:
                    yield closed()
                    lines, keys = [], []
        if lines:
            yield closed()
        files.close()

    ordered = captures.repartitionByRange("key", "page_id", "file", "at").sortWithinPartitions("key", "page_id", "file", "at")
    return settled(ordered.mapInArrow(write, _DIRECTORY), "directory")


def _block(system: fs.FileSystem, folder: str, file: str, at: int, size: int) -> list[list]:
    with system.open_input_file(f"{folder}/{file}") as f:
        return [json.loads(x) for x in zlib.decompress(f.read_at(size, at), 31).decode().splitlines()]


def _between(first: list[str], last: list[str], key: str) -> range:
    """Which of sorted stretches, told by their first and last keys, may hold a key: one, unless the key fills several."""
    return range(bisect.bisect_left(last, key), bisect.bisect_right(first, key))


def _parts(directory: DataFrame) -> list:
    """The first and last key of each part, in order: as many rows as the index had tasks."""
    return sorted(tuple(r) for r in directory.groupBy("part").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).select("first", "last", "part").collect())


def _lines_of(lines: list[list], key: str) -> list[list]:
    at = lambda x: x[0]
    return lines[bisect.bisect_left(lines, key, key=at) : bisect.bisect_right(lines, key, key=at)]


class Index:
    """Looks up single URLs. Of the directory it holds the parts' first and last keys, and the parts that were asked for."""

    def __init__(self, directory: DataFrame, index_at: str, archives_at: str):
        self.directory, self.index, self.archives = directory, store(index_at), store(archives_at)
        self.first, self.last, self.part = (list(x) for x in zip(*_parts(directory), strict=True)) if not directory.isEmpty() else ([], [], [])
        self.held: dict[int, list] = {}

    def _blocks(self, part: int) -> list:
        if part not in self.held:
            self.held[part] = sorted(tuple(r) for r in self.directory.where(F.col("part") == part).select("file", "at", "size", "first_key", "last_key").collect())
        return self.held[part]

    def lookup(self, url: str) -> list[dict]:
        """The records of one URL, over byte ranges only."""
        key, found = url_key(url), []
        for p in _between(self.first, self.last, key):
            blocks = self._blocks(self.part[p])
            for i in _between([b[3] for b in blocks], [b[4] for b in blocks], key):
                for x in _lines_of(_block(*self.index, *blocks[i][:3]), key):
                    with self.archives[0].open_input_file(f"{self.archives[1]}/{x[2]}") as f:
                        found.append(parse(zlib.decompress(f.read_at(x[4], x[3]), 31)))
        return [r for r in found if r["url"] == url]


def lookup_all(urls: DataFrame, directory: DataFrame, index_at: str, archives_at: str, *, url_col: str = "url") -> DataFrame:
    """All records of the URLs of a table, with their payloads (null for revisits). A URL that is asked for twice is found once."""
    parts = _parts(directory)
    first, last, number = [p[0] for p in parts], [p[1] for p in parts], [p[2] for p in parts]
    asked_schema = pa.schema([("part", pa.int64()), ("key", pa.string())])
    place_schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def dealt(batches):
        for b in pieces(batches, 4096):
            rows = {(number[p], key) for key in map(url_key, b.column(0).to_pylist()) for p in _between(first, last, key)}
            yield batch(asked_schema, part=[r[0] for r in rows], key=[r[1] for r in rows])

    def searched(one: pa.Table, two: pa.Table) -> pa.Table:
        system, folder = store(index_at)
        two = two.sort_by([("file", "ascending"), ("at", "ascending")])
        blocks = list(zip(*(two.column(c).to_pylist() for c in ("file", "at", "size")), strict=True))
        starts, ends = two.column("first_key").to_pylist(), two.column("last_key").to_pylist()
        wanted: dict[int, list[str]] = {}
        for key in one.column("key").to_pylist():
            for i in _between(starts, ends, key):
                wanted.setdefault(i, []).append(key)
        found = []
        for i, keys in sorted(wanted.items()):
            lines = _block(system, folder, *blocks[i])
            found += [x for key in keys for x in _lines_of(lines, key)]
        return pa.Table.from_batches([batch(place_schema, file=[x[2] for x in found], at=[x[3] for x in found], size=[x[4] for x in found])])

    wanted = urls.select(F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url")).distinct()
    asked = wanted.select("url").mapInArrow(dealt, "part long, key string").distinct()
    places = asked.groupBy("part").cogroup(directory.groupBy("part")).applyInArrow(searched, "file string, at long, size long")
    # Other URLs may have the same key.
    return _records(places, archives_at).join(wanted, "url", "left_semi")


def read_archives(directory: DataFrame, index_at: str, archives_at: str) -> DataFrame:
    """Every record that the index names, read by its byte range, with its payload (null for revisits)."""

    def entries(batches):
        system, folder = store(index_at)
        schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])
        for b in batches:
            for file, at, size in zip(*(b.column(k).to_pylist() for k in ("file", "at", "size")), strict=True):
                lines = _block(system, folder, file, at, size)
                yield batch(schema, file=[x[2] for x in lines], at=[x[3] for x in lines], size=[x[4] for x in lines])

    return _records(directory.select("file", "at", "size").repartition("file", "at").mapInArrow(entries, "file string, at long, size long"), archives_at)


def _records(places: DataFrame, archives_at: str) -> DataFrame:
    """The records at these places. A file's are read in their order; a long file is dealt out in stretches."""

    def records(batches):
        system, folder = store(archives_at)
        name, f = None, None
        for b in pieces(batches, 256):
            rows = []
            for file, at, size in zip(*(b.column(k).to_pylist() for k in ("file", "at", "size")), strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, system.open_input_file(f"{folder}/{file}")
                rows.append(parse(zlib.decompress(f.read_at(size, at), 31)))
            yield batch(_RECORD_ARROW, **{k: [r[k] for r in rows] for k in _RECORD_ARROW.names})
        if f is not None:
            f.close()

    stretch = F.floor(F.col("at") / (1 << 24))
    return places.withColumn("stretch", stretch).repartition("file", "stretch").sortWithinPartitions("file", "at").select("file", "at", "size").mapInArrow(records, _RECORD)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, indexed, and looked up again by their URLs."""
    archives, index = shared_dir(spark, "warc"), shared_dir(spark, "cdx")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    captures = write_archives(pages, archives)
    directory = write_index(captures, index)
    return lookup_all(pages, directory, index, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = r"""
with p as (select page_id, coalesce(html, '') as t from pages),
h as (select page_id, strlen(t) as n, sha1(t) as x from p),
f as (select x, min(page_id) as first from h group by x)
select h.page_id, h.n as payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h.x, 1 + 5 * (i // 4), 5))::bigint // (1::bigint << (15 - 5 * (i % 4)))) % 32)::bigint, 1)), '') as payload_digest,
       case when h.page_id = f.first then 'response' else 'revisit' end as record_type,
       case when h.page_id = f.first then null else f.first end as refers_to
from h join f using (x)
"""
