"""Web archives with a two-level capture index.

Writing: every task writes its pages as WARC records, each a gzip member of its own, into one
archive. A payload that another page already has becomes a revisit record.

Index: captures are sorted by key (host reversed, then path) and page id. A task writes its range
as one index file: compressed blocks of BLOCK captures, then the sparse directory with the first
key of every block. One row per index file, with the file's first key, is the upper level.

Reading: a key goes by binary search to its index file, there by binary search in the directory
to a block, and in the block to its captures; the records come by range reads from the archives.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import struct
import zlib
from bisect import bisect_left, bisect_right
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.files import Reader, new_name, opened
from tidemill.llm.shared import small, stored, utf8
from tidemill.runtime import scratch_path

REVISIT_BYTES = 100
BLOCK = 256
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PRINTABLE = "".join(map(chr, range(33, 127)))
_TAIL = "<QQ8s"  # begin and length of the directory, magic
_MAGIC = b"TCDXIDX1"

_CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("archive", pa.string()), ("begin", pa.int64()), ("size", pa.int64())])
_CAPTURE_SQL = "key string, page_id bigint, archive string, begin bigint, size bigint"


def url_key(url: str | None) -> str:
    """``org,example,www)/path?query`` of a URL; one that cannot be split is its own key."""
    if url is None:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url
    if not host:
        return url
    port_text = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}{port_text}){parts.path or '/'}{query}"


def _record_id(page_id) -> str:
    return f"<urn:tidemill:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str):
    text = record_id[len("<urn:tidemill:page:") : -1]
    return int(text) if text else None


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record as a gzip member; a revisit has the HTTP head without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {quote(url, safe=_PRINTABLE)}"]),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"] if revisit else []),
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> tuple:
    """``(page_id, type, payload length, digest, refers_to, payload)``; checks lengths and digest."""
    data = gzip.decompress(member)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record has the wrong length")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload is not the one of its digest")
    refers = fields.get("WARC-Refers-To")
    return _page_id(fields["WARC-Record-ID"]), kind, size, digest, _page_id(refers) if refers else None, payload


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages below ``folder``; the captures, one row per record."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    sized = rows.filter(F.octet_length("html") >= least)
    firsts = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    # Stored, so that both sides of the next join come straight from a shuffle and a hot payload can be split.
    firsts = stored(firsts.filter((F.col("n") > 1) & F.col("first").isNotNull()).select("digest", "first"), "first-pages")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull()), F.col("first"))
    ready = rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", refers.alias("refers_to"))

    def run(batches):
        name, file, at = new_name("archive", TaskContext.get().partitionId(), "warc.gz"), None, 0
        for batch in small(batches):
            if file is None:
                store, path = opened(folder)
                store.create_dir(path)
                file = store.open_output_stream(f"{path}/{name}", compression=None)
            ids, urls, digests, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            begins, sizes = [], []
            for page_id, url, payload, digest, first in zip(ids, urls, utf8(batch.column(2)), digests, refers):
                member = record(page_id, url, payload, digest, first)
                file.write(member)
                begins.append(at)
                sizes.append(len(member))
                at += len(member)
            made = ([url_key(u) for u in urls], ids, [name] * len(ids), begins, sizes)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(made, _CAPTURE)], schema=_CAPTURE)
        if file is not None:
            file.close()

    return stored(ready.mapInArrow(run, _CAPTURE_SQL), "captures")


def _place(key: str, page_id) -> tuple:
    """Sort order of captures, the one Spark uses: by UTF-8 bytes, null ids first."""
    return (key.encode(), page_id is not None, page_id or 0)


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index files; ``file, first_key, first_page`` with one row per file."""

    def run(batches):
        name, held, blocks, at = new_name("index", TaskContext.get().partitionId(), "cdx"), [], [], 0
        file = None

        def flush():
            nonlocal at, file
            if file is None:
                store, path = opened(folder)
                store.create_dir(path)
                file = store.open_output_stream(f"{path}/{name}", compression=None)
            data = zlib.compress("\n".join(json.dumps(c) for c in held).encode())
            blocks.append([held[0][0], held[0][1], at, len(data)])
            file.write(data)
            at += len(data)
            held.clear()

        for batch in batches:
            for capture in zip(*(batch.column(i).to_pylist() for i in range(5))):
                held.append(capture)
                if len(held) == BLOCK:
                    flush()
        if held:
            flush()
        if file is not None:
            directory = zlib.compress(json.dumps(blocks).encode())
            file.write(directory + struct.pack(_TAIL, at, len(directory), _MAGIC))
            file.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([blocks[0][0]], pa.string()), pa.array([blocks[0][1]], pa.int64())], names=["file", "first_key", "first_page"]
            )

    order = (F.col("key"), F.col("page_id").asc_nulls_first())
    spread = captures.repartitionByRange(*order).sortWithinPartitions(*order, "archive", "begin")
    return stored(spread.mapInArrow(run, "file string, first_key string, first_page bigint"), "capture-index")


class _IndexFile:
    """Directory of one index file, and its last block."""

    def __init__(self, reader: Reader, name: str):
        self.reader, self.name = reader, name
        size = reader.open(name).size()
        tail = struct.calcsize(_TAIL)
        begin, length, magic = struct.unpack(_TAIL, reader.read(name, size - tail, tail))
        if magic != _MAGIC:
            raise ValueError(f"{name} is not an index file")
        self.blocks = json.loads(zlib.decompress(reader.read(name, begin, length)))
        self.firsts = [_place(b[0], b[1]) for b in self.blocks]
        self.number = -1

    def _load(self, number: int) -> None:
        if number != self.number:
            _, _, begin, length = self.blocks[number]
            lines = zlib.decompress(self.reader.read(self.name, begin, length)).decode().split("\n")
            self.captures = [json.loads(line) for line in lines]
            self.places = [_place(c[0], c[1]) for c in self.captures]
            self.number = number

    def find(self, key: str, page_id):
        """All captures of a key and page; equal ones may go over several blocks."""
        want = _place(key, page_id)
        number = max(0, bisect_left(self.firsts, want) - 1)
        while number < len(self.blocks) and self.firsts[number] <= want:
            self._load(number)
            yield from self.captures[bisect_left(self.places, want) : bisect_right(self.places, want)]
            number += 1


class Archives:
    """Archives and index of one table of pages."""

    def __init__(self, folder: str, index: DataFrame, archives: int):
        self.folder, self.index, self.archives = folder, index, archives

    def locate(self, wanted: DataFrame) -> DataFrame:
        """The captures of ``url, page_id``; every wanted pair is looked up once."""
        files = sorted((_place(r["first_key"], r["first_page"]), r["file"]) for r in self.index.collect())
        firsts, names, folder = [f for f, _ in files], [n for _, n in files], self.folder
        asked = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string())])

        def assign(batches):
            for batch in batches:
                keys, ids, rows = [url_key(u) for u in batch.column(0).to_pylist()], batch.column(1).to_pylist(), []
                for key, page_id in zip(keys, ids):
                    want = _place(key, page_id)
                    first = max(0, bisect_left(firsts, want) - 1)
                    rows += [(key, page_id, names[i]) for i in range(first, max(first + 1, bisect_right(firsts, want))) if names]
                columns = list(zip(*rows)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, asked)], schema=asked)

        def look(batches):
            reader, index = Reader(folder), None
            for batch in batches:
                rows = []
                for key, page_id, name in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    if index is None or index.name != name:
                        index = _IndexFile(reader, name)
                    rows += index.find(key, page_id)
                columns = list(zip(*rows)) or [()] * len(_CAPTURE)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _CAPTURE)], schema=_CAPTURE)
            reader.close()

        pairs = wanted.select(F.col("url").cast("string"), F.col("page_id").cast("bigint")).distinct()
        dealt = pairs.mapInArrow(assign, "key string, page_id bigint, file string").distinct().repartition(max(1, len(names)), "file")
        ordered = dealt.sortWithinPartitions("file", "key", F.col("page_id").asc_nulls_first())
        return ordered.mapInArrow(look, _CAPTURE_SQL)

    def read(self, captures: DataFrame, payload: bool = False) -> DataFrame:
        """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records.

        With ``payload`` also the payload itself, null for revisits.
        """
        folder = self.folder
        fields = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        schema = pa.schema(fields if payload else fields[:-1])

        def run(batches):
            reader = Reader(folder)
            for batch in batches:
                rows = []
                for name, begin, size in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
                    page_id, kind, length, digest, refers, body = parsed(reader.read(name, begin, size))
                    rows.append((page_id, length, digest, kind, refers, None if kind == "revisit" else body))
                columns = list(zip(*rows)) or [()] * len(fields)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)
            reader.close()

        # A task per archive: the rows are few bytes, the work is in what they point to.
        ordered = captures.repartition(max(1, self.archives), "archive").sortWithinPartitions("archive", "begin")
        sql = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
        return ordered.mapInArrow(run, sql + (", payload binary" if payload else ""))


def archive_pages(pages: DataFrame, least: int = REVISIT_BYTES) -> Archives:
    """Write archives and index of a table ``page_id, url, html`` below the shared folder.

    Of records with equal payloads of at least ``least`` bytes the one with the smallest page id
    is a response and the others revisit it. Rows that share this smallest id are all responses;
    where no row has an id all are. A null html is an empty payload, a null url has the empty key,
    a null id an id without a number. Other columns are not read. An empty table has no archive.
    """
    folder = scratch_path(pages.sparkSession, "archives")
    captures = write_archives(pages, folder, least)
    return Archives(folder, build_index(captures, folder), captures.select("archive").distinct().count())
