"""Line deduplication with two Bloom filters.

First pass: every task puts the keys of its lines into a filter of keys seen once and, where
all bits of a key are set already, into a filter of keys seen twice. Two tasks' filters merge
as ``twice = twice | twice' | (once & once')`` and ``once = once | once'``, bit by bit; a key
of two tasks has all its bits in both ``once`` and so in ``twice``. No repeated key is missed.

Second pass: lines whose key is not in ``twice`` occur in one document only and stay where
they are. Only the others shuffle, as digests, to find out exactly which documents hold them.

The filters have a fixed upper size. A table with more lines than they serve well makes more
lines suspects, never a wrong result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small, stored, utf8
from tidemill.runtime import shuffle_partitions

MIN_LENGTH = 10
# The filters are cut into segments of this many bits; a key lies within one segment.
SEGMENT_BITS = 1 << 20
# At most 256 segments, 32 MB in all: the size bound of what is broadcast.
MAX_SEGMENTS = 256
BITS_PER_LINE = 12
# Bits per key; fewer where the filter has less room per line, as the usual optimum ln 2 * bits / keys.
HASHES = 4
_BLANK = b" \t\n\x0b\x0c\r"
_MASK = (1 << 64) - 1


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def document_keys(text: bytes, least: int = MIN_LENGTH) -> set[bytes]:
    """The distinct keys of a text that are long enough to count."""
    return {key for key in map(line_key, text.split(b"\n")) if _long_enough(key, least)}


def _bits(keys, segments: int, segment_bits: int = SEGMENT_BITS, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Segment of every key, and its bit positions within the segment."""
    low = np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64)
    high = (low >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(hashes, dtype=np.uint64)[:, None]
    mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (low >> np.uint64(29))
    segment = ((mixed >> np.uint64(20)) % np.uint64(segments)).astype(np.int64)
    return segment, ((low + steps * high) % np.uint64(segment_bits)).astype(np.int64)


class _Filters:
    """Bit arrays of the segments that were touched."""

    def __init__(self, segment_bits: int = SEGMENT_BITS):
        self.segment_bits = segment_bits
        self.once: dict[int, np.ndarray] = {}
        self.twice: dict[int, np.ndarray] = {}

    def add(self, segment: np.ndarray, bits: np.ndarray) -> None:
        for s in np.unique(segment):
            once = self.once.setdefault(int(s), np.zeros(self.segment_bits, bool))
            twice = self.twice.setdefault(int(s), np.zeros(self.segment_bits, bool))
            mine = bits[:, segment == s]
            # Keys of one call may share bits; those set by an earlier key of the call count too.
            flat = mine.T
            seen = once[flat].all(axis=1)
            order = np.sort(flat, axis=None)
            repeated = order[1:][order[1:] == order[:-1]]
            if repeated.size:
                shared = np.zeros(self.segment_bits, bool)
                shared[repeated] = True
                seen |= (once | shared)[flat].all(axis=1)
            twice[flat[seen].ravel()] = True
            once[flat.ravel()] = True

    def merge(self, s: int, once: np.ndarray, twice: np.ndarray) -> None:
        if s in self.once:
            self.twice[s] |= twice | (self.once[s] & once)
            self.once[s] |= once
        else:
            self.once[s], self.twice[s] = once, twice

    def rows(self, press):
        for s in self.once:
            yield s, press.compress(np.packbits(self.once[s]).tobytes()), press.compress(np.packbits(self.twice[s]).tobytes())


_PARTIAL = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def _unpacked(packed: bytes, expand) -> np.ndarray:
    return np.unpackbits(np.frombuffer(expand.decompress(packed), np.uint8)).astype(bool)


def _emit(filters: _Filters):
    press = zstandard.ZstdCompressor(level=1)
    for row in filters.rows(press):
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _PARTIAL)], schema=_PARTIAL)


def twice_filter(docs: DataFrame, least: int = MIN_LENGTH, segment_bits: int = SEGMENT_BITS, max_segments: int = MAX_SEGMENTS) -> tuple[list[bytes], int]:
    """Packed bits of the filter of keys that may be in two documents, by segment; bits per key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = docs.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    segments = int(min(max_segments, max(1, -(-lines * BITS_PER_LINE // segment_bits))))
    hashes = int(min(HASHES, max(1, round(0.69 * segments * segment_bits / max(1, lines)))))

    def partial(batches):
        filters = _Filters(segment_bits)
        for batch in small(batches):
            keys = [key for text in utf8(batch.column(0)) for key in document_keys(text, least)]
            if keys:
                filters.add(*_bits(keys, segments, segment_bits, hashes))
        yield from _emit(filters)

    def merged(batches):
        filters, expand = _Filters(segment_bits), zstandard.ZstdDecompressor()
        for batch in batches:
            for s, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
                filters.merge(s, _unpacked(once, expand), _unpacked(twice, expand))
        yield from _emit(filters)

    schema = "segment int, once binary, twice binary"
    parts = docs.select("text").mapInArrow(partial, schema)
    whole = parts.repartition(min(segments, shuffle_partitions(docs)), "segment").mapInArrow(merged, schema)
    expand = zstandard.ZstdDecompressor()
    found = {row["segment"]: expand.decompress(row["twice"]) for row in whole.select("segment", "twice").toLocalIterator()}
    return [found.get(s, bytes(segment_bits // 8)) for s in range(segments)], hashes


def suspects(docs: DataFrame, twice: tuple[list[bytes], int], least: int = MIN_LENGTH) -> DataFrame:
    """``doc_id, digest``: one row per document and key that the filter does not rule out."""
    shared = docs.sparkSession.sparkContext.broadcast(twice)
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        packed, hashes = shared.value
        segment_bits = 8 * len(packed[0])
        table = np.frombuffer(b"".join(packed), np.uint8)
        for batch in small(batches):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                own = document_keys(text, least)
                keys.extend(own)
                ids.extend([doc_id] * len(own))
            if not keys:
                continue
            segment, bits = _bits(keys, len(packed), segment_bits, hashes)
            place = segment * segment_bits + bits
            hit = ((table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).all(axis=0)
            rows = np.flatnonzero(hit)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in rows], pa.int64()), pa.array([hashlib.sha256(keys[i]).digest() for i in rows], pa.binary())],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, digest binary")


def drop_repeated_lines(docs: DataFrame, least: int = MIN_LENGTH, **filter_size: int) -> DataFrame:
    """``docs`` with the kept text, and with ``n_lines`` and ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of at
    least ``least`` code points that are in two documents or more lose their lines except in
    the document of the smallest ``doc_id``. A null text is one empty line and becomes empty.
    Rows of one ``doc_id`` are one document. A row with a null ``doc_id`` is left as it is and
    gives no reason to drop a line. ``text, n_lines, n_dropped`` of the input are replaced, all
    other columns stay. An empty table gives an empty result.
    """
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *others(docs, "doc_id", "text", "n_lines", "n_dropped"))
    known = kept.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    pairs = stored(suspects(known, twice_filter(known, least, **filter_size), least), "line-suspects")
    holders = pairs.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Stored, so that both sides of the next join come straight from a shuffle and a hot line can be
    # split; nothing after the join needs the rows of a digest together.
    repeated = stored(holders.filter(F.col("first") < F.col("last")).select("digest", "first"), "repeated-lines")
    losing = pairs.join(repeated, "digest").filter(F.col("doc_id") != F.col("first"))
    lists = losing.groupBy(F.col("doc_id").alias("__losing_id")).agg(F.collect_set("digest").alias("__losing_lines"))
    joined = kept.join(lists, F.col("doc_id") == F.col("__losing_id"), "left").drop("__losing_id")
    return _rebuilt(joined, least)


def _rebuilt(joined: DataFrame, least: int) -> DataFrame:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [f for f in joined.schema.fields if f.name != "__losing_lines"]
    schema = T.StructType([*fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = [f.name for f in fields]
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in small(batches):
            texts, n_lines, n_dropped = [], [], []
            for text, losing in zip(utf8(batch.column("text")), batch.column("__losing_lines").to_pylist()):
                if losing is None:
                    texts.append(text)
                    n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(0)
                    continue
                lines, gone = text.split(b"\n"), set(losing)
                stay = [x for x in lines if not (_long_enough(key := line_key(x), least) and hashlib.sha256(key).digest() in gone)]
                texts.append(b"\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            columns = {name: batch.column(name) for name in names}
            columns |= {
                "text": pa.array(texts, pa.binary()).cast(pa.string()),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_dropped": pa.array(n_dropped, pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in arrow], names=arrow.names)

    return joined.mapInArrow(run, schema)
