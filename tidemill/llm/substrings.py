"""Repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

A window of WINDOW consecutive words has two hashes, to different bases. The first travels, the
second names the bucket in which windows meet; so two windows count as equal when 64 bits and
the bucket number agree, about 75 bits with a few hundred partitions and more with more.

1. A task takes slices of some million words. Of equal windows of a slice only the one in the
   document with the smallest id goes on; the windows of the others are settled, and leave as
   spans of word numbers. So a window that a third of all documents share goes on once a slice.
2. The windows of a slice travel in one row per bucket: hashes, and document ids as gaps. In a
   bucket every window but the one with the smallest id is marked.
3. Spans and marks return to their documents, where the windows they cover merge into maximal
   intervals, which are removed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small, utf8
from tidemill.llm.words import RollingHash, U, WordHashes
from tidemill.runtime import shuffle_partitions

WINDOW = 50
# Words of a slice; a longer text is a slice of its own.
SLICE_WORDS = 1 << 20
BUCKETS_PER_PARTITION = 8
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)

_ROWS = pa.schema(
    [("bucket", pa.int32()), ("base", pa.int64()), ("gaps", pa.binary()), ("hashes", pa.list_(pa.int64())),
     ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.list_(pa.int64()))]
)
_ROWS_SPARK = "bucket int, base bigint, gaps binary, hashes array<bigint>, doc_id bigint, text_hash bigint, spans array<bigint>"
_MARKS = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("text_hash", pa.int64()), ("spans", pa.list_(pa.int64()))])
_MARKS_SPARK = "doc_id bigint, hash bigint, text_hash bigint, spans array<bigint>"


def text_hash(text: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))


def packed_gaps(ids: np.ndarray) -> tuple[int, bytes]:
    """First of the ascending numbers, and the differences in the narrowest type that holds them."""
    gaps = np.diff(ids, prepend=ids[0]).view(U)
    return int(ids[0]), gaps.astype(np.min_scalar_type(gaps.max())).tobytes()


def unpacked_gaps(base: int, gaps: bytes, count: int) -> np.ndarray:
    return base + np.cumsum(np.frombuffer(gaps, f"u{len(gaps) // count}").astype(np.int64))


def intervals(starts: np.ndarray, window: int, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by windows at the ascending ``starts``; where ``apart``
    changes, a new interval begins."""
    new = np.ones(len(starts), bool)
    new[1:] = np.diff(starts) > window
    if apart is not None:
        new[1:] |= apart[1:] != apart[:-1]
    first = np.flatnonzero(new)
    return starts[first], starts[np.append(first[1:], len(starts)) - 1] + window


def _groups(keys: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal values."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).astype(np.int32)


class _Slice:
    """Documents of one task whose windows are compared with each other before they leave."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.hash_of = [RollingHash(base, window) for base in _BASES]
        self.clear()

    def clear(self) -> None:
        self.docs, self.words = [], 0

    def add(self, doc_id: int, text: bytes, hashes: np.ndarray) -> None:
        self.docs.append((doc_id, text_hash(text), hashes))
        self.words += len(hashes)

    def rows(self):
        self.docs.sort(key=lambda d: d[0])
        ids = np.array([d[0] for d in self.docs], np.int64)
        texts = np.array([d[1] for d in self.docs], np.int64)
        sizes = np.array([len(d[2]) for d in self.docs])
        words = np.concatenate([d[2] for d in self.docs])
        self.clear()
        ends = np.cumsum(sizes)
        begins = ends - sizes
        doc = np.repeat(np.arange(len(ids)), sizes - self.window + 1)
        place = np.arange(len(doc)) + (doc * (self.window - 1))
        one, two = (rolling(words)[place] for rolling in self.hash_of)
        del words

        order = np.argsort(one, kind="stable")
        same = one[order[1:]] == one[order[:-1]]
        if (two[order[1:]] != two[order[:-1]])[same].any():
            order = np.lexsort((two, one))
            same = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
        new = np.concatenate([[True], ~same])
        head = order[new]
        ahead, later = head[np.cumsum(new) - 1][~new], order[~new]
        settled = np.sort(later[ids[doc[later]] > ids[doc[ahead]]])
        if len(settled):
            yield self._spans(ids, texts, begins, doc[settled], place[settled])
        yield self._windows(np.sort(head), one, two, ids[doc])

    def _spans(self, ids, texts, begins, doc, place) -> pa.RecordBatch:
        first, end = intervals(place, self.window, doc)
        owner = doc[np.searchsorted(place, first)]
        flat = np.stack([first - begins[owner], end - begins[owner]], 1).ravel()
        cut = _groups(owner)
        owners = owner[cut[:-1]]
        return self._batch(
            bucket=ids[owners] % self.buckets, doc_id=ids[owners], text_hash=texts[owners],
            spans=pa.ListArray.from_arrays(pa.array(2 * cut, pa.int32()), pa.array(flat, pa.int64())),
        )

    def _windows(self, head, one, two, ids) -> pa.RecordBatch:
        bucket = (((two[head] >> U(32)) * U(self.buckets)) >> U(32)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if self.buckets < 1 << 16 else bucket, kind="stable")
        bucket, head = bucket[order], head[order]
        cut = _groups(bucket)
        gaps = [packed_gaps(ids[head[b:e]]) for b, e in zip(cut, cut[1:])]
        return self._batch(
            bucket=bucket[cut[:-1]], base=[g[0] for g in gaps], gaps=[g[1] for g in gaps],
            hashes=pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(one[head].view(np.int64))),
        )

    @staticmethod
    def _batch(**columns) -> pa.RecordBatch:
        made = {name: v if isinstance(v, pa.Array) else pa.array(v, _ROWS.field(name).type) for name, v in columns.items()}
        n = len(made["bucket"])
        return pa.RecordBatch.from_arrays([made[f.name] if f.name in made else pa.nulls(n, f.type) for f in _ROWS], schema=_ROWS)


def _sliced(window: int, buckets: int, slice_words: int):
    def run(batches):
        memo, held = WordHashes(), _Slice(window, buckets)
        for batch in small(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = text.split()
                if len(words) >= window:
                    if held.words and held.words + len(words) > slice_words:
                        yield from held.rows()
                    held.add(doc_id, text, memo.of(words))
        if held.words:
            yield from held.rows()

    return run


def _settled(parts) -> tuple[np.ndarray, np.ndarray]:
    """Ids and hashes of the windows of a whole bucket that a document with a smaller id has too."""
    hashes, ids = (np.concatenate(p) for p in zip(*parts))
    order = np.lexsort((ids, hashes))
    hashes, ids = hashes[order], ids[order]
    cut = _groups(hashes)
    marked = ids > np.repeat(ids[cut[:-1]], np.diff(cut))
    return ids[marked], hashes[marked]


def _marked(batches):
    """Marks of every bucket, which comes as neighboring rows; spans pass through."""
    bucket, parts = None, []

    def marks():
        ids, hashes = _settled(parts)
        for b in range(0, len(ids), 10_000):
            n = len(ids[b : b + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[b : b + n]), pa.array(hashes[b : b + n]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))], schema=_MARKS
            )

    for batch in small(batches, 64):
        spans = batch.filter(batch.column("doc_id").is_valid())
        if spans.num_rows:
            yield pa.RecordBatch.from_arrays([spans.column("doc_id"), pa.nulls(spans.num_rows, pa.int64()), spans.column("text_hash"), spans.column("spans")], schema=_MARKS)
        for number, base, gaps, hashes in zip(*(batch.column(n) for n in ("bucket", "base", "gaps", "hashes"))):
            if not base.is_valid:
                continue
            if number.as_py() != bucket:
                if parts:
                    yield from marks()
                bucket, parts = number.as_py(), []
            values = hashes.values.to_numpy()
            parts.append((values, unpacked_gaps(base.as_py(), gaps.as_py(), len(values))))
    if parts:
        yield from marks()


def repeated_windows(docs: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``doc_id, hash, text_hash, spans``: what each document loses.

    Some rows of a document carry a window's hash, others spans of word numbers (start, end,
    start, end, ...) that hold for its row of that text only.
    """
    parts = shuffle_partitions(docs)
    buckets = BUCKETS_PER_PARTITION * parts
    known = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    rows = known.mapInArrow(_sliced(window, buckets, slice_words), _ROWS_SPARK)
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_marked, _MARKS_SPARK)


def drop_repeated_windows(docs: DataFrame, window: int = WINDOW, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``docs`` with the kept words as ``text``, and with ``n_words, n_removed, removed``.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window``
    words covers it whose words also stand, in this order, in a document with a smaller
    ``doc_id``; all windows are judged on the input. The kept words are joined by one space;
    ``removed`` lists the maximal intervals of removed words as ``start, end`` (from 0, end
    exclusive). A null or blank text has no words and becomes empty; a text shorter than a
    window loses nothing. Rows of one ``doc_id`` are no reason to remove from each other, and
    lose the same windows. A row with a null ``doc_id`` loses nothing and gives no reason to
    remove. ``text, n_words, n_removed, removed`` of the input are replaced, all other columns
    stay. An empty table gives an empty result.
    """
    kept = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       *others(docs, "doc_id", "text", "n_words", "n_removed", "removed"))
    lists = repeated_windows(kept, window, slice_words).groupBy(F.col("doc_id").alias("__losing_id")).agg(
        F.collect_list("hash").alias("__hashes"),
        F.collect_list(F.when(F.col("spans").isNotNull(), F.struct("text_hash", "spans"))).alias("__spans"),
    )
    joined = kept.join(lists, F.col("doc_id") == F.col("__losing_id"), "left").drop("__losing_id")
    return _rebuilt(joined, window)


def _covered(text: bytes, words: list[bytes], hashes: list[int], spans: list[dict], rolling, memo) -> np.ndarray:
    """Which words are removed."""
    edge = np.zeros(len(words) + 1, np.int64)
    mine = text_hash(text) if spans else None
    for span in spans:
        if span["text_hash"] == mine:
            edge[span["spans"][0::2]] += 1
            edge[span["spans"][1::2]] -= 1
    if hashes and len(words) >= rolling.window:
        starts = np.flatnonzero(np.isin(rolling(memo.of(words)).view(np.int64), np.array(hashes, np.int64)))
        if len(starts):
            first, end = intervals(starts, rolling.window)
            edge[first] += 1
            np.subtract.at(edge, end, 1)
    return np.cumsum(edge[:-1]) > 0


def _rebuilt(joined: DataFrame, window: int) -> DataFrame:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [f for f in joined.schema.fields if f.name not in ("__hashes", "__spans")]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("removed", T.ArrayType(span))])
    names = [f.name for f in fields]
    arrow = to_arrow_schema(schema)

    def run(batches):
        memo, rolling = WordHashes(), RollingHash(_BASES[0], window)
        for batch in small(batches):
            texts, n_words, n_removed, removed = [], [], [], []
            for text, hashes, spans in zip(utf8(batch.column("text")), *(batch.column(c).to_pylist() for c in ("__hashes", "__spans"))):
                words = text.split()
                n_words.append(len(words))
                gone = _covered(text, words, hashes, spans, rolling, memo) if hashes or spans else np.zeros(0, bool)
                n_removed.append(int(gone.sum()))
                if n_removed[-1]:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]))).tolist()
                    removed.append([{"start": b, "end": e} for b, e in zip(edge[0::2], edge[1::2])])
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    removed.append([])
                texts.append(b" ".join(words))
            columns = {name: batch.column(name) for name in names}
            made = {"text": pa.array(texts, pa.binary()).cast(pa.string()), "n_words": n_words, "n_removed": n_removed, "removed": removed}
            columns |= {n: v if isinstance(v, pa.Array) else pa.array(v, arrow.field(n).type) for n, v in made.items()}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in arrow], names=arrow.names)

    return joined.mapInArrow(run, schema)
