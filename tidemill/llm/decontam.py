"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items has one state per class of word sequences that end
at the same places. Training words stream through it; the length of the longest suffix that
occurs in an item is known after every word. Where that length reaches a window (``window``
words, or a whole item of fewer words) the words of the window are hit. Hit spans, and texts
of which too large a share is hit, are removed.

Most words of a text cannot be part of a window: a match of m words needs m - 1 neighboring
word pairs that occur in items. Only stretches with enough such pairs stream through the
automaton; this loses nothing.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small, stored, utf8

WINDOW = 10
# A text with a larger share of hit words is dropped whole.
MAX_COVERAGE = 0.5
# Item words of one automaton: the size bound of what is built on the driver and broadcast,
# some 1.2 KB a word while it is built. More items are taken in several blocks.
BLOCK_WORDS = 100_000

# Word characters are digits, letters and everything beyond ASCII; A-Z count as a-z.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class ItemAutomaton:
    """Suffix automaton over the word ids of all items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.item_ids = [item for item, _ in items]
        coded = []
        for _, own in items:
            coded.append([self.ids.setdefault(w, len(self.ids) + 1) for w in own])
            last = 0
            for c in coded[-1]:
                last = self._extend(last, c)
        self._mark(coded)
        pairs = {(a << 32) | b for own in coded for a, b in zip(own, own[1:])}
        self.pairs = np.array(sorted(pairs), np.uint64)
        sizes = [min(window, len(own)) for own in coded if own]
        self.least = min(sizes) if sizes else 0

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        made = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = made
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = made
            p = link[p]
        return made

    def _mark(self, coded: list[list[int]]) -> None:
        """Windows by the state that holds them: ``found[state]`` is [(window length, items)]."""
        found: dict[int, dict[int, set[int]]] = {}
        for number, own in enumerate(coded):
            if not own:
                continue
            size = min(self.window, len(own))
            state, matched = 0, 0
            for c in own:
                state, matched = self.step(state, matched, c)
                if matched >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    found.setdefault(at, {}).setdefault(size, set()).add(number)
        self.found = {state: sorted((size, frozenset(own)) for size, own in sizes.items()) for state, sizes in found.items()}
        # The nearest state with windows, from each state upwards along its links.
        self.above = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.above[state] = state if state in self.found else self.above[self.link[state]]

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], matched + 1
        return 0, 0

    def windows(self, state: int, matched: int):
        """``(length, item numbers)`` of all windows that end here."""
        at = self.above[state]
        while at > 0:
            for size, own in self.found[at]:
                if size <= matched:
                    yield size, own
            at = self.above[self.link[at]]

    def scan(self, own: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Mask of the hit words, and the numbers of the items found."""
        n = len(own)
        mask, items = np.zeros(n, bool), set()
        if n < self.least or not self.least:
            return mask, items
        get = self.ids.get
        codes = np.fromiter((get(w, 0) for w in own), np.int64, n)
        for begin, end in self._stretches(codes):
            state, matched = 0, 0
            for i, c in enumerate(codes[begin:end].tolist(), begin):
                state, matched = self.step(state, matched, c)
                if matched >= self.least:
                    longest = 0
                    for size, numbers in self.windows(state, matched):
                        longest = max(longest, size)
                        items |= numbers
                    mask[i + 1 - longest : i + 1] = True
        return mask, items

    def _stretches(self, codes: np.ndarray):
        """Begins and ends of the stretches in which a window has room."""
        if self.least == 1:
            good, wide = codes > 0, 0
        else:
            both = (codes[:-1].astype(np.uint64) << np.uint64(32)) | codes[1:].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.pairs, both), len(self.pairs) - 1)
            good, wide = self.pairs[at] == both, 1
        edges = np.diff(np.concatenate(([0], good.astype(np.int8), [0])))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + wide
        room = ends - begins >= self.least
        return zip(begins[room].tolist(), ends[room].tolist())


def item_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS):
    """The items of a table ``item_id, text`` in lists of at most ``block_words`` words each.

    Texts without words are skipped; items without an id take part like all others. A longer
    item is cut into segments that overlap by a window less one word, so no window is lost.
    One list at a time is held.
    """
    block, total = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.filter(F.col("text").isNotNull()).distinct().orderBy("item_id", "text").toLocalIterator():
        own = words(row["text"].encode())
        step = max(1, block_words - window + 1)
        for begin in range(0, max(1, len(own) - window + 1), step) if own else ():
            segment = own[begin : begin + step + window - 1]
            if block and total + len(segment) > block_words:
                yield block
                block, total = [], 0
            block.append((row["item_id"], segment))
            total += len(segment)
    yield block


_RESULT = [("n_words", "bigint"), ("n_hit", "bigint"), ("n_items", "bigint"), ("items_sha256", "string"), ("contaminated", "boolean"), ("clean_text", "string")]


def _without(text: bytes, mask: np.ndarray) -> bytes:
    """``text`` without its hit words and what stands between two of them."""
    spaced = text.translate(_TABLE)
    out, at, cut = [], 0, 0
    ends = []
    for word in spaced.split():
        begin = spaced.index(word, at)
        at = begin + len(word)
        ends.append((begin, at))
    i = 0
    while i < len(ends):
        if mask[i]:
            j = i
            while j + 1 < len(ends) and mask[j + 1]:
                j += 1
            out.append(text[cut : ends[i][0]])
            cut = ends[j][1]
            i = j
        i += 1
    out.append(text[cut:])
    return b"".join(out)


def _described(text: bytes, own: list[bytes], mask: np.ndarray, ids: set[str | None]) -> tuple:
    """The columns of ``_RESULT``."""
    n_hit, named = int(mask.sum()), sorted(ids - {None})
    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
    clean = _without(text, mask).decode("utf-8", "replace") if n_hit else None
    return len(own), n_hit, len(ids), digest, n_hit > 0, clean


def _found_in(automaton: ItemAutomaton, text: bytes) -> tuple[list[bytes], np.ndarray, set[str | None]]:
    own = words(text)
    mask, numbers = automaton.scan(own)
    return own, mask, {automaton.item_ids[i] for i in numbers}


def _with_columns(batch: pa.RecordBatch, columns: list[str], rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    made = [pa.array(v, f.type) for v, f in zip(zip(*rows), arrow)] if rows else [pa.array([], f.type) for f in arrow]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *made], names=[*columns, *arrow.names])


_HITS = "text_hash binary, mask binary, ids array<string>"


def _hits(texts: DataFrame, automaton: ItemAutomaton) -> DataFrame:
    """``text_hash, mask, ids``: which words of a text one block of items hits, and the items found."""
    shared = texts.sparkSession.sparkContext.broadcast(automaton)

    def run(batches):
        for batch in small(batches):
            rows = []
            for text_hash, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                _, mask, ids = _found_in(shared.value, text)
                if ids:
                    rows.append((text_hash, np.packbits(mask).tobytes(), sorted(ids, key=lambda i: (i is None, i))))
            if rows:
                types = (pa.binary(), pa.binary(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=["text_hash", "mask", "ids"])

    found = stored(texts.mapInArrow(run, _HITS), "item-hits")
    shared.unpersist()
    return found


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items_sha256, contaminated, clean_text``.

    ``clean_text`` is the text without its hit spans, null where nothing is hit. A null text
    has no words. Columns of these names are replaced, all others stay. Rows are independent of each other,
    so repeated rows, null ids and empty tables need no rule; without items nothing is hit.
    All items without an id found count as one in ``n_items``; the digest is over the ids there are.

    Items of up to ``block_words`` words are one automaton, and documents stream past it. Of
    more items there is one automaton after the other; each leaves the mask and the items of the texts it
    hits, equal texts once, and these are put together for the columns.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    kept = docs.select(*others(docs, *(name for name, _ in _RESULT)))
    extra = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in _RESULT)).schema
    schema = T.StructType([*kept.schema.fields, *extra.fields])
    arrow, columns = to_arrow_schema(extra), kept.columns
    text = next(c for c in columns if c.lower() == "text")
    blocks = item_blocks(benchmark, window, block_words)
    automaton, following = ItemAutomaton(next(blocks), window), next(blocks, None)

    if following is None:
        shared = spark.sparkContext.broadcast(automaton)

        def run(batches):
            for batch in small(batches):
                yield _with_columns(batch, columns, [_described(x, *_found_in(shared.value, x)) for x in utf8(batch.column(text))], arrow)

        return kept.mapInArrow(run, schema)

    keyed = kept.withColumn("__text_hash", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    texts = keyed.select(F.col("__text_hash").alias("text_hash"), F.col(text).cast("string").alias("text"))
    hits = _hits(texts, automaton)
    while following is not None:
        hits = hits.unionByName(_hits(texts, ItemAutomaton(following, window)))
        following = next(blocks, None)
    # A text has one row per block at most. Stored, so that the join can split the rows of a text of many copies.
    per_text = hits.dropDuplicates(["text_hash", "ids", "mask"]).groupBy("text_hash").agg(
        F.collect_list("mask").alias("__masks"), F.array_distinct(F.flatten(F.collect_list("ids"))).alias("__ids")
    )
    per_text = stored(per_text.withColumnRenamed("text_hash", "__text_hash"), "text-hits")

    def described(batches):
        for batch in small(batches):
            rows = []
            for x, masks, ids in zip(utf8(batch.column(text)), *(batch.column(c).to_pylist() for c in ("__masks", "__ids"))):
                own = words(x)
                mask = np.zeros(len(own), bool)
                for packed in masks or ():
                    mask |= np.unpackbits(np.frombuffer(packed, np.uint8), count=len(own)).astype(bool)
                rows.append(_described(x, own, mask, set(ids or ())))
            yield _with_columns(batch, columns, rows, arrow)

    return keyed.join(per_text, "__text_hash", "left").mapInArrow(described, schema)


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` whose hit spans are cut out; texts of a larger hit share are dropped whole."""
    found = find_contamination(docs, benchmark, window, block_words)
    stay = found.filter(F.col("n_hit") <= max_coverage * F.col("n_words"))
    return stay.withColumn("text", F.coalesce("clean_text", "text")).select(*others(docs, *(name for name, _ in _RESULT)))
