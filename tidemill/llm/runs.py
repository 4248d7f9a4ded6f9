"""Periodic runs of words by longest common extensions on suffix trees.

A run is a maximal stretch whose words repeat with a smallest period and that is at least twice
as long as the period. Every run contains the longest Lyndon word that begins at some position,
for the order of the words or its inverse, with the run's period as its length (Bannai et al.,
"The Runs Theorem", SIAM J. Comput. 2017). So the 2n longest Lyndon words are the candidates. A
candidate is extended to both sides: to the right by the longest common extension of two
suffixes, to the left by that of two suffixes of the reversal. Both come from Ukkonen's suffix
trees: the extension is the depth of the lowest common ancestor of two leaves, a minimum over a
range of the Euler tour, answered from a table in constant time.

In a run of at least ``least`` words, at least ``least / 2`` successive words are equal to those
one period later. So every word of a run lies in a sequence of that many words that stands twice
in its text, and trees are only built of the stretches which such repeated sequences cover. In
prose these are few. A stretch of n words takes about 700 n bytes while it is searched.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import others, small, utf8
from tidemill.llm.substrings import intervals
from tidemill.llm.words import RollingHash, U, WordHashes, mix

MIN_LENGTH = 12
_BASE = 0x9E3779B97F4A7C15
_SPREAD = 0xC2B2AE3D27D4EB4F


class SuffixTree:
    """Ukkonen's tree of a sequence of positive numbers; 0 closes the sequence and sorts first."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        n, base = len(s), max(s) + 1
        start, end, link, suffix, child = [0], [0], [0], [-1], {}

        def grown(begin: int, stop: int, of: int) -> int:
            start.append(begin)
            end.append(stop)
            link.append(0)
            suffix.append(of)
            return len(start) - 1

        # Active point: `length` symbols below `node`, along the edge that begins with s[edge].
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            made = 0
            while waiting:
                if not length:
                    edge = i
                key = node * base + s[edge]
                below = child.get(key)
                if below is None:
                    child[key] = grown(i, n, i - waiting + 1)
                    if made:
                        link[made] = node
                        made = 0
                else:
                    size = end[below] - start[below]
                    if length >= size:
                        edge += size
                        length -= size
                        node = below
                        continue
                    cut = start[below] + length
                    if s[cut] == c:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    middle = child[key] = grown(start[below], cut, -1)
                    start[below] = cut
                    child[middle * base + s[cut]] = below
                    child[middle * base + c] = grown(i, n, i - waiting + 1)
                    if made:
                        link[made] = middle
                    made = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        keys = np.fromiter(child.keys(), np.int64, len(child))
        order = np.argsort(keys)
        self.n = len(symbols)
        self.size = [e - b for b, e in zip(start, end)]
        self.suffix = suffix
        self.children = np.fromiter(child.values(), np.int64, len(child))[order]
        self.owner = keys[order] // base
        self.first = np.searchsorted(self.owner, np.arange(len(start) + 1))
        self.closing = (keys[order] % base) == 0

    def tour(self, inverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Leaves of the Euler tour, as suffixes, and between each two the smallest depth.

        Children are visited by their first symbol, the closing one first; ``inverse`` turns
        the order of the others.
        """
        children, first = self.children, self.first
        # In the order in which they go on the stack, which gives them back in reverse.
        if inverse:
            stacked = children.copy()
            for at in np.flatnonzero(self.closing).tolist():
                stop = first[self.owner[at] + 1]
                stacked[at:stop] = np.roll(children[at:stop], -1)
        else:
            stacked = np.empty_like(children)
            stacked[first[self.owner] + first[self.owner + 1] - 1 - np.arange(len(children))] = children
        stacked = stacked.tolist()
        first, size, suffix = first.tolist(), self.size, self.suffix
        leaves, between = [], []
        stack, lowest = [(0, 0, False)], 0
        while stack:
            node, above, turn = stack.pop()
            if turn:
                lowest = above
            b, e = first[node], first[node + 1]
            if b == e:
                leaves.append(suffix[node])
                between.append(lowest)
                continue
            depth = above + size[node]
            stack.extend(zip(stacked[b : e - 1], repeat(depth), repeat(True)))
            stack.append((stacked[e - 1], depth, False))
        return np.array(leaves), np.array(between, np.int32)


class Extension:
    """Longest common extensions of the suffixes of a sequence, each in constant time."""

    def __init__(self, symbols: list[int]):
        self.tree = SuffixTree(symbols)
        leaves, between = self.tree.tour()
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.table = [between]
        while 2 << (len(self.table) - 1) <= len(between):
            last, half = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def inverse_rank(self) -> np.ndarray:
        leaves, _ = self.tree.tour(inverse=True)
        rank = np.empty(len(leaves), np.int64)
        rank[leaves] = np.arange(len(leaves))
        return rank

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """For different suffixes ``one[i]`` and ``two[i]``."""
        low, high = self.rank[one], self.rank[two]
        low, high = np.minimum(low, high) + 1, np.maximum(low, high)
        level = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            mine = level == k
            table = self.table[k]
            out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << int(k)) + 1])
        return out


def longest_lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at every position: it ends before the next suffix of a smaller rank."""
    values = rank.tolist()
    n = len(values) - 1
    length, waiting = [0] * n, []
    for i in range(n, -1, -1):
        while waiting and values[waiting[-1]] > values[i]:
            waiting.pop()
        if i < n:
            length[i] = waiting[-1] - i
        waiting.append(i)
    return np.array(length, np.int64)


def find_runs(words: list, least: int = MIN_LENGTH) -> np.ndarray:
    """``start, length, period`` of all runs of at least ``least`` words, sorted by start and period."""
    names: dict = {}
    symbols = [names.setdefault(w, len(names) + 1) for w in words]
    n = len(symbols)
    ahead, back = Extension(symbols), Extension(symbols[::-1])
    found = []
    for rank in (ahead.rank, ahead.inverse_rank()):
        period = longest_lyndon(rank)
        at = np.flatnonzero(np.arange(n) + period < n)
        period = period[at]
        right = ahead(at, at + period)
        left = np.zeros(len(at), np.int64)
        inner = at > 0
        left[inner] = back(n - at[inner], n - at[inner] - period[inner])
        length = left + period + right
        good = length >= np.maximum(least, 2 * period)
        found.append(np.stack([at - left, length, period], 1)[good])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(hashes: np.ndarray, doc: np.ndarray, begins: np.ndarray, rolling: RollingHash, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the stretches that can hold runs, in the concatenated words of some texts.

    ``doc`` has the number of the text of every word, ``begins`` where each text begins.
    """
    gram = rolling.window
    if len(hashes) < gram:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    key = mix(rolling(hashes) ^ (doc[: len(doc) - gram + 1].astype(U) * U(_SPREAD)))
    whole = np.flatnonzero(doc[gram - 1 :] == doc[: len(doc) - gram + 1])
    key = key[whole]
    order = np.argsort(key)
    same = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    starts = whole[np.unique(np.concatenate([order[same], order[same + 1]]))]
    if not len(starts):
        return starts, starts
    first, end = intervals(starts, gram, doc[starts])
    long = end - first >= least
    return first[long], end[long]


def _collapsed(least: int, names: list[str], arrow: pa.Schema):
    gram = (least + 1) // 2

    def run(batches):
        memo, rolling = WordHashes(), RollingHash(_BASE, gram)
        for batch in small(batches, 256):
            texts = [text.split() for text in utf8(batch.column("text"))]
            sizes = np.array([len(words) for words in texts])
            begins = np.concatenate([[0], np.cumsum(sizes)])
            doc = np.repeat(np.arange(len(texts)), sizes)
            hashes = np.concatenate([memo.of(words) for words in texts]) if len(doc) else np.empty(0, U)
            found: dict[int, list] = {}
            for b, e in zip(*(x.tolist() for x in stretches(hashes, doc, begins, rolling, least))):
                number = int(doc[b])
                at = b - int(begins[number])
                runs = find_runs(texts[number][at : at + e - b], least)
                if len(runs):
                    found.setdefault(number, []).append(runs + [at, 0, 0])
            kept, listed = [], []
            for number, words in enumerate(texts):
                runs = np.concatenate(found[number]) if number in found else None
                listed.append([] if runs is None else [dict(zip(("start", "length", "period"), r)) for r in runs.tolist()])
                if runs is not None:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                    np.subtract.at(edge, runs[:, 0] + runs[:, 1], 1)
                    words = [w for w, c in zip(words, np.cumsum(edge).tolist()) if not c]
                kept.append(b" ".join(words))
            columns = {name: batch.column(name) for name in names}
            columns["text"] = pa.array(kept, pa.binary()).cast(pa.string())
            columns["n_words"] = pa.array(sizes, pa.int64())
            columns["runs"] = pa.array(listed, arrow.field("runs").type)
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in arrow], names=arrow.names)

    return run


def collapse_runs(docs: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with the first period of every run only, and with ``n_words, runs``.

    Words are runs of anything but ASCII white space, numbered from 0. ``runs`` holds ``start,
    length, period`` of every maximal stretch of at least ``least`` words and twice its
    smallest period, by start and period. A word is dropped if it lies in a run beyond its
    first period; the others are joined by one space. A null or blank text has no words, no
    runs and becomes empty. ``doc_id`` is not used: rows are independent, repeated ones
    alike. ``text, n_words, runs`` of the input are replaced, all other columns stay. An empty
    table gives an empty result.
    """
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = docs.select(F.col("text").cast("string").alias("text"), *others(docs, "text", "n_words", "runs"))
    run = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
    schema = T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run))])
    return rows.mapInArrow(_collapsed(least, rows.columns, to_arrow_schema(schema)), schema)
