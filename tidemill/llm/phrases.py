"""Phrase collocations from counts kept in weighted acyclic automata.

1. A task takes slices of some million words. The n-grams of a slice, up to three words, are
   sorted and counted, cut at the borders of the prefix ranges, and every range of the slice
   becomes an automaton of counts, which travels as one row.
2. In a range the automata of all slices are united, a few at a time, and weights summed. What
   stays has at least the wanted count; no part of a phrase is rarer than the phrase.
3. Candidates are the longer paths. Their parts go to the range in which they lie, where the
   range's automaton is composed with them and returns their counts.

The ranges hold about equally many n-grams of a sample of texts, which decides about the spread
of the work only. A border may lie between any two phrases, so a frequent first word, or a
frequent first pair, is cut into several ranges; equal n-grams of a slice are one path.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.automata import ORDER, CountAutomaton, summed, union
from tidemill.llm.shared import small, stored, utf8
from tidemill.runtime import shuffle_partitions

LEAST = 10
PER_LANG = 2_000
# A phrase goes if a longer candidate has this part of its count, in per cent.
INSIDE = 50
SLICE_WORDS = 1 << 21
# Transitions a task collects before it unites what it has.
HELD_TRANSITIONS = 1 << 21
# Texts and phrases of each from which the borders of the ranges are taken.
SAMPLE_TEXTS, SAMPLE_PLACES = 1_000, 200
RANGES_PER_PARTITION = 2
RANK_SALTS = 64

# Lower case leaves no A, so it can stand for the end of a piece.
_BREAK = b"A"
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_PACKED = [("words", pa.binary()), ("states", pa.int64()), ("transitions", pa.int64()),
           ("degrees", pa.binary()), ("symbol", pa.binary()), ("weight", pa.binary()), ("target", pa.binary())]
_PACKED_SPARK = "words binary, states bigint, transitions bigint, degrees binary, symbol binary, weight binary, target binary"
_AUTOMATA = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("n", pa.int64()), *_PACKED])
_AUTOMATA_SPARK = f"range int, lang string, n bigint, {_PACKED_SPARK}"
_CUTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("a", pa.int64()),
                   ("k", pa.int32()), ("head", pa.string()), ("rest", pa.string())])
_CUTS_SPARK = "lang string, phrase string, size int, a bigint, k int, head string, rest string"
_COUNTS = pa.schema([("lang", pa.string()), ("part", pa.string()), ("f", pa.int64())])

Phrase = tuple[bytes, ...]


def tokens(text: bytes) -> list[bytes]:
    """Words of a text; a single capital A stands where a piece ends."""
    return text.lower().translate(_BREAKS).replace(_BREAK, b" A ").split()


class _Names(dict):
    """Numbers of words in order of appearance; 0 is the end of a piece."""

    def __init__(self):
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


def ngrams(names: _Names, numbers: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in byte order, sorted distinct n-grams over them, and their counts."""
    listed = list(names)[1:]
    order = sorted(range(len(listed)), key=listed.__getitem__)
    rank = np.zeros(len(listed) + 1, np.int64)
    rank[np.array(order, np.int64) + 1] = np.arange(1, len(listed) + 1)
    x = rank.astype(np.int32)[numbers]
    alive, rows = x > 0, []
    for size in range(1, ORDER + 1):
        alive = alive[: len(x) - size + 1] & (x[size - 1 :] > 0) if len(x) >= size else alive[:0]
        at = np.flatnonzero(alive)
        row = np.zeros((ORDER, len(at)), np.int32)
        for k in range(size):
            row[k] = x[at + k]
        rows.append(row)
    return [listed[i] for i in order], *summed(np.concatenate(rows, axis=1), None, len(listed))


def _border(words: list[bytes], phrases: np.ndarray, border: Phrase) -> int:
    """Number of phrases before the border."""
    low, high = 0, phrases.shape[1]
    for level, word in enumerate(border):
        at = bisect_left(words, word)
        met = at < len(words) and words[at] == word
        column = phrases[level, low:high]
        below = low + int(np.searchsorted(column, at + 1, "left"))
        if not met:
            return below
        low, high = below, low + int(np.searchsorted(column, at + 1, "right"))
    return low


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _AUTOMATA)], schema=_AUTOMATA)


def _counted(borders, slice_words: int):
    """The automata of every slice, by range."""

    def flushed(langs):
        for lang, (names, parts) in langs.items():
            words, phrases, counts = ngrams(names, np.concatenate(parts))
            ends = [0, *(_border(words, phrases, b) for b in borders.value), len(counts)]
            rows = []
            for number, (b, e) in enumerate(zip(ends, ends[1:])):
                if b < e:
                    single = phrases[1, b:e] == 0
                    automaton = CountAutomaton.build(words, phrases[:, b:e], counts[b:e])
                    rows.append((number, lang, int(counts[b:e][single].sum()), *automaton.packed()))
            for b in range(0, len(rows), 64):
                yield _rows(rows[b : b + 64])
        langs.clear()

    def run(batches):
        langs, held = {}, 0
        for batch in small(batches):
            for text, lang in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
                own = tokens(text)
                if not own:
                    continue
                if held and held + len(own) > slice_words:
                    yield from flushed(langs)
                    held = 0
                if lang not in langs:
                    langs[lang] = (_Names(), [])
                names, parts = langs[lang]
                parts.append(np.fromiter(map(names.__getitem__, own), np.int32, len(own)))
                parts.append(np.zeros(1, np.int32))
                held += len(own)
        yield from flushed(langs)

    return run


def _automata(batch: pa.RecordBatch):
    for row in zip(*(batch.column(name).to_pylist() for name, _ in _PACKED)):
        yield CountAutomaton.unpacked(*row)


def _united(least: int):
    """One automaton per range and language, whose rows come as neighbors."""

    def run(batches):
        at, n, held = None, 0, []
        for batch in small(batches, 16):
            keys = zip(*(batch.column(c).to_pylist() for c in ("range", "lang", "n")))
            for (number, lang, words), automaton in zip(keys, _automata(batch)):
                if (number, lang) != at:
                    if held:
                        yield _rows([(*at, n, *union(held, least).packed())])
                    at, n, held = (number, lang), 0, []
                n += words
                held.append(automaton)
                if len(held) > 1 and sum(len(a.symbol) for a in held[1:]) > max(HELD_TRANSITIONS, len(held[0].symbol)):
                    held = [union(held)]
        if held:
            yield _rows([(*at, n, *union(held, least).packed())])

    return run


def _borders(rows: DataFrame, ranges: int) -> list[Phrase]:
    """At most ``ranges - 1`` phrases that cut those of a sample of texts into equal parts."""

    def picked(batches):
        rng = random.Random(0)
        for batch in batches:
            found = set()
            for text in utf8(batch.column(0)):
                own = tokens(text)
                for at in rng.sample(range(len(own)), min(SAMPLE_PLACES, len(own))):
                    piece = own[at : at + ORDER]
                    piece = piece[: piece.index(_BREAK)] if _BREAK in piece else piece
                    found.update(b" ".join(piece[:k]) for k in range(1, len(piece) + 1))
            yield pa.RecordBatch.from_pydict({"phrase": pa.array(sorted(found), pa.binary())})

    texts = rows.select("text").orderBy(F.rand(1)).limit(SAMPLE_TEXTS)
    found = sorted({tuple(r.phrase.split(b" ")) for r in texts.mapInArrow(picked, "phrase binary").collect()})
    return sorted({found[len(found) * k // ranges] for k in range(1, ranges)}) if found else []


def _cuts(batches):
    """The candidates of an automaton, one row per way to cut them."""
    for batch in batches:
        for lang, automaton in zip(batch.column("lang").to_pylist(), _automata(batch)):
            phrases, counts = automaton.phrases()
            longer = phrases[1] > 0
            names = ["", *(w.decode() for w in automaton.words)]
            out = []
            for symbols, a in zip(phrases[:, longer].T.tolist(), counts[longer].tolist()):
                own = [names[s] for s in symbols if s]
                out += [(lang, " ".join(own), len(own), a, k, " ".join(own[:k]), " ".join(own[k:])) for k in range(1, len(own))]
            for b in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[b : b + 10_000]), _CUTS)], schema=_CUTS)


def _looked_up(key, parts: pa.Table, automata: pa.Table) -> pa.Table:
    """Counts of the parts that lie in one range."""
    asked = parts.column("part").to_pylist()
    found = np.zeros(len(asked), np.int64)
    for batch in automata.to_batches():
        for automaton in _automata(batch):
            found += automaton.counts_of([p.encode().split(b" ") for p in asked])
    return pa.Table.from_arrays([parts.column("lang"), parts.column("part"), pa.array(found)], schema=_COUNTS)


def count_automata(docs: DataFrame, borders, least: int = LEAST, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``range, lang, n`` and an automaton: counts of the n-grams of a range, and its number of words."""
    rows = docs.select(F.col("text").cast("string"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    shards = rows.filter(F.col("text").isNotNull()).mapInArrow(_counted(borders, slice_words), _AUTOMATA_SPARK)
    met = shards.repartition(shuffle_partitions(docs), "range").sortWithinPartitions("range", "lang")
    return met.mapInArrow(_united(least), _AUTOMATA_SPARK)


def part_counts(parts: DataFrame, automata: DataFrame, borders) -> DataFrame:
    """``lang, part, f`` of distinct parts."""

    def placed(batches):
        for batch in batches:
            where = [bisect_right(borders.value, tuple(p.encode().split(b" "))) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), batch.column(0), batch.column(1)], names=["range", "lang", "part"])

    asked = parts.mapInArrow(placed, "range int, lang string, part string")
    keys = ("range", "lang")
    return asked.groupBy(*keys).cogroup(automata.groupBy(*keys)).applyInArrow(_looked_up, "lang string, part string, f bigint")


def collocations(docs: DataFrame, least: int = LEAST, per_lang: int = PER_LANG, slice_words: int = SLICE_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the strongest phrases of two and three words.

    A-Z are lower-cased; ``. , ; : ! ?`` and ASCII line ends cut a text into pieces, spaces and tabs cut
    these into words. Everything is counted per language; a null language is ``und``. ``a`` is
    a phrase's number of occurrences within pieces, at least ``least``; ``l`` and ``r`` are
    those of its two parts, ``n`` the number of all words. The score of a cut is the floor of
    a million times a * a / (l * r); a phrase has the cut with the lowest score, of equal ones the
    first. A phrase inside a longer one that has at least half its count is left out. The
    ``per_lang`` best stay, by score, then count, then phrase. Every row of ``docs`` counts,
    repeated ones as often as they come; null or empty texts have no words. Columns other than
    ``text`` and ``lang`` are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    borders = spark.sparkContext.broadcast(_borders(docs.select(F.col("text").cast("string").alias("text")), RANGES_PER_PARTITION * shuffle_partitions(docs)))
    automata = stored(count_automata(docs, borders, least, slice_words), "count-automata")
    cuts = stored(automata.select("lang", *[n for n, _ in _PACKED]).mapInArrow(_cuts, _CUTS_SPARK), "phrase-cuts")
    parts = cuts.select("lang", F.explode(F.array("head", "rest")).alias("part")).distinct()
    # Stored, so that both sides of the joins come straight from a shuffle and a frequent word can be split.
    counts = stored(part_counts(parts, automata, borders), "part-counts")
    heads = counts.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = counts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    whole = "cast(a as decimal(19, 0)) * cast(a as decimal(19, 0)) * 1000000bd"
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn(
        "score", F.expr(f"({whole}) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    )
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("size").alias("size")
    )
    inner = F.expr(
        "explode(filter(transform(flatten(transform(sequence(2, greatest(2, size - 1)), m -> transform(sequence(1, size - m + 1), b -> named_struct('m', m, 'b', b)))),"
        " p -> array_join(slice(split(phrase, ' '), p.b, p.m), ' ')), part -> part <> phrase))"
    )
    longer = cuts.filter("k = 1 AND size > 2").select("lang", inner.alias("phrase"), F.col("a").alias("longest"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    left = best.join(longer, ["lang", "phrase"], "left").filter(F.expr(f"longest IS NULL OR 100 * longest < {INSIDE} * a"))
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS))
    salted = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).filter(F.col("rank") <= per_lang)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).filter(F.col("rank") <= per_lang)
    totals = automata.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
