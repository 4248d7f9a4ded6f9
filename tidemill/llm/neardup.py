"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

The sketch (Dahlgaard, Knudsen, Thorup, "Fast Similarity Sketching", FOCS 2017) has BINS
coordinates. In round i every shingle goes to one hashed bin with the value i + hash; a bin
keeps its smallest value, so it is filled by the first round that reaches it. A set of many
shingles fills all bins in one or two rounds. Rounds BINS and later send all shingles to one
given bin, so that 2 * BINS rounds fill every coordinate of any set. Two coordinates agree with
the probability of the Jaccard similarity, with concentration like that of full MinHash.

BANDS bands of ROWS coordinates bring documents together. A pair of similarity 0.75 shares no
band with probability (1 - 0.75 ** 4) ** 36, about one in a million, and a closer pair with
less. All links are confirmed on the full shingle sets:

1. Equal sets collapse to one class, named by its smallest document id.
2. In every bucket each class is compared with the smallest class of the bucket. The links
   found so far give preliminary groups. This costs one comparison per bucket row, however
   large a bucket is.
3. Where a bucket still holds several groups, its pairs from different groups are compared.
   Pairs inside a group cannot change the result. A bitmap decides most pairs inside the join:
   every shingle flips one of MAP_BITS bits, so two maps differ in at most as many bits as the
   sets differ in shingles, and a pair whose maps differ in too many cannot reach the
   similarity (Sandes et al., "Bitmap filter", Information Systems 2020). The bound is exact;
   what passes is verified on the full sets. So no link between groups is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import ascii_lower, small, stored, utf8
from tidemill.operators.components import weak_components

SHINGLE = 5
PERCENT = 75
ROWS, BANDS = 4, 36
BINS = ROWS * BANDS
MAP_BITS = 2048
# A class with this many links is a hub; its links are salted while groups are formed.
HUB_ROWS = 1000
# Entries of a task's memo of word hashes; it is emptied when full.
MEMO = 400_000

_U = np.uint64
_SEEDS = (np.arange(1, 2 * BINS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) ^ _U(0xD1B54A32D192ED03)
_FACTORS = [_U(int(xxhash.xxh3_64_intdigest(b"shingle%d" % i)) | 1) for i in range(SHINGLE)]
_VALUE = _U((1 << 40) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: bytes, memo: dict) -> np.ndarray:
    """Sorted hashes of the distinct shingles; ``text`` comes with A-Z lower-cased."""
    words = text.split()
    n = len(words)
    if not n:
        return np.empty(0, _U)
    w = np.fromiter(map(memo.__getitem__, words), _U, n)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, _U(size))
    for i in range(size):
        total += w[i : n - size + 1 + i] * _FACTORS[i]
    return np.unique(_mix(total))


def sketch(x: np.ndarray) -> np.ndarray:
    """BINS coordinates of a non-empty set."""
    empty = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(BINS, empty)
    done = 0
    while done < BINS:
        rounds = int(min(BINS - done, max(1, -(-4 * BINS // len(x)))))
        v = _mix(x[None, :] ^ _SEEDS[done : done + rounds, None])
        number = np.arange(done, done + rounds, dtype=_U)[:, None] << _U(40)
        bins = ((v >> _U(40)) * _U(BINS)) >> _U(24)
        np.minimum.at(out, bins.ravel().astype(np.int64), ((v & _VALUE) | number).ravel())
        done += rounds
        if not (out == empty).any():
            return out
    for j in np.flatnonzero(out == empty):
        v = _mix(x ^ _SEEDS[BINS + j])
        out[j] = (_U(BINS + j) << _U(40)) | (v & _VALUE).min()
    return out


def band_keys(x: np.ndarray) -> np.ndarray:
    """One hash per band; the band's number is part of it."""
    rows = sketch(x).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        key = _mix(key ^ rows[:, i])
    return key.view(np.int64)


def parity_map(x: np.ndarray) -> np.ndarray:
    """MAP_BITS bits as 64-bit words; a bit is set where an odd number of shingles falls on it."""
    odd = np.bincount((x % _U(MAP_BITS)).astype(np.int64), minlength=MAP_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])


def _sketches(keys_of):
    def run(batches):
        memo = _Memo()
        for batch in small(batches):
            ns, digests, bands = [], [], []
            for text in utf8(batch.column(1)):
                x = shingle_set(text, memo)
                ns.append(len(x))
                digests.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
                bands.append(keys_of(x) if len(x) else None)
            made = [batch.column(0), *(pa.array(v, f.type) for v, f in zip((ns, digests, bands), list(_SKETCH)[1:]))]
            yield pa.RecordBatch.from_arrays(made, schema=_SKETCH)

    return run


def _sets(batches):
    memo = _Memo()
    for batch in small(batches):
        found = [shingle_set(text, memo) for text in utf8(batch.column(1))]
        columns = ([len(x) for x in found], [x.view(np.int64) for x in found], [parity_map(x) for x in found])
        made = [batch.column(0), *(pa.array(v, f.type) for v, f in zip(columns, list(_SETS)[1:]))]
        yield pa.RecordBatch.from_arrays(made, schema=_SETS)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose full sets reach the similarity."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    both = pairs.join(two, "b").join(one, "a")
    close = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    shared = F.when(close, F.size(F.array_intersect("s_a", "s_b"))).otherwise(0)
    return both.select("a", "b", "n_a", "n_b", shared.alias("i")).filter(
        F.col("i") * 100 >= PERCENT * (F.col("n_a") + F.col("n_b") - F.col("i"))
    ).select("a", "b")


def _groups(links: DataFrame) -> DataFrame:
    """``id, component`` of the linked classes."""
    edges = links.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return weak_components(nodes, edges, hot_rows=HUB_ROWS)


def near_duplicates(docs: DataFrame, keys_of=band_keys) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set has its
    distinct shingles of five words, or the whole sequence where there are fewer. A null, empty
    or blank text has an empty set and is linked with nothing. Documents of similarity 0.75 or
    more are linked; ``component_id`` is the smallest ``doc_id`` that links lead to, the
    document's own included, and that document is kept. Rows of one ``doc_id`` count as one
    document. A row with a null ``doc_id`` is linked with nothing, has a null component and is
    kept. Columns other than ``doc_id`` and ``text`` are not read. ``keys_of`` gives the bucket
    keys of a set; documents without a common key are never compared.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), ascii_lower(F.col("text").cast("string")).alias("text"))
    # Spark schemas follow the Arrow ones above.
    marks = stored(rows.mapInArrow(_sketches(keys_of), "doc_id bigint, n int, digest binary, bands array<bigint>"), "sketches")
    linkable = marks.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    classes = linkable.groupBy("digest").agg(F.min("doc_id").alias("id"))
    heads = linkable.withColumnRenamed("doc_id", "id").join(classes, ["digest", "id"])
    banded = heads.select("id", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("last"))
    # Stored, here and below, so that both sides of the join come straight from a shuffle and a bucket
    # of very many classes can be split.
    shared = stored(shared.filter(F.col("a") < F.col("last")).select("band", "a"), "shared-bands")
    members = stored(banded.join(shared, "band"), "band-members")

    # Merged, so that it is the same join at every size.
    wanted = members.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    chosen = rows.join(wanted, "doc_id", "left_semi")
    sets = stored(chosen.mapInArrow(_sets, "id bigint, n int, shingles array<bigint>, bits array<bigint>"), "shingle-sets")

    stars = members.filter(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    links = stored(_confirmed(stars, sets), "star-links")
    named = members.select("band", "id", "n").join(_groups(links), "id", "left").withColumn("group", F.coalesce("component", "id"))
    named = stored(named.select("band", "id", "n", "group"), "band-groups")
    rest = stored(_between_groups(named, sets.select("id", "bits")).join(stars, ["a", "b"], "left_anti"), "cross-pairs")
    if not rest.isEmpty():
        links = stored(links.union(_confirmed(rest, sets)), "all-links")
    labels = classes.join(_groups(links), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    # Stored, so that both sides of the last join come straight from a shuffle and a hot digest can be split.
    labels = stored(labels, "labels")
    return marks.join(labels, "digest", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _between_groups(named: DataFrame, maps: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of one bucket and different groups that may be similar enough.

    Each bucket's largest group stays on one side only, so a bucket of one large group and a
    few others is compared in proportion to its size.
    """
    counted = named.groupBy("band", "group").agg(F.count(F.lit(1)).alias("size"))
    per_band = counted.groupBy("band").agg(
        F.max_by("group", F.struct("size", "group")).alias("main"), F.count(F.lit(1)).alias("groups")
    )
    mixed_bands = stored(per_band.filter(F.col("groups") > 1).select("band", "main"), "mixed-bands")
    mixed = named.join(mixed_bands, "band").join(maps, "id")
    mixed = stored(mixed, "mixed-buckets")
    other = mixed.filter(F.col("group") != F.col("main")).select(
        "band", F.col("id").alias("x"), F.col("n").alias("n_x"), F.col("group").alias("group_x"), F.col("bits").alias("bits_x")
    )
    words = [F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("bits_x")[k])) for k in range(MAP_BITS // 64)]
    apart = sum(words[1:], words[0])
    meets = other.join(mixed, "band").filter(
        (F.col("group_x") != F.col("group"))
        & ((F.col("group") == F.col("main")) | (F.col("x") < F.col("id")))
        & (F.least("n", "n_x") * 100 >= F.greatest("n", "n_x") * PERCENT)
        & ((F.col("n") + F.col("n_x")) * (100 - PERCENT) >= apart * (100 + PERCENT))
    )
    return meets.select(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).distinct()
