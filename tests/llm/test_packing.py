import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import packing


def brute(rows, capacity):
    """Best fit, longest first, by a plain scan over all bins."""
    bins, out = [], []
    left = []
    for doc_id, length, source, cluster, uid in rows:
        if not length or length < 0:
            continue
        for piece in range(length // capacity):
            bins.append([0, set()])
            out.append((doc_id, piece, piece * capacity, capacity, len(bins) - 1, 0))
        if length % capacity:
            left.append((-(length % capacity), uid, doc_id, length // capacity, source, cluster))
    for rest, _, doc_id, piece, source, cluster in sorted(left, key=lambda r: r[:2]):
        marks = {m for m in (("s", source), ("c", cluster)) if m[1] is not None}
        fitting = [(b[0], i) for i, b in enumerate(bins) if b[0] >= -rest and not b[1] & marks]
        if fitting:
            number = min(fitting)[1]
        else:
            bins.append([capacity, set()])
            number = len(bins) - 1
        out.append((doc_id, piece, piece * capacity, -rest, number, capacity - bins[number][0]))
        bins[number][0] += rest
        bins[number][1] |= marks
    return out


@pytest.mark.parametrize("seed", range(8))
def test_group_against_plain_best_fit(seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 1, 5, 30, 99, 100, 101, 250, rng.randrange(1, 100)]), rng.choice(["hot", "hot", "a", "b", None]),
             rng.choice([1, 2, 3, None, None, None]), i) for i in range(200)]
    got = [p for p in packing.pack_group(rows, 100) if p[3]]
    assert got == brute(rows, 100)


def test_bins_of_a_table(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(0, 260), rng.choice(["hot", f"s{i % 9}"]), rng.randrange(40)) for i in range(500)]
    rows += [(None, 50, None, None), (7, 20, "x", None), (7, 20, "x", None), (900, None, "x", 1), (901, -3, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, length bigint, source string, cluster bigint").withColumn("part", F.lit("own"))
    packed = packing.pack(df.repartition(6), 100, 64).collect()
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    expected = {}
    for doc_id, length, *_ in rows:
        expected[doc_id] = expected.get(doc_id, 0) + max(0, length or 0)
    assert total == expected
    about = {doc_id: (source, cluster) for doc_id, _, source, cluster in rows}
    bins = {}
    for r in packed:
        assert (r.bin_id is None) == (r.length == 0)
        if r.bin_id is not None:
            bins.setdefault(r.bin_id, []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r.bin_offset)
        assert [r.bin_offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 100
        rests = [about[r.doc_id] for r in own if r.length < 100]
        for k in (0, 1):
            named = [x[k] for x in rests if x[k] is not None]
            assert len(named) == len(set(named))


def test_documents(table):
    rows = [(1, "abc"), (2, "ABC "), (3, None), (4, ""), (5, "é" * 10_000), (6, "other")]
    packed = packing.pack_documents(table(*rows)).collect()
    sizes = {}
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {1: 4, 2: 5, 3: 1, 4: 1, 5: 20_001, 6: 6}
    assert packing.pack_documents(table((1, "a")).limit(0)).collect() == []
