import hashlib
from collections import defaultdict

import pytest

from tidemill.llm import exactdup


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(rows):
        groups[text or ""].append((doc_id is not None, doc_id or 0, i))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        own = groups[text or ""]
        best = max(own)
        out.append((doc_id, best[1] if best[0] else None, len(own), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("salts", [1, 5])
def test_groups_against_brute_force(table, prose, salts):
    rows = [(i, " ".join(prose(i % 7, 5 + i % 3))) for i in range(60)]
    rows += [(100 + i, "the hot text") for i in range(50)] + [(200, None), (201, ""), (202, " "), (203, "x" * 300_000), (204, "x" * 300_000)]
    found = exactdup.exact_duplicates(table(*rows).repartition(7), salts).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in found)


def test_full_local_tables_are_emptied(table):
    rows = [(i, f"text {i % 3}") for i in range(20)]
    found = exactdup.exact_duplicates(table(*rows).coalesce(1), local_bytes=1).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=repr) == brute(rows)


def test_repeated_rows_and_null_ids_keep_exactly_one(table):
    found = exactdup.exact_duplicates(table((5, "a"), (5, "a"), (None, "a"), (None, "b"), (None, "b"))).collect()
    assert sorted(((r.text_sha256, r.keep_id, r.group_size) for r in found), key=repr) == sorted(
        [(hashlib.sha256(b"a").hexdigest(), 5, 3)] * 3 + [(hashlib.sha256(b"b").hexdigest(), None, 2)] * 2, key=repr)
    assert sum(r.kept for r in found) == 2


def test_empty_table(table):
    assert exactdup.exact_duplicates(table((1, "a")).limit(0)).collect() == []


def test_digest_only_brings_rows_together():
    """Two contents under one digest stay apart, in both merging steps."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({
        "uid": [9, 8, 7], "top": [3, 2, 1], "digest": [b"d"] * 3, "body": [b"x", b"x", b"y"]})
    (made,) = exactdup._merged([batch])
    assert made.column("winner").to_pylist() == [9, 9, 7]
