import random

import numpy as np
import pytest

from tidemill.llm import substrings
from tidemill.llm.words import RollingHash, U

BLANK = " \t\n\x0b\x0c\r"


def split(text):
    for c in BLANK:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, window):
    first = {}
    for doc_id, text in rows:
        words = split(text or "")
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if doc_id is not None:
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text in rows:
        words, gone = split(text or ""), set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        spans = [(i, min(j for j in range(i, len(words) + 1) if j not in gone)) for i in sorted(gone) if i - 1 not in gone]
        out.append((doc_id, len(words), len(gone), spans, " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def run(df, **how):
    got = substrings.drop_repeated_windows(df, **how).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.removed], r.text) for r in got), key=repr)


def rows_of(prose, seed=1):
    rng = random.Random(seed)
    passages = [prose(1000 + k, rng.randrange(3, 20)) for k in range(6)]
    rows = []
    for i in range(60):
        words = []
        for k in range(rng.randrange(6)):
            words += rng.choice(passages) + prose(i * 7 + k, rng.randrange(4))
        rows.append((rng.randrange(1000), rng.choice([" ", "\n", " \t ", "\r\n"]).join(words)))
    return rows


@pytest.mark.parametrize("slice_words", [10, 300, 1 << 20])
@pytest.mark.parametrize("window", [1, 5, 8])
def test_against_brute_force(table, prose, window, slice_words):
    rows = rows_of(prose) + [(None, "a b c d e f g h i"), (2000, "a b c d e f g h i"), (None, None), (2001, None), (2002, ""), (2003, " \n "),
                             (2004, "x " * 300), (2005, "x " * 8), (2006, "a b c d É é " * 3), (2007, "a b c d É é " * 3)]
    assert run(table(*rows).repartition(5), window=window, slice_words=slice_words) == brute(rows, window)


def test_rows_of_one_id_lose_nothing_to_each_other(table):
    rows = [(3, "a b c d"), (3, "a b c d"), (3, "z a b c"), (4, "a b c d"), (4, "x a b c")]
    assert run(table(*rows).repartition(3), window=3) == brute(rows, 3)
    assert sorted(r[2] for r in brute(rows, 3)) == [0, 0, 0, 3, 4]


def test_the_window_of_fifty(table, prose):
    passage = prose(5, 60)
    rows = [(1, " ".join(prose(1, 30) + passage)), (2, " ".join(passage[:50] + prose(2, 5))), (3, " ".join(passage[:49] + prose(3, 5))), (4, " ".join(passage))]
    assert run(table(*rows)) == brute(rows, 50)
    assert [r[2] for r in run(table(*rows))] == [0, 50, 0, 60]


def test_a_passage_in_very_many_documents(spark, table):
    """Settled in slices or met in buckets, only the first document keeps it."""
    rows = [(i, f"own{i} " + " ".join(f"w{k}" for k in range(12))) for i in range(400)]
    for slice_words in (20, 1 << 20):
        got = run(table(*rows).repartition(6), window=10, slice_words=slice_words)
        assert [r[2] for r in got] == [0 if r[0] == 0 else 12 for r in got]


def test_other_columns_stay_and_clashing_ones_are_replaced(table):
    df = table((1, "a b c"), (2, "a b c")).selectExpr("*", "'mine' AS removed", "7 AS n_words")
    got = substrings.drop_repeated_windows(df, window=2).collect()
    assert {r.doc_id: (r.source, r.kept, r.n_words, r.n_removed) for r in got} == {1: ("s0", 7, 3, 0), 2: ("s0", 7, 3, 3)}


def test_empty_table(table):
    assert run(table((1, "a")).limit(0)) == []


def test_rolling_hash_names_equal_windows(monkeypatch):
    monkeypatch.setattr("tidemill.llm.words.PIECE", 16)
    x = np.array([3, 1, 2, 3, 1, 2, 9] * 20, U)
    got = RollingHash(0x9E3779B97F4A7C15, 4)(x)
    names = {}
    for i, h in enumerate(got.tolist()):
        assert names.setdefault(h, tuple(x[i : i + 4])) == tuple(x[i : i + 4])
    assert len(names) == len({tuple(x[i : i + 4]) for i in range(len(x) - 3)}) and len(got) == len(x) - 3


@pytest.mark.parametrize("ids", [[5], [-(1 << 62), 3, 1 << 62], [7, 7, 8, 300], [0, 70_000], [1, 1 << 40]])
def test_gaps_round_trip(ids):
    base, gaps = substrings.packed_gaps(np.array(ids, np.int64))
    assert substrings.unpacked_gaps(base, gaps, len(ids)).tolist() == ids
