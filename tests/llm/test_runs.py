import random

import pytest

from tidemill.llm import runs
from tidemill.llm.catalog import _with_planted_runs


def brute(words, least):
    n, found = len(words), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j + p - i
            if length >= max(least, 2 * p) and all(any(words[k] != words[k + q] for k in range(i, i + length - q)) for q in range(1, p)):
                found.add((i, length, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("least", [2, 5, 12])
@pytest.mark.parametrize("letters", [1, 2, 3, 30])
def test_runs_against_brute_force(letters, least):
    rng = random.Random(letters * 100 + least)
    for _ in range(60):
        words = [rng.randrange(letters) for _ in range(rng.randrange(1, 50))]
        assert [tuple(r) for r in runs.find_runs(words, least).tolist()] == brute(words, least), words


def test_nested_and_fibonacci_runs():
    a, b = "a", "ab"
    for _ in range(9):
        a, b = b, b + a
    for words in (b, "ab" * 9 + "c" + "ab" * 9 + "c", "aab" * 5 + "ab" * 7 + "b" * 13):
        assert [tuple(r) for r in runs.find_runs(list(words), 4).tolist()] == brute(words, 4)


@pytest.mark.parametrize("least", [2, 7, 12])
def test_texts_against_brute_force(table, prose, least):
    rng = random.Random(least)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x"), (5, "x " * 5000), (None, "a b " * 10), (None, "a b " * 10), (6, "É é " * 7 + "É\x0bx")]
    for i in range(80):
        words = []
        for k in range(rng.randrange(5)):
            part = prose(i * 9 + k, rng.randrange(1, 12))
            words += part * rng.randrange(1, 4) + part[: rng.randrange(3)]
        rows.append((10 + i, rng.choice([" ", "\n", "\t "]).join(words)))
    got = runs.collapse_runs(table(*rows).repartition(4), least).collect()
    want = []
    for doc_id, text in rows:
        words = (text or "").split()
        found = [(0, 5000, 1)] if doc_id == 5 else brute(words, least)
        want.append((doc_id, len(words), found, collapsed(words, found)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.text) for r in got), key=repr) == sorted(want, key=repr)


def test_a_long_text_of_one_period(table, prose):
    words = prose(1, 3000) * 6
    got = runs.collapse_runs(table((1, " ".join(words)))).collect()[0]
    assert [tuple(r) for r in got.runs] == [(0, 18000, 3000)] and got.text == " ".join(words[:3000]) and got.source == "s0"


def test_clashing_columns_are_replaced_and_an_empty_table_is_empty(table):
    df = table((1, "a b c")).selectExpr("*", "'own' AS runs", "7 AS N_words")
    row = runs.collapse_runs(df).collect()[0]
    assert row.runs == [] and row.n_words == 3 and row.kept == 7
    assert runs.collapse_runs(df.limit(0)).collect() == []


def test_planted_texts(table, prose):
    import zlib

    rows = [(i, "  ".join(prose(i, i % 60)) + "\n") for i in range(300)] + [(None, "a b"), (301, None)]
    for row in _with_planted_runs(table(*rows)).collect():
        words = (dict(rows)[row.doc_id] or "").split()
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if row.doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert row.text == " ".join(words[a + (i - a) % p] if i >= a else words[i] for i in range(n))
        else:
            assert row.text == dict(rows)[row.doc_id]
