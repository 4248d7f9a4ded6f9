import numpy as np
import pytest

from tidemill.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows):
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if doc_id is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc_id is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == doc_id]
        out.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def run(df, **size):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in linededup.drop_repeated_lines(df, **size).collect()), key=repr)


def rows_of(prose):
    rows = [(i, "\n".join(" ".join(prose(i * 31 + k, 4)) for k in range(5)) + "\nA shared line of text\n\nshort\n Everyé SECOND \t" + "x" * (i % 2)) for i in range(40)]
    return rows + [(90, None), (91, ""), (92, "\n\n"), (93, "a shared LINE of text\na shared line of text"), (94, "é" * 9), (95, "é" * 9),
                   (96, "é" * 10), (97, "é" * 10), (98, "É" * 10), (99, "y" * 200_000), (100, "y" * 200_000 + "\r"), (None, "A shared line of text"), (None, None)]


def test_against_brute_force(table, prose):
    rows = rows_of(prose)
    assert run(table(*rows).repartition(5)) == brute(rows)


def test_rows_of_one_id_are_one_document(table):
    rows = [(3, "same line here\nother"), (3, "same line here\nmore"), (4, "same line here")]
    assert run(table(*rows)) == brute(rows) == [(3, "same line here\nmore", 2, 0), (3, "same line here\nother", 2, 0), (4, "", 1, 1)]


def test_a_full_filter_changes_nothing(table, prose):
    rows = rows_of(prose)
    assert run(table(*rows).repartition(5), segment_bits=64, max_segments=2) == brute(rows)


def test_other_columns_stay_and_clashing_ones_are_replaced(table):
    df = linededup.drop_repeated_lines(table((1, "a line of text"), (2, "a line of text")))
    assert {r.doc_id: (r.source, r.kept, r.n_lines) for r in df.collect()} == {1: ("s0", 7, 1), 2: ("s0", 7, 1)}


def test_empty_table(table):
    assert run(table((1, "a")).limit(0)) == []


@pytest.mark.parametrize("split", [0, 1, 3, 6])
def test_filters_miss_no_repeat(split):
    """Keys added twice, in one call, in two calls or in two merged filters, are all in ``twice``."""
    keys = [b"key number %d" % i for i in range(500)]
    parts = [keys[: 100 * split] + keys[:50], keys[100 * split :] + keys[20:70]]
    filters = []
    for part in parts:
        one = linededup._Filters()
        if part:
            one.add(*linededup._bits(part, 3))
        filters.append(one)
    whole, other = filters
    for s in other.once:
        whole.merge(s, other.once[s], other.twice[s])
    count = {k: sum(p.count(k) for p in parts) for k in keys}
    segment, bits = linededup._bits(keys, 3)
    seen = [bool(whole.twice[s][bits[:, i]].all()) for i, s in enumerate(segment)]
    assert all(hit for hit, k in zip(seen, keys) if count[k] > 1)
    assert np.mean([hit for hit, k in zip(seen, keys) if count[k] == 1]) < 0.02
