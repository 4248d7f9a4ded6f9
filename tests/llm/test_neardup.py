import re

import numpy as np
import pytest

from tidemill.llm import neardup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    own = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)} if len(own) >= 5 else {tuple(own)} if own else set()


def brute(rows):
    sets = [(doc_id, shingles(text)) for doc_id, text in rows]
    parent = {doc_id: doc_id for doc_id, _ in rows if doc_id is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((d, len(s), root(d) if d is not None else None) for d, s in sets), key=repr)


def run(df, **options):
    found = neardup.near_duplicates(df, **options).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)


def changed(words, *places):
    return [f"other{i}" if i in places else w for i, w in enumerate(words)]


def test_against_brute_force(table, prose):
    rows = [(i, " ".join(prose(i, 60))) for i in range(10)]
    base = prose(99, 80)
    rows += [(100 + k, " ".join(changed(base, k))) for k in range(12)]  # a star of near copies
    walk = prose(77, 60)
    for k in range(8):  # a chain: each is close to the one before, far from the first
        rows.append((200 + k, " ".join(walk)))
        walk = changed(walk, 7 * k)
    rows += [(300, " ".join(base)), (20, " ".join(base)), (301, None), (302, ""), (303, " \n\t"), (304, "one two"), (305, "ONE  two"),
             (306, "one two three"), (307, "a b c d e"), (308, "a b c d e"), (None, " ".join(base)), (None, None)]
    rows += [(400, " ".join(prose(5, 30_000))), (399, " ".join(changed(prose(5, 30_000), 3, 9_000)))]
    assert run(table(*rows).repartition(5)) == brute(rows)


def test_a_shared_passage_alone_links_nothing(table, prose):
    passage = prose(1, 60)
    rows = [(i, " ".join(passage + prose(10 + i, 40))) for i in range(40)]
    assert run(table(*rows)) == brute(rows)


def test_groups_that_share_a_bucket_but_not_its_center(table, prose):
    """Everything is in one bucket, so only links away from its smallest id make the groups."""
    base, other = prose(1, 70), prose(2, 70)
    rows = [(0, " ".join(prose(3, 70)))] + [(10 - k, " ".join(changed(base, k))) for k in range(4)]
    rows += [(20 + k, " ".join(changed(other, *range(0, 6 * k, 6)))) for k in range(6)]
    assert run(table(*rows), keys_of=lambda x: np.zeros(1, np.int64)) == brute(rows)


def test_rows_of_one_id_are_one_document(table, prose):
    a, b = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    assert run(table((4, a), (4, a), (4, b), (7, b))) == [(4, 46, 4), (4, 46, 4), (4, 46, 4), (7, 46, 4)]


def test_empty_table(table):
    assert run(table((1, "a")).limit(0)) == []


@pytest.mark.parametrize("n", [1, 2, 5, 40, 144, 3000])
def test_sketch_is_full_and_estimates_similarity(n):
    rng = np.random.default_rng(n)
    x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    s = neardup.sketch(x)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (neardup.sketch(x.copy()) == s).all()
    if n >= 40:
        more = np.unique(np.concatenate([x, rng.integers(0, 1 << 63, len(x) // 4, dtype=np.uint64)]))
        real = len(x) / len(more)
        assert abs((neardup.sketch(more) == s).mean() - real) < 0.2


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (1, 50, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[: n // 2], rng.integers(0, 1 << 63, n // 3, dtype=np.uint64)]))
        apart = np.unpackbits((neardup.parity_map(x) ^ neardup.parity_map(y)).view(np.uint8)).sum()
        assert apart <= len(np.setxor1d(x, y)) and len(neardup.parity_map(x)) * 64 == neardup.MAP_BITS


def test_sketch_fills_without_luck(monkeypatch):
    """Where the hashed rounds leave bins empty, the later rounds fill them."""
    monkeypatch.setattr(neardup, "_mix", lambda x: np.broadcast_to(x, x.shape) & np.uint64((1 << 40) - 1))
    assert (neardup.sketch(np.array([5, 9], np.uint64)) != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
