import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemill.llm import automata, phrases


def brute(rows, least, per_lang=2000):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    out = []
    candidates = {key: a for key, a in counts.items() if a >= least and len(key[1]) > 1}
    for (lang, phrase), a in candidates.items():
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        inside = any(g == lang and len(longer) > len(phrase) and 100 * f >= 50 * a
                     and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer) - len(phrase) + 1))
                     for (g, longer), f in candidates.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(phrase).encode(), l, r))
    found = []
    for lang in {o[0] for o in out}:
        for rank, (_, score, a, phrase, l, r) in enumerate(sorted(o for o in out if o[0] == lang)[:per_lang], 1):
            found.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(found)


def frame(spark, rows):
    return spark.createDataFrame([(x, lang, "own", 1) for x, lang in rows], "text string, lang string, phrase string, rank int")


def run(df, **how):
    return sorted(tuple(r) for r in phrases.collocations(df, **how).collect())


def rows_of(seed, n=60):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a-b", "Éa", "éa", "x\x00y", "New", "york", "city", "A", "a", "ÀA", "\x85", "z z"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n", "\r", ":"]) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["en", "en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), (" \n", "de"), ("one two three " * 500, "fr"), (None, None), ("same text here", "en"), ("same text here", "en")]


@pytest.mark.parametrize("slice_words", [20, 1 << 21])
@pytest.mark.parametrize("least, per_lang", [(2, 2000), (10, 2000), (4, 7)])
def test_against_brute_force(spark, least, per_lang, slice_words):
    rows = rows_of(least)
    got = run(frame(spark, rows).repartition(5), least=least, per_lang=per_lang, slice_words=slice_words)
    assert got == brute(rows, least, per_lang) and got


def test_the_held_rows_are_united_early(spark, monkeypatch):
    rows = rows_of(5)
    monkeypatch.setattr(phrases, "HELD_TRANSITIONS", 5)
    assert run(frame(spark, rows).repartition(6), least=3, slice_words=30) == brute(rows, 3)


def test_empty_tables(spark):
    assert run(frame(spark, [("a b", "en")]).limit(0)) == []
    assert run(frame(spark, [(None, None), (". .", "en")])) == []


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000
    row = spark.sql(f"SELECT (cast({big} as decimal(19, 0)) * cast({big} as decimal(19, 0)) * 1000000bd) div (cast({big + 1} as decimal(19, 0)) * cast({big + 2} as decimal(19, 0))) AS s").first()
    assert row.s == 1000000 * big * big // ((big + 1) * (big + 2))


def sorted_set(rng, words, n):
    found = {}
    for _ in range(n):
        size = rng.randrange(1, 4)
        found[tuple(rng.randrange(1, words + 1) for _ in range(size)) + (0,) * (3 - size)] = rng.choice([1, 1, 1, 2, 300, 70_000])
    keys = sorted(found)
    return np.array(keys, np.int64).reshape(-1, 3).T, np.array([found[k] for k in keys], np.int64)


@pytest.mark.parametrize("seed", range(20))
def test_automata_keep_lookup_and_unite_counts(seed):
    rng = random.Random(seed)
    words = [b"w%02d" % i for i in range(12)]
    total, parts = Counter(), []
    for k in range(3):
        rows, counts = sorted_set(rng, 12, rng.choice([0, 1, 5, 200]))
        a = automata.CountAutomaton.build(words, rows, counts)
        a = automata.CountAutomaton.unpacked(*a.packed())
        spelled = [[words[s - 1] for s in row if s] for row in rows.T.tolist()]
        assert a.counts_of(spelled).tolist() == counts.tolist()
        again, weights = a.phrases()
        assert [[a.words[s - 1] for s in row if s] for row in again.T.tolist()] == spelled and weights.tolist() == counts.tolist()
        for p, c in zip(spelled, counts.tolist()):
            total[tuple(p)] += c
        parts.append(a)
    both = automata.union(parts, least=2)
    every = [[w] for w in words] + [[v, w] for v in words for w in words] + [[b"none"], [b"w00", b"none"]]
    assert both.counts_of(every).tolist() == [total[tuple(p)] if total[tuple(p)] >= 2 else 0 for p in every]
    rows, counts = both.phrases()
    assert {tuple(both.words[s - 1] for s in row if s): c for row, c in zip(rows.T.tolist(), counts.tolist())} == {p: c for p, c in total.items() if c >= 2}


def test_single_continuations_are_shared():
    rows = np.array([[a, b, 1] for a in range(1, 9) for b in range(1, 9)], np.int64).T
    a = automata.CountAutomaton.build([b"w%d" % i for i in range(8)], rows, np.ones(rows.shape[1], np.int64))
    assert len(a.first) - 1 == 2 + 8 + 1


def test_wide_numbers_sort_too(monkeypatch):
    rows, counts = sorted_set(random.Random(1), 30, 100)
    assert all((x == y).all() for x, y in zip(automata.summed(rows[:, ::-1], counts[::-1], 1 << 30), (rows, counts)))
