import re

import pytest

from tidemill.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    own = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places, base = [], set()
    for label, phrase in L.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(own) - len(p) + 1) if own[i : i + len(p)] == p]
        places += found
        base |= {label} if found else set()
    labels, best, start = set(base), 0.0, 0
    while own:
        block = set(own[start : start + L.BLOCK])
        for label, words, least in L.template_sets():
            share = len(block & set(words)) / len(words)
            if len(block & set(words)) >= least:
                labels.add(label)
                best = max(best, share)
        if start + L.BLOCK >= len(own):
            break
        start += L.STEP
    return (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
            1.0 if places else best)


def run(df):
    return sorted(((r.doc_id, *r[1:]) for r in L.find_licenses(df).collect()), key=repr)


def test_against_brute_force(table, prose):
    notices = [text for _, text in L.TEMPLATES]
    rows = [(i, " ".join(prose(i, 20 + 7 * i) + text.split() + prose(i + 50, 90))) for i, text in enumerate(notices)]
    rows += [(20 + i, " ".join(w for k, w in enumerate(text.split()) if k % (i + 3))) for i, text in enumerate(notices)]
    rows += [(50, "Under the MIT License. CC BY-NC cc by nc, cc by NC 4.0"), (51, "cc by nc"), (52, None), (53, ""), (54, "!!! ..."),
             (55, "all " + " ".join(prose(3, 62)) + " rights reserved"), (56, "all " + " ".join(prose(3, 50)) + " rights reserved"),
             (57, " ".join(prose(9, 40_000)) + " Apache License, Version 2.0"), (None, "under the mit license"), (50, "under the mit licenses"),
             (58, "undér the mit license"), (59, "x under the mit license under the mit license y")]
    assert run(table(*rows).repartition(3)) == sorted(((d, *brute(t)) for d, t in rows), key=repr)


def test_prefix_filter_loses_nothing_at_other_thresholds(spark, table, prose):
    templates = [("a", "one two three four five six seven eight"), ("b", "one nine ten"), ("c", "two four")]
    rows = [(i, " ".join(w for k, w in enumerate("one two three four five six seven eight nine ten".split()) if i >> k & 1)) for i in range(1024)]
    for threshold in (0.5, 0.75, 1.0):
        docs = table(*rows)
        lines = docs.select(docs["doc_id"].alias("uid"), L.word_line(docs["text"]).alias("line"))
        found = {(r.uid, r.label) for r in L.find_blocks(lines, templates, threshold).collect()}
        sets = L.template_sets(templates, threshold)
        assert found == {(i, label) for i, text in rows for label, own, least in sets if len(set(own) & set(text.split())) >= least}


def test_no_python_in_the_plan(table, capsys):
    L.find_licenses(table((1, "a"))).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_empty_table(table):
    assert run(table((1, "a")).limit(0)) == []


@pytest.mark.parametrize("threshold", [0.5, 0.9, 1.0])
def test_template_sets(threshold):
    for _, own, least in L.template_sets(threshold=threshold):
        assert len(own) == len(set(own)) <= L.PIECE and least - 1 < threshold * len(own) <= least + 1e-6
