import hashlib
import random
import re

import pytest

from tidemill.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    own, hit, found = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        k = min(window, len(w))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for i in range(len(own) - k + 1):
            if tuple(own[i : i + k]) in grams:
                hit.update(range(i, i + k))
                found.add(str(item_id))
    return len(own), hit, found


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("window", [1, 3, 10])
def test_automaton_against_brute_force(seed, window):
    rng = random.Random(seed)
    letters = ["a", "b", "c", "d", "e"][: 2 + seed % 4]
    items = [(n, " ".join(rng.choices(letters, k=rng.choice([0, 1, 2, 4, 9, 12, 30])))) for n in range(rng.choice([0, 1, 8]))]
    automaton = decontam.ItemAutomaton([(str(n), decontam.words(x.encode())) for n, x in items], window)
    for _ in range(60):
        text = " ".join(rng.choices(letters + ["z"], k=rng.randrange(0, 40)))
        n, hit, found = brute(text, items, window)
        mask, numbers = automaton.scan(decontam.words(text.encode()))
        assert set(mask.nonzero()[0].tolist()) == hit
        assert {automaton.item_ids[i] for i in numbers} == found


def test_words_match_the_pattern():
    text = "Café naïve--x_y 你好,\x7f 3.14 Z\x00q \U0001f600!"
    assert [w.decode() for w in decontam.words(text.encode())] == words(text)


def test_query_columns_and_clean_text(spark, table, prose):
    passage = " ".join(prose(1, 12))
    bench = spark.createDataFrame([(7, passage), (8, "Short, item"), (9, None), (None, "x y"), (10, "..."), (7, passage)], "item_id bigint, text string")
    before, after = " ".join(prose(2, 30)), " ".join(prose(3, 30))
    rows = [(1, f"{before}: {passage.upper()}! {after}"), (2, None), (3, ""), (4, passage), (5, "a short item, b"), (6, before),
            (None, passage), (7, " ".join(prose(4, 60_000)))]
    found = {r.doc_id: r for r in decontam.find_contamination(table(*rows), bench).collect()}
    items = [(7, passage), (8, "Short, item")]
    for doc_id, text in rows:
        n, hit, names = brute(text, items, 10)
        row = found[doc_id]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, len(hit), len(names), bool(hit))
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert row.text == text and row.score == "own"
    assert found[1].clean_text == f"{before}: ! {after}"
    assert found[5].clean_text == "a , b"
    assert found[6].clean_text is None
    cleaned = {r.doc_id: r.text for r in decontam.remove_contamination(table(*rows), bench).collect()}
    assert cleaned.keys() == {1, 2, 3, 5, 6, 7}
    assert cleaned[1] == f"{before}: ! {after}" and cleaned[6] == before and cleaned[2] is None


def test_empty_tables(spark, table):
    none = spark.createDataFrame([], "item_id bigint, text string")
    (row,) = decontam.find_contamination(table((1, "some text")), none).collect()
    assert (row.n_words, row.n_hit) == (2, 0)
    assert decontam.find_contamination(table((1, "a")).limit(0), none).collect() == []


def test_items_without_an_id(spark, table, prose):
    nameless, other, named = (" ".join(prose(seed, 12)) for seed in (21, 22, 23))
    bench = spark.createDataFrame([(None, nameless), (None, other), (7, named), (None, "short one")], "item_id bigint, text string")
    before = " ".join(prose(24, 30))
    rows = [(1, f"{before} {nameless} {before}"), (2, f"{nameless} {other} {named}"), (3, f"{before} {named}"), (4, before), (5, "a short one, b")]
    got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.find_contamination(table(*rows), bench).collect()}
    none, seven = hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"7").hexdigest()
    assert got == {1: (12, 1, none, True), 2: (36, 2, seven, True), 3: (12, 1, seven, True), 4: (0, 0, none, False), 5: (2, 1, none, True)}
    cleaned = {r.doc_id: r.text for r in decontam.remove_contamination(table(*rows), bench).collect()}
    assert cleaned == {1: f"{before}  {before}", 3: f"{before} ", 4: before, 5: "a , b"}
    duckdb = pytest.importorskip("duckdb")
    from tidemill.llm.catalog_sql import DECONTAMINATION

    con = duckdb.connect()
    con.register("documents", table(*rows).toPandas())
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [tuple(r) for r in bench.collect()])
    sql = {r[0]: (r[2], r[3], r[4], r[5]) for r in con.execute(DECONTAMINATION).fetchall()}
    assert got == sql


@pytest.mark.parametrize("block_words", [1, 12, 40, 100_000])
@pytest.mark.parametrize("window", [3, 10])
def test_items_in_blocks_equal_brute_force(spark, table, prose, block_words, window):
    rng = random.Random(window)
    letters = "abcde"
    items = [(n, " ".join(rng.choices(letters, k=rng.choice([0, 1, 2, 9, 12, 30, 70])))) for n in range(12)]
    bench = spark.createDataFrame([*items, (None, "z z z"), (None, None)], "item_id bigint, text string")
    rows = [(i, " ".join(rng.choices(letters + "z", k=rng.randrange(40)))) for i in range(60)] + [(100, None), (101, ""), (None, items[-1][1])]
    rows += [(200 + i, "own " + items[5][1] + " z z z") for i in range(20)]
    found = decontam.find_contamination(table(*rows).repartition(3), bench, window, block_words).collect()
    assert len(found) == len(rows)
    texts = {}
    for row in found:
        n, hit, names = brute(row.text, [*items, (None, "z z z")], window)
        named = names - {"None"}
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (n, len(hit), len(names), bool(hit)) and row.score == "own"
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        texts.setdefault(row.text, set()).add(row.clean_text)
    assert all(len(clean) == 1 for clean in texts.values())


def test_blocks_hold_no_more_than_their_size(spark):
    bench = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(n))) for i, n in enumerate([5, 100, 7, 0, 33])], "item_id int, text string")
    blocks = list(decontam.item_blocks(bench, 4, 20))
    assert len(blocks) > 5 and all(sum(len(own) for _, own in b) <= 20 for b in blocks)
    grams = {(i, tuple(w.decode() for w in own[k : k + 4])) for b in blocks for i, own in b for k in range(len(own) - 3)}
    assert grams == {(str(i), tuple(f"w{i}x{k + j}" for j in range(4))) for i, n in enumerate([5, 100, 7, 0, 33]) for k in range(n - 3)}
