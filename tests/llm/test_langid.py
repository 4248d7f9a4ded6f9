import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import langid

SYLLABLES = {"aa": "ka lo mi nu ra sto vel".split(), "bb": "zhe qui xor bly wug fnord eth".split(), "cc": "ñam çed ühr ößt ège ôle îsk".split()}


def text(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture
def labelled(spark):
    rng = random.Random(3)
    rows = [(i, text(lang := rng.choice(list(SYLLABLES)), rng, rng.randrange(20, 300)), lang) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)


def test_held_out_accuracy(labelled):
    model = langid.learn(labelled, 20, 8192)
    assert sorted(model) == sorted(SYLLABLES) and all(len(d) <= 8192 for d in model.values())
    found = langid.identify(labelled, model)
    found = found.filter(langid.held_out(found["doc_id"])).collect()
    assert len(found) > 150
    assert sum(r.lang == r.lang_pred for r in found) >= 0.99 * len(found)
    assert all(0 <= r.score <= 1 for r in found) and not any(r.rejected for r in found)


def test_a_few_words_are_enough(spark, labelled):
    rng = random.Random(8)
    rows = [(i, text(lang := rng.choice(list(SYLLABLES)), rng, 4), lang) for i in range(200)]
    found = langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), langid.learn(labelled, 20, 8192)).collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 190 and sum(r.rejected for r in found) <= 5


def test_learning_never_sees_held_out_rows(labelled):
    only = labelled.filter(langid.held_out(labelled["doc_id"]))
    assert langid.learn(only) == {}


def test_cases(spark, labelled):
    model = langid.learn(labelled, 20, 8192)
    long = "kalomi stovel " * 20_000
    rows = [(1, None), (2, ""), (3, "123 !!"), (None, "kalo mira stovel"), (4, long), (4, long), (5, "q")]
    docs = spark.createDataFrame([(i, x, "own", 2) for i, x in rows], "doc_id bigint, text string, score string, rejected int")
    found = langid.identify(docs, model).collect()
    assert len(found) == 7
    by = {r.doc_id: r for r in found}
    for i in (1, 2, 3):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert by[None].lang_pred == by[4].lang_pred == "aa" and by[5].lang_pred in SYLLABLES
    assert {r.lang_pred for r in langid.identify(docs, {}).collect()} == {"und"}
    assert {r.score for r in langid.identify(docs, {"aa": b"x"}).collect()} == {0.0, 1.0}
    assert langid.identify(docs.limit(0), model).collect() == []


def test_every_sampled_text_has_a_share(spark):
    rng = random.Random(12)
    own = [f"t{i}x " + text("aa", rng, n) for i, n in enumerate([5, 20] * 10 + [9_000] * 10)]
    rows = [(i, x, "aa") for i, x in enumerate(own * 4)] + [(1000 + i, own[-1], "aa") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").filter(~langid.held_out(F.col("doc_id")))
    seen = {r.text for r in docs.collect()}
    room = 16_384
    taken = langid.sampled(docs, 1_000, room)["aa"]
    assert len(taken) == len(set(taken)) == len(seen)
    assert {t.split()[0] for t in taken} == {x.split()[0].encode() for x in seen}
    whole = {" ".join(x.lower().split()).encode() for x in seen}
    cut = [t for t in taken if t not in whole]
    assert len({len(t) for t in cut}) == 1 and len(cut[0]) > room / len(taken)
    (model,) = langid.learn(docs, 1_000, room).values()
    assert model == b" ".join(taken) and room - len(taken) <= len(model) <= room


def test_equal_share():
    for sizes, room in (([], 10), ([3], 10), ([30], 10), ([1, 1, 50, 60], 44), ([9, 9, 9], 30), ([9, 9, 10], 30)):
        cap = langid._equal_share(sizes, room)
        assert sum(min(s, cap) + 1 for s in sizes) <= room
        assert not sizes or cap >= max(sizes) or sum(min(s, cap + 1) + 1 for s in sizes) > room


def test_predictions_against_plain_compression(spark, labelled):
    """Every text under every dictionary, one after the other, in plain Python."""
    import zstandard

    model = langid.learn(labelled, 20, 8192)
    rng = random.Random(17)
    rows = [(i, text(rng.choice(list(SYLLABLES)), rng, rng.randrange(1, 700)) + rng.choice(["", " 12", "\n\nÉ", "\tX"])) for i in range(80)]
    rows += [(100, None), (101, ""), (102, " 12 ... 34 "), (103, "a"), (104, "A " * 5000), (105, " ".join(text(k, rng, 30) for k in SYLLABLES))]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), model).collect()}
    for doc_id, own in rows:
        row = got[doc_id]
        if own is None or not any(c.isalpha() for c in own):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        folded = " ".join(own.lower().split()).encode()
        sizes = []
        for lang in sorted(model):
            total = 0
            for begin in range(0, len(folded), langid.PIECE):
                dictionary = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                press = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
                total += len(press.compress(folded[begin : begin + langid.PIECE] + langid.PAD))
            sizes.append((total, lang))
        best, second = sorted(sizes)[:2]
        assert row.lang_pred == best[1] and row.score == 1 - best[0] / second[0] and row.rejected == (row.score < langid.MARGIN)
