import zlib

import numpy as np
import pytest

from tidemill.llm import mph, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = public_tokenizers.path("word_bpe_49k.json")

TEXTS = ["Hello  World!\tit's 42\n", "", None, "ÉCOLE naïve été Ὀδυσσεύς ΣΑΣ", "́e á ́", "你好 世界", "a b c\x1cd\x85e",
         "<|endoftext|> x<|startoftext|>y", "don't we'll", "x" * 5000, "😀😀 ok ẛ̣", "\x00\x0b\x0c", "word " * 30_000]


def plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILE)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [tokens.END_ID] for t in texts]


@pytest.mark.parametrize("fold", [False, True])
def test_word_by_word_equals_whole_texts(fold):
    with open(FILE, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read(), fold=fold)
    got = [np.frombuffer(p, encoder.dtype).tolist() for p in encoder.encode([(t or "").encode() for t in TEXTS])]
    assert got == plain(TEXTS)


def test_words_in_any_case_and_with_any_marks(monkeypatch):
    """Folded words equal whole texts, also where the memo is emptied again and again."""
    import random

    monkeypatch.setattr(tokens, "MEMO", 50)
    rng = random.Random(5)
    letters = "abcXYZ" * 4 + "éüñøÿ×÷ßÉß\u0331\u030a'’.,;:!?-_0129<|>你"
    texts = ["".join(rng.choice(letters + " " * 6 + "\n") for _ in range(rng.randrange(200))) for _ in range(300)]
    texts += ["END, end. END?! H\u0331 H\u0331, A\u030a. <|ENDOFTEXT|> <|endoftext|>, it'S. it's, I'LL! 's. a's a.b a..b .a A."]
    with open(FILE, encoding="utf-8") as file:
        encoder = tokens.Encoder(file.read(), fold=True)
    got = [np.frombuffer(p, encoder.dtype).tolist() for b in range(0, len(texts), 20) for p in encoder.encode([t.encode() for t in texts[b : b + 20]])]
    assert got == plain(texts)


@pytest.mark.parametrize("fold", [False, True])
def test_round_trip(table, fold):
    rows = [(50 - 3 * i, t) for i, t in enumerate(TEXTS)] + [(500 + i, f"text number {i} of many") for i in range(300)] + [(None, "none"), (500, "again"), (500, "again")]
    docs = table(*rows).repartition(5)
    store = tokens.tokenize_to_store(docs, FILE, fold=fold)
    located = store.locate(tokens.document_keys(docs))
    read = store.read(located).collect()
    ids = {}
    for (doc_id, _), own in zip(rows, plain([t for _, t in rows])):
        ids.setdefault(doc_id, []).append(own)
    got = {}
    for r in read:
        got.setdefault(r.doc_id, []).append(np.frombuffer(r.ids, "<u4").tolist())
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
    place = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    sums = {(r.doc_id, r.copy): r.ids_crc32 for r in store.checksums(located).collect()}
    assert sums == {(r.doc_id, r.copy): zlib.crc32(r.ids) for r in read}


def test_absent_keys_are_not_found(spark, table):
    docs = table(*[(i, f"text {i}") for i in range(200)])
    store = tokens.tokenize_to_store(docs, FILE)
    keys = spark.createDataFrame([(i, c) for i in range(-50, 300) for c in (0, 1)], "doc_id bigint, copy bigint")
    assert sorted(r.doc_id for r in store.locate(keys).collect()) == list(range(200))


def test_empty_table(table):
    docs = table((1, "a")).limit(0)
    store = tokens.tokenize_to_store(docs, FILE)
    assert store.checksums(store.locate(tokens.document_keys(docs))).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 77, 20_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    index = mph.Index(mph.packed(keys, {"value": keys.astype(np.int64)}))
    there, values = index.find(keys)
    assert there.all() and (values["value"] == keys.astype(np.int64)).all()
    assert sorted(index.table.slots(keys).tolist()) == list(range(len(keys)))
    strange = rng.integers(1 << 63, (1 << 64) - 1, 5000, dtype=np.uint64)
    assert index.find(strange)[0].sum() <= 1


def test_equal_keys_are_an_error():
    with pytest.raises(ValueError):
        mph.PerfectHash.of(np.array([5, 5], np.uint64))
