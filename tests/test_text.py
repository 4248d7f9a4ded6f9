from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.functions.numbers import log_sum
from tidemill.functions.text import distinct_tokens, has_token, snippet, tokenize
from tidemill.operators import bigrams as B
from tidemill.operators import counts as N
from tidemill.operators.stripes import stripes, unroll
from tidemill.sources.text import lines


def tokens(spark, text):
    return spark.createDataFrame([(text,)], "s string").select(tokenize(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("'Tis don't -- e.g., 3rd x2 Élan THE", ["tis", "don't", "e.g", "rd", "x", "lan", "the"]),
        ("", []),
        ("-- 12 ...", []),
        ("a", ["a"]),
        ("\tA  b\fC\r\n(d)", ["a", "b", "c", "d"]),
        ("x..........y -z-", ["x..........y", "z"]),
    ],
)
def test_tokenize(spark, text, expected):
    assert tokens(spark, text) == expected


def test_tokenize_survives_long_runs(spark):
    assert tokens(spark, "a" + "." * 200_000 + " " + "-" * 200_000 + "b") == ["a", "b"]


def test_has_token_agrees_with_tokenize(spark):
    df = spark.createDataFrame([("12 --",), ("é 9a",), ("",), (" ",), ("Z",)], "s string")
    assert df.filter(has_token(F.col("s")) != (F.size(tokenize(F.col("s"))) > 0)).count() == 0


def test_first_tokens_only_where_asked(spark):
    line = " ".join(["-- w"] + [f"t{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)])
    df = spark.createDataFrame([(line,)], "s string")
    assert len(df.select(distinct_tokens(F.col("s"))).first()[0]) == 121
    # Pieces without a letter count towards the limit.
    assert len(df.select(distinct_tokens(F.col("s"), 100)).first()[0]) == 99


def test_lines_and_snippet(spark, rows):
    docs = spark.createDataFrame([(1, "a\r\nb\rc\n"), (2, "")], "doc_id bigint, text string")
    assert rows(lines(docs)) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, ""), (2, 0, "")]
    cut = spark.createDataFrame([("x" * 80,), ("x" * 81,)], "s string").select(snippet(F.col("s")))
    assert rows(cut) == [("x" * 80,), ("x" * 80 + "...",)]


def test_word_and_prefix_counts(text_lines, rows):
    df = text_lines("the then a The", "")
    assert rows(N.word_count(df)) == [("a", 1), ("the", 2), ("then", 1)]
    assert rows(N.prefix_count(df)) == [("th", 3)]
    assert [tuple(r) for r in N.top_counts(N.word_count(df), 2).collect()] == [("the", 2), ("a", 1)]
    assert rows(N.count_of(N.prefix_count(df), "th")) == [("th", 3)]
    assert rows(N.nonempty_line_count(df)) == [(1,)]


def test_line_frequency_counts_a_line_once(text_lines, rows):
    assert rows(N.line_freq(text_lines("a a b", "b", "--"))) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_bigram_frequencies(text_lines, rows, hot_rows):
    counts = B.bigram_counts(text_lines("a b a b", "a c", "lone", ""))
    assert rows(counts) == [("a", "b", 2), ("a", "c", 1), ("b", "a", 1)]
    got = {(a, b): v for a, b, v in rows(B.relative_frequencies(counts, hot_rows=hot_rows))}
    assert got == pytest.approx({("a", "*"): 3, ("a", "b"): 2 / 3, ("a", "c"): 1 / 3, ("b", "*"): 1, ("b", "a"): 1})
    flat = unroll(B.relative_frequency_stripes(counts, hot_rows=hot_rows), "a", "b", "f")
    assert {(a, b): v for a, b, v in rows(flat)} == {k: v for k, v in got.items() if k[1] != "*"}


def test_stripes_of_a_large_key_are_cut(text_lines):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    counts = B.bigram_counts(text_lines(*[f"a {w}" for w in words]))
    cut = B.relative_frequency_stripes(counts, blocks=6, hot_rows=10)
    blocks = [(r["a"], r["block"], len(r["stripe"])) for r in cut.collect()]
    assert len(blocks) == 6 and sum(n for *_, n in blocks) == 300
    assert max(n for *_, n in blocks) < 120
    # The block of an entry does not depend on how many others there are.
    few = B.relative_frequency_stripes(B.bigram_counts(text_lines("a waa")), blocks=6).first()
    assert few["block"] == next(r["block"] for r in cut.collect() if "waa" in r["stripe"])


@pytest.mark.parametrize("entries", [1, 7, 10_000])
def test_maps_have_a_bounded_number_of_entries(spark, rows, entries):
    flat = spark.range(500).selectExpr("id % 3 AS k", "concat('w', id) AS o", "id AS v")
    cut = stripes(flat, "k", "o", "v", 2, entries)
    sizes = [len(r["stripe"]) for r in cut.collect()]
    assert max(sizes) <= entries and sum(sizes) == 500
    assert rows(unroll(cut, "k", "o", "v")) == rows(flat)
    assert cut.filter("map_keys(stripe) != sort_array(map_keys(stripe))").isEmpty()


def test_log_sum(spark):
    zero = float("-inf")
    df = spark.createDataFrame([(zero, zero), (zero, 0.0), (0.0, zero), (0.0, 0.0), (-800.0, -801.0)], "a double, b double")
    got = [r[0] for r in df.select(log_sum(F.col("a"), F.col("b"))).collect()]
    assert got[:3] == [zero, 0.0, 0.0]
    assert got[3:] == pytest.approx([0.6931471805599453, -799.6867383124818])


def test_word_count_equals_plain_counting(text_lines):
    text = "It was the best of times, it was the worst of times;"
    got = {r["term"]: r["n"] for r in N.word_count(text_lines(text, text)).collect()}
    assert got == {w: 2 * n for w, n in Counter(text.lower().replace(",", "").replace(";", "").split()).items()}


@pytest.mark.parametrize("shares", [B.relative_frequencies, lambda counts: unroll(B.relative_frequency_stripes(counts, blocks=5), "a", "b", "f")])
def test_bigrams_are_counted_once(spark, rows, shares):
    """Totals and shares read kept counts; a word in every block has one total."""
    counted = spark.sparkContext.accumulator(0)

    def seen(number):
        counted.add(1)
        return number

    word = F.when(F.col("id") < 900, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 7)).alias("a")
    counts = spark.range(0, 1000, 1, 4).select(word, F.concat(F.lit("x"), "id").alias("b"), F.udf(seen, "bigint")(F.col("id") % 3 + 1).alias("n"))
    got = {(a, b): v for a, b, v in rows(shares(counts)) if b != "*"}
    assert counted.value == 1000
    given = [("the" if i < 900 else f"w{i % 7}", f"x{i}", i % 3 + 1) for i in range(1000)]
    totals = Counter()
    for a, _, n in given:
        totals[a] += n
    assert got == pytest.approx({(a, b): n / totals[a] for a, b, n in given})
