import corpus_pipeline as P
import pytest
import test_decontam
import test_linededup
import test_neardup
import test_packing
from pyspark.sql import functions as F

from tidemill.llm import langid, packing
from tidemill.llm.shared import stored

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, n_lines string, n_hit string, __losing_id string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted copies, repeated lines, benchmark passages and odd rows."""
    base = tmp_path_factory.mktemp("tables")
    source = "/root/testdata/sf0.001"
    bench = spark.read.parquet(f"{source}/benchmark.parquet")
    bench.write.parquet(str(base / "benchmark.parquet"))
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{source}/documents.parquet").collect()]
    texts = {r[0]: r[1] for r in rows}
    items = [r.text for r in bench.orderBy("item_id").collect()]
    long_ids = [i for i, t in sorted(texts.items()) if len(t) > 800][:4]
    rows += [(10_000 + k, texts[i] + " one more word", "en", "hot") for k, i in enumerate(long_ids)]
    rows += [(10_100 + k, f"{texts[i][:400]} {items[k]} {texts[i][-400:]}", "en", "hot") for k, i in enumerate(long_ids)]
    rows += [(10_200 + k, "A line that several documents share with each other\n" + texts[i][::-1], None, None) for k, i in enumerate(long_ids)]
    # Copies on one line, which line deduplication cannot see, with a few other words.
    rows += [(10_400 + 10 * k + j, texts[i].replace("\n", " ") + " end" * j, "en", "hot") for k, i in enumerate(long_ids) for j in range(1, 4)]
    rows += [(10_300, items[5], "en", "hot"), (10_301, None, "en", "hot"), (10_302, "", None, None), (10_303, "1234 5678", "de", "x"),
             (None, texts[long_ids[0]] + " without an id", "en", "hot"), (10_304, texts[long_ids[1]] * 30, "en", "hot")]
    made = spark.createDataFrame([(i, t, lang, s, len(t or ""), "own", "own", "own", "own", "own") for i, t, lang, s in rows], SCHEMA)
    made.repartition(3).write.parquet(str(base / "documents.parquet"))
    return str(base)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def test_every_stage_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    for name, stage in P.STAGES:
        before = rows_of(docs)
        after = stage(spark, docs, folder)
        if name != "packing":
            assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
            assert after.filter("score <> 'own' OR kept <> 'own' OR n_lines <> 'own' OR n_hit <> 'own' OR __losing_id <> 'own'").isEmpty()
            assert name == "near_dedup" or after.filter("n_chars <> char_length(text)").isEmpty()
        if name == "language_id":
            found = langid.identify(docs.select("doc_id", "text"), langid.learn(docs)).collect()
            want = sorted(((r.doc_id, r.text) for r in found if r.lang_pred != "und" and r.score >= langid.MARGIN), key=repr)
            assert rows_of(after) == want and len(want) >= len(before) - 10
            assert not {10_301, 10_302, 10_303} & {i for i, _ in want}
        elif name == "line_dedup":
            assert rows_of(after) == sorted(((i, t) for i, t, *_ in test_linededup.brute(before)), key=repr)
        elif name == "near_dedup":
            best = {i: c for i, _, c in test_neardup.brute(before) if i is not None}
            assert rows_of(after) == [(i, t) for i, t in before if i is None or best[i] == i]
            assert len(rows_of(after)) < len(before)
        elif name == "decontamination":
            got = dict(rows_of(after))
            for i, t in before:
                n, hit, _ = test_decontam.brute(t, items, 10)
                assert (i in got) == (2 * len(hit) <= n)
                if i in got:
                    assert test_decontam.words(got[i]) == [w for k, w in enumerate(test_decontam.words(t)) if k not in hit]
                    assert hit or got[i] == t
        else:
            total = {}
            for r in after.collect():
                total[r.doc_id] = total.get(r.doc_id, 0) + r.length
            assert total == {i: len((t or "").encode()) + 1 for i, t in before}
            groups = [(r.doc_id, r.length, r.source, r.cluster, k) for k, r in enumerate(docs.select(
                "doc_id", packing.byte_length(F.col("text")).alias("length"), "source", F.lit(None).alias("cluster")).collect())]
            assert len({r.bin_id for r in after.collect()}) <= 1.05 * len({p[4] for p in test_packing.brute(groups, packing.CAPACITY)})
        docs = stored(after, f"test-{name}")


def test_run_equals_the_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, folder), "test-run")
    pieces = lambda df: sorted((r.doc_id or -1, r.piece, r.start, r.length) for r in df.collect())
    assert pieces(P.run(spark, folder)) == pieces(docs)


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stored(stage(spark, docs, folder), "test-empty")
        assert docs.collect() == []
