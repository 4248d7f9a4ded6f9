import pytest
from pyspark.sql import functions as F

from tidemill.operators import index as I
from tidemill.operators import retrieval as Q
from tidemill.sources.sinks import fetch_postings, write_index, write_text
from tidemill.sources.text import read_lines

QUERIES = [
    ("white red OR rose AND pluck AND", [0, 2]),
    ("nosuch rose OR", [0, 1, 2]),
    ("nosuch rose AND", []),
    ("red", [1, 2]),
    ("Red", []),
    ("red red AND", [1, 2]),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(0, "white rose pluck"), (1, "red rose"), (2, "red pluck rose rose")], "doc_id bigint, text string"
    )


@pytest.fixture(scope="module")
def postings(docs):
    return I.term_freq(docs)


def test_postings(postings, rows):
    assert rows(postings.filter("term = 'rose'")) == [("rose", 0, 1), ("rose", 1, 1), ("rose", 2, 2)]
    assert dict(rows(I.doc_freq(postings)))["rose"] == 3


@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("block_bits", [16, 1, 0])
def test_lists(postings, rows, block_bits, hot_rows):
    lists = I.posting_lists(postings, block_bits, hot_rows)
    assert rows(I.flat_postings(lists).drop("df")) == rows(postings)
    rose = lists.filter("term = 'rose'").orderBy("block").collect()
    assert [d for r in rose for d, _ in r["postings"]] == [0, 1, 2]
    assert {r["df"] for r in rose} == {3}
    assert max(len(r["postings"]) for r in rose) <= max(2**block_bits, 1)


@pytest.mark.parametrize("block_bits", [16, 2, 1])
def test_gaps(spark, rows, block_bits):
    flat = spark.createDataFrame(
        [(t, d, 1 + d % 3) for t, ds in {"a": [0, 1, 5, 6, 17, 40], "b": [3], "c": [7, 8]}.items() for d in ds],
        "term string, doc_id bigint, tf bigint",
    )
    gaps = I.gap_encode(flat, block_bits)
    assert [(p, g) for _, p, g, _ in rows(gaps.filter("term = 'a'"))] == [(0, 0), (1, 1), (2, 4), (3, 1), (4, 11), (5, 23)]
    assert rows(I.gap_decode(gaps, block_bits)) == rows(flat)


@pytest.mark.parametrize("query, expected", QUERIES)
def test_search(postings, rows, query, expected):
    assert [d for d, in rows(Q.search(postings, query))] == expected
    assert [d for d, in rows(Q.search_sets(postings, query))] == expected


def test_many_queries_at_once(postings, rows):
    got = rows(Q.search_many(postings, [(i, q) for i, (q, _) in enumerate(QUERIES)]))
    assert got == [(i, d) for i, (_, ds) in enumerate(QUERIES) for d in ds]


@pytest.mark.parametrize("query", ["rose AND", "rose red", "", "AND", "rose red AND OR"])
def test_malformed_queries(postings, query):
    for run in (Q.search, Q.search_sets):
        with pytest.raises(ValueError):
            run(postings, query)


def test_results_are_shown_in_order(postings, docs):
    shown = Q.show_results(Q.search(postings, "red white OR"), docs).collect()
    assert [tuple(r) for r in shown] == [(0, "white rose pluck"), (1, "red rose"), (2, "red pluck rose rose")]


def test_stored_index(spark, postings, rows, tmp_path):
    path = str(tmp_path / "index")
    write_index(postings, path, 8)
    write_index(postings, path, 8)  # replaces
    assert rows(spark.read.parquet(path).select("term", "doc_id", "tf")) == rows(postings)
    assert rows(fetch_postings(spark, path, "rose", 8)) == [("rose", 0, 1), ("rose", 1, 1), ("rose", 2, 2)]
    assert rows(fetch_postings(spark, path, "nosuch", 8)) == []
    query = "white red OR rose AND pluck AND"
    found = Q.stored_postings(spark, path, Q.query_terms(query), 8)
    assert [d for d, in rows(Q.search(found, query))] == [0, 2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan or "PartitionFilters: [(" in plan


def test_lines_of_files_are_documents(spark, rows, tmp_path):
    (tmp_path / "t.txt").write_text("white rose\nred rose\n")
    docs = read_lines(spark, str(tmp_path / "t.txt"))
    found = Q.search(I.term_freq(docs, text="line"), "rose red AND")
    assert [s for _, s in rows(Q.hydrate(found, docs, text="line"))] == ["red rose"]
    assert docs.select(F.countDistinct("doc_id")).first()[0] == 2


def test_line_ids_do_not_depend_on_the_splits(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name} line {i}\n" for i in range(3000)))
    found = []
    for size in ("4k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        try:
            found.append({tuple(r) for r in read_lines(spark, str(tmp_path)).collect()})
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] and len({r[0] for r in found[0]}) == 6000
    assert all(line == f"{path[-5]} line {number}" for _, path, number, line in found[0])


def test_lines_can_be_indexed(spark, rows, tmp_path):
    text = spark.createDataFrame([(1, 0, "white rose"), (1, 1, "red rose"), (2, 0, "red")], "doc_id bigint, line_no int, line string")
    path = str(tmp_path / "lines")
    write_index(I.term_freq(text, text="line", unit=("line_no",)), path, 4)
    ids = ("doc_id", "line_no")
    found = Q.search(Q.stored_postings(spark, path, ["red", "rose"], 4), "red rose AND", ids)
    assert rows(Q.hydrate(found, text, ids, "line")) == [(1, 1, "red rose")]


def test_many_queries_have_one_plan(spark, postings):
    plans = [Q.search_many(postings, [(i, "rose red OR pluck AND") for i in range(n)])._jdf.queryExecution().analyzed().toString() for n in (1, 400)]
    assert len(plans[0].splitlines()) == len(plans[1].splitlines())
    assert Q.search_many(postings, [(i, "rose red OR pluck AND") for i in range(400)]).count() == 800


def test_text_output_keeps_its_columns(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None)], "x string, y int, z string")
    for null, want in (("", ["\t\t", "a\t\tc"]), ("?", ["?\t?\t?", "a\t?\tc"])):
        write_text(df, str(tmp_path / "out"), null=null)
        assert sorted(r[0] for r in spark.read.text(str(tmp_path / "out")).collect()) == want


def test_postings_are_counted_in_tasks_of_bounded_input(spark, rows, tmp_path, monkeypatch):
    """More text gives more tasks, not larger ones, and their postings are not shuffled."""
    path = str(tmp_path / "docs")
    texts = spark.range(400).selectExpr("id AS doc_id", "concat('rose red ', id % 7, ' rose w', char(97 + id % 26)) AS text")
    texts.coalesce(1).write.parquet(path)
    docs = spark.read.parquet(path)
    want = rows(I.term_freq(docs))
    assert len(want) == 3 * 400
    monkeypatch.setattr(I, "TASK_BYTES", 100)
    found = I.term_freq(docs)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert found.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert rows(found) == want


def test_an_index_computes_its_postings_once(spark, rows, tmp_path):
    """No sample is taken first; what one bucket has too much of is still cut into several sorted files."""
    counted = spark.sparkContext.accumulator(0)

    def seen(number):
        counted.add(1)
        return number

    frequent = F.when(F.col("id") % 4 > 0, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 97))
    postings = spark.range(0, 20_000, 1, 8).select(frequent.alias("term"), F.udf(seen, "bigint")("id").alias("doc_id"), F.lit(1).alias("tf"))
    path = str(tmp_path / "index")
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        write_index(postings, path, 8)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert counted.value == 20_000
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert stored.filter("term = 'the'").select("file").distinct().count() > 1 and stored.filter("term = 'the'").count() == 15_000
    ordered = F.array_sort("kept") == F.col("kept")
    kept = stored.withColumn("at", F.monotonically_increasing_id()).groupBy("file").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "term", "doc_id"))), lambda r: F.struct(r["term"], r["doc_id"])).alias("kept"))
    assert kept.filter(~ordered).count() == 0
