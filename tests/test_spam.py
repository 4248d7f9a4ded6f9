import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import spam as P
from tidemill.operators.evaluation import roc_gap
from tidemill.sources.sinks import write_text
from tidemill.sources.text import parse_instances, read_instances, read_model

INSTANCES = "doc_id string, label string, features array<int>"
MODEL = "model_id string, feature int, weight double"


@pytest.fixture(scope="module")
def three(spark):
    return spark.createDataFrame([("d1", "spam", [1, 1, 3]), ("d2", "ham", [2]), ("d3", "ham", [9])], INSTANCES)


@pytest.fixture(scope="module")
def model(spark):
    return spark.createDataFrame([("x", 1, 0.5), ("x", 2, -0.25)], MODEL)


@pytest.mark.parametrize("hot_rows", [None, 1])
def test_classify(three, model, rows, hot_rows):
    assert rows(P.classify(three, model, hot_rows)) == [
        ("d1", "spam", 1.0, "spam"),
        ("d2", "ham", -0.25, "ham"),
        ("d3", "ham", 0.0, "ham"),
    ]


def test_document_without_features(spark, model, rows):
    df = spark.createDataFrame([("d", "ham", [])], INSTANCES)
    assert rows(P.score(df, model)) == [("d", "ham", 0.0)]


def test_ensembles(spark, rows):
    one = spark.createDataFrame([("d", "spam", [1])], INSTANCES)
    models = spark.createDataFrame([("x", 1, 2.0), ("y", 1, -1.0), ("z", 1, -0.5)], MODEL)
    names = ["x", "y", "z"]
    average = rows(P.ensemble(one, models, names, "average"))
    assert average[0][2] == pytest.approx(1 / 6) and average[0][3] == "spam"
    assert rows(P.ensemble(one, models, names, "vote")) == [("d", "spam", -1.0, "ham")]
    # A model that knows none of the features scores 0, which is a vote for ham.
    assert rows(P.ensemble(one, models, names + ["w"], "vote"))[0][2] == -2.0
    with pytest.raises(ValueError):
        P.ensemble(one, models, names, "median")


@pytest.mark.parametrize("hot_rows", [None, 1])
@pytest.mark.parametrize("method", ["average", "vote"])
def test_ensemble_against_brute_force(spark, monkeypatch, method, hot_rows):
    monkeypatch.setattr(P, "MODELS_PER_BLOCK", 4)
    chance = random.Random(5)
    weights = {(f"m{m}", f): chance.choice([-1.0, -0.5, 0.75, 1.5]) for m in range(30) for f in range(12) if chance.random() < 0.4}
    docs = [(d, "ham", [chance.randrange(14) for _ in range(chance.randrange(8))]) for d in [None, *(f"d{i}" for i in range(40))]]
    names = [f"m{m}" for m in range(28)] + ["m1", "unknown"]
    instances = spark.createDataFrame(docs, INSTANCES)
    models = spark.createDataFrame([(m, f, w) for (m, f), w in weights.items()], MODEL)
    got = {r.doc_id: (r.score, r.prediction) for r in P.ensemble(instances, models, names, method, hot_rows).collect()}
    assert got.keys() == {d for d, *_ in docs}
    for doc_id, _, features in docs:
        each = [sum(weights.get((m, f), 0.0) for f in features) for m in names]
        score = sum(each) / len(each) if method == "average" else sum(1 if s > 0 else -1 for s in each)
        assert got[doc_id] == (pytest.approx(score), "spam" if score > 0 else "ham")
    assert P.ensemble(instances, models, [], method, hot_rows).collect() == []


def test_ensemble_of_more_than_a_thousand_models(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as contract

    chance = random.Random(8)
    docs = [(i, " ".join(chance.choice("abcde") + chance.choice("abcde") for _ in range(6)), f"l{i:04d}") for i in range(1100)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, chance.randrange(2)) for i, *_ in docs]
    spark.createDataFrame(labels, "doc_id bigint, quality int").coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("spam_ensemble_average", "spam_ensemble_vote"):
        got = sorted(tuple(r) for r in contract.queries()[name](spark, str(tmp_path)).collect())
        want = sorted(con.execute(contract.oracle_sql()[name]).fetchall())
        assert [(d, y, p) for d, y, _, p in got] == [(d, y, p) for d, y, _, p in want]
        assert [s for *_, s, _ in got] == pytest.approx([s for *_, s, _ in want], abs=2e-6)


def test_one_step_of_training(spark, rows):
    df = spark.createDataFrame([("m", "d", "spam", [1, 2, 1])], f"model_id string, {INSTANCES}")
    got = {f: w for _, f, w in rows(P.train_online(df, F.col("doc_id")))}
    assert got == pytest.approx({1: 0.002, 2: 0.001})


def test_empty_instances_teach_nothing(spark, rows):
    df = spark.createDataFrame([("m", "a", "ham", [])], f"model_id string, {INSTANCES}")
    assert rows(P.train_online(df, F.col("doc_id"))) == [] == rows(P.train_batch(df, 2))


def plain_descent(instances, delta):
    weights = {}
    for label, features in instances:
        score = sum(weights.get(f, 0.0) for f in features)
        step = ((label == "spam") - 1 / (1 + math.exp(-score))) * delta
        for f in features:
            weights[f] = weights.get(f, 0.0) + step
    return weights


@pytest.fixture(scope="module")
def sample():
    chance = random.Random(11)
    return [
        (f"d{i:03d}", label, [chance.randrange(10) + (6 if label == "spam" else 0) for _ in range(chance.randint(1, 12))])
        for i in range(80)
        for label in [chance.choice(["spam", "ham"])]
    ]


@pytest.fixture(scope="module")
def training(spark, sample):
    return spark.createDataFrame(sample, INSTANCES).withColumn("model_id", F.lit("m"))


def test_training_follows_the_order(training, sample, rows):
    got = {f: w for _, f, w in rows(P.train_online(training, F.col("doc_id"), 0.1, shards=1))}
    assert got == pytest.approx(plain_descent([(y, x) for _, y, x in sample], 0.1))


def test_training_in_shards_averages(training, sample, rows):
    got = {f: w for _, f, w in rows(P.train_online(training, F.col("doc_id"), 0.1, shards=3))}
    shard = {d: int(hashlib.md5(d.encode()).hexdigest()[:8], 16) % 3 for d, *_ in sample}
    parts = [plain_descent([(y, x) for d, y, x in sample if shard[d] == s], 0.1) for s in range(3)]
    want = {f: sum(p.get(f, 0.0) for p in parts) / 3 for f in {f for p in parts for f in p}}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("copies", [1, 40])
def test_a_seed_gives_one_model(spark, sample, rows, copies):
    """Alone or among other seeds, for few and for many instances."""
    many = [(f"{d}-{k}", y, x) for k in range(copies) for d, y, x in sample]
    df = spark.createDataFrame(many, INSTANCES).withColumn("model_id", F.lit("m")).repartition(5)
    alone = {f: w for _, f, w in rows(P.train_shuffled(df, 1, 0.1, shards=3))}
    among = {f: w for s, f, w in rows(P.train_repeatedly(df, [2, 1, 3], 0.1, shards=3)) if s == 1}
    assert alone == among


def test_a_shard_without_instances_does_not_count(spark, rows):
    df = spark.createDataFrame([("m", "d", "spam", [1, 2, 1])], f"model_id string, {INSTANCES}")
    assert {f: w for _, f, w in rows(P.train_online(df, F.col("doc_id"), shards=50))} == pytest.approx({1: 0.002, 2: 0.001})


def test_shuffled_training_can_be_repeated(training, rows):
    first, again, other = (rows(P.train_shuffled(training, s, 0.1)) for s in (1, 1, 2))
    assert first == again != other
    runs = P.train_repeatedly(training, [1, 2], 0.1)
    assert {f: w for s, f, w in rows(runs) if s == 1} == {f: w for _, f, w in first}
    assert {f: w for s, f, w in rows(runs) if s == 2} == {f: w for _, f, w in other}


@pytest.mark.parametrize("hot_rows", [None, 5])
def test_batch_training(training, sample, rows, hot_rows):
    weights = dict.fromkeys({f for *_, x in sample for f in x}, 0.0)
    for _ in range(3):
        steps = dict.fromkeys(weights, 0.0)
        for _, label, features in sample:
            residual = (label == "spam") - 1 / (1 + math.exp(-sum(weights[f] for f in features)))
            for f in features:
                steps[f] += residual
        weights = {f: w + 0.05 * steps[f] for f, w in weights.items()}
    got = {f: w for _, f, w in rows(P.train_batch(training, 3, 0.05, hot_rows))}
    assert got == pytest.approx(weights)


def test_roc_gap(spark, rows):
    df = spark.createDataFrame([("spam", 0.9), ("spam", 0.4), ("ham", 0.4), ("ham", 0.1)], "label string, score double")
    assert rows(roc_gap(df)) == [(12.5,)]


def test_roc_gap_equals_counting_pairs(spark, rows):
    chance = random.Random(2)
    data = [(m, chance.choice(["spam", "ham"]), round(chance.gauss(0, 1), 1)) for m in ("a", "b") for _ in range(200)]
    got = dict(rows(roc_gap(spark.createDataFrame(data, "model_id string, label string, score double"), "model_id")))
    for m in got:
        spam = [s for k, y, s in data if k == m and y == "spam"]
        ham = [s for k, y, s in data if k == m and y == "ham"]
        area = sum((s > h) + (s == h) / 2 for s in spam for h in ham) / (len(spam) * len(ham))
        assert got[m] == pytest.approx(100 * (1 - area))


def test_files(spark, rows, model, tmp_path):
    (tmp_path / "i.txt").write_text("d1 spam 1 1 3\nd2 ham\n")
    got = read_instances(spark, str(tmp_path / "i.txt"))
    assert rows(got) == [("d1", "spam", [1, 1, 3]), ("d2", "ham", [])]
    assert got.schema == parse_instances(spark.createDataFrame([("x",)], "value string")).schema
    path = str(tmp_path / "model")
    for _ in range(2):  # the second write replaces the first
        write_text(model.select(F.format_string("(%d,%s)", "feature", F.col("weight").cast("string")).alias("value")), path)
    assert rows(read_model(spark, path, "x")) == rows(model)


def test_models_as_text_round_trip(spark, tmp_path):
    from tidemill.sources.sinks import write_models
    from tidemill.sources.text import read_models

    models = [("en", 1, 0.1), ("en", 2, -1e-300), ("a/b =c", 3, 1 / 3), ("7", 2**31 - 1, 5e300), (None, 4, 0.0)]
    df = spark.createDataFrame(models, "model_id string, feature int, weight double")
    for _ in range(2):  # the second write replaces the first
        write_models(df, str(tmp_path / "m"))
    assert sorted(map(tuple, read_models(spark, str(tmp_path / "m")).collect()), key=repr) == sorted(models, key=repr)
