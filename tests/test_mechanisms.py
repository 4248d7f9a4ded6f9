import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.operators import properties, sketches
from tidemill.operators.asof import asof_join
from tidemill.operators.cube import grouped_totals
from tidemill.operators.overlap import overlapping_pairs
from tidemill.operators.reconcile import outer_join
from tidemill.operators.runs import register_label_runs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def asof_brute(left, right):
    out = []
    for i, k, t in left:
        met = [(rt, tie is not None, tie or 0, v) for rk, rt, tie, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        best = max(met) if met else None
        out.append((i, k, t, *((k, best[0], best[2] if best[1] else None, best[3]) if best else (None,) * 4)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("keys", [1, 3, 40])
def test_asof_against_brute_force(spark, keys, batch):
    rng = random.Random(keys)
    key = lambda: rng.choice([None, 0, 0, *range(keys)])
    time = lambda: rng.choice([None, *range(0, 60)])
    left = [(i, key(), time()) for i in range(150)]
    right = [(key(), time(), tie, f"v{tie}") for tie in [None, *range(80)]]
    # Rows of one key, time and tie are told apart by nothing; keep one.
    right = list({(k, t): (k, t, tie, v) for k, t, tie, v in right}.values()) + [(0, 5, 1000, "late"), (0, 5, 999, "less")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = asof_join(spark.createDataFrame(left, "id int, k int, t int").repartition(3), spark.createDataFrame(right, "k int, t int, tie int, v string"), "k", "t", "tie")
        assert got.columns == ["id", "k", "t", "last_k", "last_t", "last_tie", "last_v"]
        assert sorted_rows(got) == asof_brute(left, right)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_asof_splits_a_frequent_key(spark, tmp_path):
    """One key over all partitions; a single right row at the begin reaches the last one."""
    left = spark.range(4000).select("id", F.lit(1).alias("k"), (F.col("id") + 10).alias("t"))
    right = spark.createDataFrame([(1, 0, 0)], "k int, t bigint, tie int")
    got = asof_join(left, right, "k", "t", "tie")
    assert got.filter("last_t = 0").count() == 4000
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 2500


def test_asof_of_empty_sides(spark):
    left = spark.createDataFrame([(1, 1, 1)], "id int, k int, t int")
    right = spark.createDataFrame([], "k int, t int, tie int")
    assert sorted_rows(asof_join(left, right, "k", "t", "tie")) == [(1, 1, 1, None, None, None)]
    assert asof_join(left.limit(0), right, "k", "t", "tie").count() == 0


@pytest.mark.parametrize("width", [1, 8, 32])
def test_overlaps_against_brute_force(spark, width):
    rng = random.Random(width)
    rows = []
    for i in range(150):
        b = rng.randrange(-200, 400)
        rows.append((rng.choice([None, 0, 0, 1]), rng.choice([None, *[i] * 30]), b, b + rng.choice([-3, 0, 1, 7, 8, 31, 32, 33, 500, 100_000])))
    rows += [(0, 900, None, 5), (0, 901, 5, None), (0, 902, -(10**12), 10**12)]
    got = overlapping_pairs(spark.createDataFrame(rows, "k int, id int, b bigint, e bigint"), "k", "id", "b", "e", width)
    good = [r for r in rows if None not in r and r[2] <= r[3]]
    want = sorted((k, i, j) for k, i, b, e in good for l, j, c, d in good if k == l and i < j and b <= d and c <= e)
    assert sorted(map(tuple, got.collect())) == want


def test_overlaps_need_no_nested_loop(spark):
    rows = spark.range(100).selectExpr("1 AS k", "id", "id AS b", "id + 5 AS e")
    text = plan(overlapping_pairs(rows, "k", "id", "b", "e", 8))
    assert "NestedLoop" not in text and "Cartesian" not in text
    # A long interval takes two rows a level, not one per bin.
    one = spark.createDataFrame([(1, 1, 0, 10**15), (1, 2, 3, 3)], "k int, id int, b bigint, e bigint")
    assert sorted_rows(overlapping_pairs(one, "k", "id", "b", "e", 1)) == [(1, 1, 2)]


MANY = [(None, "n1"), (None, "n2"), (1, "a"), (1, "b"), (1, "c"), (2, "d"), (5, "e"), (5, "f")]
ONE = [(None, "x"), (1, "one"), (3, "three"), (5, "five"), (None, "y")]


@pytest.mark.parametrize("least, most", [(1, 1000), (2, 1), (3, 1000), (100, 1000)])
@pytest.mark.parametrize("how", ["full", "right"])
def test_outer_joins_equal_the_plain_ones(spark, how, least, most):
    many, one = spark.createDataFrame(MANY, "k int, m string"), spark.createDataFrame(ONE, "k int, o string")
    want = sorted_rows(many.join(one, "k", how).select("k", "m", "o"))
    assert sorted_rows(outer_join(many, one, "k", how, least, most).select("k", "m", "o")) == want
    assert sorted_rows(outer_join(many.limit(0), one, "k", how, least, most).select("k", "m", "o")) == sorted_rows(many.limit(0).join(one, "k", how).select("k", "m", "o"))


def test_a_frequent_key_and_missing_keys_stay_spread(spark):
    """In a plain full join one task gets all rows of the key; here no partition has more than its share."""
    many = spark.range(0, 40_000, 1, 8).selectExpr("CASE WHEN id % 4 < 2 THEN 7 WHEN id % 4 = 2 THEN NULL ELSE id END AS k", "id")
    one = spark.range(0, 20_000, 1, 8).selectExpr("id AS k", "id AS o")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        plain, spread = many.join(one, "k", "full"), outer_join(many, one, "k", "full", 1000)
        assert sizes(plain) >= 20_000 and sizes(spread) < 12_000
        assert spread.count() == plain.count() and spread.filter("o IS NULL").count() == plain.filter("o IS NULL").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_outer_join_names_its_ways(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        outer_join(df, df, "id", "left")


@pytest.mark.parametrize("how", ["cube", "rollup", [["a", "b"], ["b"], []]])
def test_groupings(spark, how):
    rng = random.Random(1)
    rows = [(rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), rng.randrange(100)) for _ in range(200)]
    got = grouped_totals(spark.createDataFrame(rows, "a string, b int, v bigint"), ["a", "b"], {"total": F.col("v")}, how)
    sets = {"cube": [("a", "b"), ("a",), ("b",), ()], "rollup": [("a", "b"), ("a",), ()]}.get(how if isinstance(how, str) else None) or [tuple(s) for s in how]
    want = Counter()
    n = Counter()
    for s in sets:
        for a, b, v in rows:
            key = (a if "a" in s else None, b if "b" in s else None, ("a" not in s) * 2 + ("b" not in s))
            want[key] += v
            n[key] += 1
    assert {tuple(r)[:3]: (r.n, r.total) for r in got.select("a", "b", "grouping", "n", "total").collect()} == {k: (n[k], want[k]) for k in want}
    assert got.count() == len(want)


def test_groupings_expand_after_the_first_sum(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS a", "id % 5 AS b", "id AS v")
    lines = plan(grouped_totals(rows, ["a", "b"], {"total": F.col("v")})).splitlines()
    at = next(i for i, line in enumerate(lines) if "Expand" in line)
    assert any("HashAggregate" in line for line in lines[at:]) and any("Exchange" in line for line in lines[at:])


def test_sketches_merge_to_the_whole_within_their_error(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("id % 20 AS day", "pmod(xxhash64(id), 9000) AS user", "cast(pmod(xxhash64(id, 1), 100000) as double) AS v")
    path = str(tmp_path / "s")
    for part in ("day < 10", "day >= 10", "day = 3"):  # the last one replaces a partition by itself
        sketches.store(sketches.build(rows.filter(part), ["day"], "user", "v"), path, "day")
    daily = spark.read.parquet(path)
    assert daily.count() == 20
    merged = sketches.estimates(sketches.merge(daily, []), [0.1, 0.5, 0.99]).first()
    whole = sketches.estimates(sketches.merge(sketches.build(rows, [], "user", "v"), []), [0.5]).first()
    exact = rows.select("user").distinct().count()
    assert merged.n == whole.n == 60_000 and merged.n_distinct == whole.n_distinct
    assert abs(merged.n_distinct - exact) <= 3 * 1.04 / 2 ** (sketches.LOG_BUCKETS / 2) * exact
    for share, value in zip([0.1, 0.5, 0.99], merged.quantiles):
        assert abs(rows.filter(F.col("v") <= value).count() / 60_000 - share) < 0.02


@pytest.mark.parametrize("users", [3, 300, 9_000, 90_000])
def test_distinct_estimate_does_not_depend_on_how_the_sketch_was_made(spark, users):
    rows = spark.range(3 * users).selectExpr("id % 7 AS day", f"id % {users} AS user", "cast(id as double) AS v")
    alone = sketches.estimates(sketches.build(rows.coalesce(1), [], "user", "v"), [0.5]).first()
    once = sketches.estimates(sketches.merge(sketches.build(rows.coalesce(1), [], "user", "v"), []), [0.5]).first()
    daily = sketches.estimates(sketches.merge(sketches.build(rows, ["day"], "user", "v"), []), [0.5]).first()
    assert alone.n_distinct == once.n_distinct == daily.n_distinct
    assert abs(daily.n_distinct - users) <= 4 * 1.04 / 2 ** (sketches.LOG_BUCKETS / 2) * users


def test_variants_and_broken_rows(spark):
    texts = ['{"k": 1, "s": "x", "o": {"p": [1, 2]}}', '{"k": "no number"}', '{"k": 2.5}', "[1, 2]", "7", "{", '{"k": 1', "", None, '{"other": true}']
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, props string")
    good, broken = properties.parsed(rows, "props")
    assert sorted(r.id for r in broken.collect()) == [5, 6, 7] and [r.props for r in broken.orderBy("id").collect()] == ["{", '{"k": 1', ""]
    read = properties.typed(good, "props", {"k": ("$.k", "bigint"), "second": ("$.o.p[1]", "int"), "s": ("$.s", "string")})
    got = {r.id: (r.k, r.second, r.s) for r in read.select("id", "k", "second", "s").collect()}
    assert set(got) == {0, 1, 2, 3, 4, 8, 9} and got[0] == (1, 2, "x") and got[1] == (None, None, None) and got[8] == got[9] == (None, None, None)
    named = properties.schema(good.filter("id IN (0, 9)"), "props")
    assert re.fullmatch(r"OBJECT<k: BIGINT, o: OBJECT<p: ARRAY<BIGINT>>, other: BOOLEAN, s: STRING>", named)
    assert properties.schema(good.filter("id = 8"), "props") == "VOID"


@pytest.mark.parametrize("batch", [2, 10_000])
def test_label_runs_over_batches(spark, batch):
    rng = random.Random(batch)
    rows = [(rng.choice([1, 1, 2, None]), t, rng.choice(["a", "b", None])) for t in range(120)]
    register_label_runs(spark, "test_runs", ("k", "int"), ("kind", "string"), ("t", "int"))
    spark.createDataFrame(rows, "k int, t int, kind string").createOrReplaceTempView("run_rows")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = spark.sql("SELECT * FROM test_runs(TABLE(run_rows) PARTITION BY k ORDER BY t)").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = []
    for key in (1, 2, None):
        mine, number = [(t, kind) for k, t, kind in rows if k == key], 0
        for i, (t, kind) in enumerate(mine):
            if i == 0 or mine[i - 1][1] != kind:
                number += 1
                want.append([key, number, kind, t, t, 0])
            want[-1][4] = t
            want[-1][5] += 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
