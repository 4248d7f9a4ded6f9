import re

import pytest
from pyspark.sql import functions as F

from tidemill import runtime


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot_rows, max_hot", [(1, 1000), (1, 1), (50, 1000), (10_000, 1000)])
def test_attach_equals_a_join(spark, rows, monkeypatch, how, hot_rows, max_hot):
    monkeypatch.setattr(runtime, "MAX_HOT_KEYS", max_hot)
    big = spark.range(300).select((F.when(F.col("id") < 100, 0).otherwise(F.col("id") % 7)).alias("k"), "id")
    dim = big.filter("k < 5").groupBy("k").agg(F.count("*").alias("fan"), F.sum("id").alias("total"))
    got = runtime.attach(big, dim, ["k"], ["id"], "fan", how, hot_rows)
    assert rows(got.fillna(-1)) == rows(big.join(dim, "k", how).fillna(-1))


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("aggregated", [True, False])
def test_hot_rows_leave_their_partition(spark, tmp_path, adaptive, aggregated):
    """One of many keys owns most rows; its rows spread whatever the dimension comes from."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": adaptive, "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        big = spark.range(40_000).select(F.when(F.col("id") % 4 > 0, 7).otherwise(F.col("id") % 1000).alias("k"), "id")
        dim = big.groupBy("k").agg(F.count("*").alias("fan"), F.max("id").alias("v"))
        if not aggregated:
            dim.write.parquet(str(tmp_path / "dim"))
            dim = spark.read.parquet(str(tmp_path / "dim"))
        got = runtime.attach(big, dim, ["k"], ["id"], "fan", "inner", 10_000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        plain = [r["count"] for r in big.join(dim, "k").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert re.search(r"SortMergeJoin \[k#\d+L?, _salt#\d+L?\]", plan)
    assert sum(sizes) == 40_000 and max(sizes) < 6_000 and (aggregated or adaptive == "true" or max(plain) > 30_000)


def test_small_means_a_number_of_rows(spark):
    assert runtime.is_small(spark.range(20), 20) and not runtime.is_small(spark.range(20), 19)


def test_spread_input_only_for_small_scans(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "RepartitionByExpression" in runtime.spread_input(df, "doc_id")._jdf.queryExecution().toString()
    monkeypatch.setattr(runtime, "_setting_bytes", lambda *_: 1)
    assert runtime.spread_input(df, "doc_id") is df


def test_checkpoints_go_to_the_named_folder(spark):
    assert runtime.checkpoint_dir(spark) == spark.conf.get(runtime.CHECKPOINT_SETTING)
    kept = runtime.cut_lineage(spark.range(5))
    assert "Scan ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == 5


def test_kept_partitioning_saves_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = runtime.keep_partitioned(spark.range(1000).select((F.col("id") % 50).alias("k"), "id"), "k")
        joined = spark.range(50).select(F.col("id").alias("k")).join(kept, "k")
        assert joined.count() == 1000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1


def test_kept_rows_are_computed_in_their_own_session(spark):
    """The layout alone is fixed in advance; what comes before it runs adaptively, and no setting changes."""
    seen = []

    joined = spark.range(100).join(spark.range(50).withColumn("v", F.lit(1)), "id")
    kept = runtime.keep_partitioned(joined, "id", then=lambda rows: (seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled")), rows)[1])
    assert kept.count() == 50 and seen == ["false"] and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()
