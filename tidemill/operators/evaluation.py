"""Evaluation of scores against labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.spam import is_spam
from tidemill.runtime import cut_lineage


def roc_gap(scored: DataFrame, by: str | None = None) -> DataFrame:
    """100 x (1 - area under the ROC curve), ties counted half, per value of ``by`` if given.

    The area is the share of (spam, ham) pairs in which spam scores higher. Distinct scores are
    range-partitioned; running counts are taken inside each range, and one row per range
    carries the totals of the ranges below.
    """
    group = F.lit(0) if by is None else F.col(by)
    spam = is_spam(F.col("label"))
    counts = scored.groupBy(group.alias("_by"), "score").agg(F.sum(spam).alias("spam"), F.sum(1 - spam).alias("ham"))
    # Kept, so that both uses below see the same ranges.
    ranged = cut_lineage(counts.repartitionByRange("_by", "score").withColumn("_range", F.spark_partition_id()))
    lower = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    below = (
        ranged.groupBy("_by", "_range")
        .agg(F.sum("ham").alias("_ham"))
        .select("_by", "_range", F.coalesce(F.sum("_ham").over(lower), F.lit(0)).alias("_below"))
    )
    inside = Window.partitionBy("_by", "_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.join(below, ["_by", "_range"]).select(
        "_by",
        "spam",
        "ham",
        (F.col("_below") + F.coalesce(F.sum("ham").over(inside), F.lit(0))).alias("lower"),
    )
    wins = F.sum((F.col("spam") * (F.col("lower") + F.col("ham") / 2)).cast("double"))
    pairs = F.sum("spam").cast("double") * F.sum("ham").cast("double")
    result = placed.groupBy("_by").agg((100 * (1 - wins / pairs)).alias("roc_gap"))
    return result.select("roc_gap") if by is None else result.withColumnRenamed("_by", by)
