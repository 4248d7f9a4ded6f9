"""Distinct counts and quantiles from sketches that are stored and merged later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of a HyperLogLog sketch of 2 ** LOG_BUCKETS buckets; its relative standard error is
# 1.04 / 2 ** (LOG_BUCKETS / 2), for 12 some 1.6 per cent.
LOG_BUCKETS = 12
# Of a KLL sketch; with 200 a quantile's rank is off by at most 1.65 per cent, with 99 per cent confidence.
KLL_K = 200


def build(rows: DataFrame, by: list[str], distinct: str, values: Column | str) -> DataFrame:
    """``by, hll, kll``: one sketch each of the distinct values and of the distribution."""
    values = F.col(values) if isinstance(values, str) else values
    return rows.groupBy(*by).agg(
        F.hll_sketch_agg(distinct, LOG_BUCKETS).alias("hll"), F.kll_sketch_agg_double(values.cast("double"), KLL_K).alias("kll")
    )


def store(sketches: DataFrame, path: str, by: str) -> None:
    """Replace the partitions of the table at ``path`` that ``sketches`` have rows for."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge(sketches: DataFrame, by: list[str | Column]) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones; no other data is read."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("hll").alias("hll"), F.kll_merge_agg_double("kll").alias("kll"))


def estimates(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """The columns without sketches, ``n, n_distinct, quantiles``.

    A sketch that one task filled by itself also knows the order of its updates and gives another
    estimate than one of the same buckets that was merged. The union with itself forgets that
    order, so equal buckets give equal estimates.
    """
    kept = [c for c in sketches.columns if c not in ("hll", "kll")]
    return sketches.select(
        *kept,
        F.kll_sketch_get_n_double("kll").alias("n"),
        F.hll_sketch_estimate(F.hll_union("hll", "hll")).alias("n_distinct"),
        F.array(*[F.kll_sketch_get_quantile_double("kll", F.lit(float(s))) for s in shares]).alias("quantiles"),
    )
