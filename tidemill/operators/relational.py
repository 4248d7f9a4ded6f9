"""The relational building blocks of the reports, one function each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import in_period


def where(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition)


def project(df: DataFrame, *columns: str | Column) -> DataFrame:
    return df.select(*columns)


def equi_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join of two large sides; adaptive execution splits skewed partitions."""
    return left.join(right, F.col(left_key) == F.col(right_key))


def keep_matching(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` with at least one match, each once."""
    return left.join(right, F.col(left_key) == F.col(right_key), "left_semi")


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Inner join with a dimension; Spark broadcasts it below its byte threshold."""
    return df.join(dim, F.col(key) == F.col(dim_key))


def lookup_or(df: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str, missing: str = "?") -> DataFrame:
    """Left join with a dimension; ``missing`` stands in for an absent name."""
    joined = df.join(dim.select(dim_key, name), F.col(key) == F.col(dim_key), "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(missing)))


def keep_members(df: DataFrame, members: DataFrame, key: str, member_key: str) -> DataFrame:
    """Rows whose key is one of ``members``; Spark broadcasts them below its byte threshold."""
    return df.join(members.select(member_key), F.col(key) == F.col(member_key), "left_semi")


def group_sum(df: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    """Sum per group, combined before the shuffle."""
    return df.groupBy(*keys).agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])


def group_avg(df: DataFrame, keys: list[str], **measures: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(expr).alias(name) for name, expr in measures.items()])


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def count_in_periods(df: DataFrame, column: str, dates: list[str]) -> DataFrame:
    """``date, n``: rows at each date at its own granularity, in one scan."""
    counts = df.agg(*[F.count_if(in_period(df, column, date)).alias(date) for date in dates])
    pairs = F.array(*[F.struct(F.lit(date).alias("date"), F.col(f"`{date}`").alias("n")) for date in dates])
    return counts.select(F.inline(pairs))


def ordered(df: DataFrame, *order: Column | str) -> DataFrame:
    return df.orderBy(*order)


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a total order; every task keeps only ``n``."""
    return df.orderBy(*order).limit(n)
