"""Totals over several groupings at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grouped_totals(rows: DataFrame, dims: list[str], sums: dict[str, Column], how: str | list[list[str]] = "cube") -> DataFrame:
    """``dims, grouping, n`` and the sums, for every grouping of ``cube``, ``rollup`` or a list of sets.

    ``grouping`` has a bit per dimension, the first one highest; it is set where the dimension
    is summed over, which tells such a null from a null of the data. Rows are summed once, at
    the finest grain; only that result is copied per grouping and summed again.
    """
    finest = rows.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in sums.items()])
    if how == "cube":
        grouped = finest.cube(*dims)
    elif how == "rollup":
        grouped = finest.rollup(*dims)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in group] for group in how], *[F.col(c) for c in dims])
    return grouped.agg(F.grouping_id().cast("bigint").alias("grouping"), *[F.sum(c).alias(c) for c in ("n", *sums)])
