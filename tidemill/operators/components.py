"""Weakly connected components.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond", SoCC 2014). Each step links the neighbors of a node to the smallest of
them; after a number of rounds that grows with the logarithm of the size, every component is
a star around its smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import attach, cut_lineage


def _smallest(links: DataFrame) -> DataFrame:
    """``u, low, fan``: the smallest neighbor of every ``u`` and the number of its links.

    Kept, because it is read several times and is then the stored side of a join.
    """
    return cut_lineage(links.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("fan")))


def _with_smallest(links: DataFrame, low: DataFrame, hot_rows: int | None) -> DataFrame:
    """``u, v, low``: the smallest neighbor of ``u``, or ``u`` itself if smaller."""
    joined = attach(links, low, ["u"], ["v"], "fan", hot_rows=hot_rows)
    return joined.select("u", "v", F.least("u", "low").alias("low"))


def _mirrored(links: DataFrame) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    return links.select(F.explode(ends).alias("e")).select("e.u", "e.v")


def _large_star(both: DataFrame, low: DataFrame, hot_rows: int | None) -> DataFrame:
    """Every larger neighbor is linked to the smallest one."""
    larger = _with_smallest(both, low, hot_rows).filter(F.col("v") > F.col("u"))
    return larger.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame, hot_rows: int | None) -> DataFrame:
    """Every smaller neighbor, and the node itself, is linked to the smallest one."""
    low = _with_smallest(links, _smallest(links), hot_rows)
    ends = F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")), F.struct("u", F.col("low").alias("v")))
    linked = low.select(F.explode(ends).alias("e")).select("e.u", "e.v")
    return linked.filter(F.col("u") != F.col("v")).distinct()


def weak_components(nodes: DataFrame, edges: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``id, component``: the smallest id of the component, for every node.

    The links are stars once no node with a smaller neighbor has a second link; this is read off
    the smallest neighbors that the next step needs anyway.
    """
    apart = edges.filter(F.col("src") != F.col("dst"))
    links = cut_lineage(
        apart.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    )
    while True:
        both = _mirrored(links)
        low = _smallest(both)
        if low.filter((F.col("low") < F.col("u")) & (F.col("fan") > 1)).isEmpty():
            break
        links = cut_lineage(_small_star(cut_lineage(_large_star(both, low, hot_rows)), hot_rows))
    return nodes.join(links, F.col("id") == F.col("u"), "left").select(
        "id", F.coalesce("v", "id").alias("component")
    )


def component_count(labels: DataFrame) -> DataFrame:
    """One row: number of components."""
    return labels.filter(F.col("id") == F.col("component")).agg(F.count(F.lit(1)).alias("components"))
