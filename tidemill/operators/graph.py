"""Graphs as ``nodes(id)`` and ``edges(src, dst)``; repeated edges count repeatedly."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nodes_of(adjacency: DataFrame) -> DataFrame:
    """``id`` of every adjacency record."""
    return adjacency.select("id")


def edges_of(adjacency: DataFrame) -> DataFrame:
    """``src, dst`` of adjacency records."""
    return adjacency.select(F.col("id").alias("src"), F.explode("neighbors").alias("dst"))


def graph_stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: number of nodes, of edges, and of nodes with an out-link."""
    marks = nodes.select("id", F.lit(1).alias("node"), F.lit(0).alias("out")).unionByName(
        edges.select(F.col("src").alias("id"), F.lit(0).alias("node"), F.lit(1).alias("out"))
    )
    per_id = marks.groupBy("id").agg(F.sum("node").alias("node"), F.sum("out").alias("out"))
    return per_id.agg(
        F.sum("node").alias("nodes"),
        F.sum("out").alias("edges"),
        F.sum(F.when((F.col("node") > 0) & (F.col("out") > 0), 1).otherwise(0)).alias("active_nodes"),
    )


def partition_graph(df: DataFrame, parts: int, by_range: bool = False, key: str = "id") -> DataFrame:
    """The same rows in ``parts`` partitions, by hash or by range of the id."""
    return df.repartitionByRange(parts, key) if by_range else df.repartition(parts, key)


def missing_structure(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``dst, n``: targets without a node record and the number of edges to them."""
    targets = edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    return targets.join(nodes.select(F.col("id").alias("dst")), "dst", "left_anti")


def duplicate_structure(nodes: DataFrame) -> DataFrame:
    """``id, n``: ids with more than one node record."""
    return nodes.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def require_unique(nodes: DataFrame) -> DataFrame:
    """``nodes``, or an error naming an id that has two records."""
    twice = duplicate_structure(nodes).first()
    if twice is not None:
        raise ValueError(f"{twice['n']} records for node {twice['id']}")
    return nodes


def require_nodes(nodes: DataFrame, ids: list[int]) -> None:
    """An error if one of ``ids`` has no node record."""
    known = {r["id"] for r in nodes.filter(F.col("id").isin(*ids)).select("id").distinct().collect()}
    absent = [i for i in ids if i not in known]
    if absent:
        raise ValueError(f"not in the graph: {absent}")


def readable(nodes: DataFrame, edges: DataFrame, shown: int = 10) -> DataFrame:
    """``id, ranks`` nodes as text lines with their first ``shown`` neighbors.

    Only the neighbors shown are gathered; the rest is a count.
    """
    order = Window.partitionBy("src").orderBy("dst")
    first = (
        edges.withColumn("_row", F.row_number().over(order))
        .filter(F.col("_row") <= shown)
        .groupBy(F.col("src").alias("id"))
        .agg(F.sort_array(F.collect_list("dst")).alias("first"))
    )
    degree = edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    full = nodes.join(first, "id", "left").join(degree, "id", "left")
    listed = F.coalesce(F.array_join(F.col("first").cast("array<string>"), ", "), F.lit(""))
    end = F.when(F.col("degree") > shown, F.format_string(" ... (%d more) ]", F.col("degree") - shown)).otherwise("]")
    ranks = F.array_join(F.col("ranks").cast("array<string>"), ", ")
    return full.select(F.format_string("{%d [%s] [%s%s}", "id", ranks, listed, end).alias("value"))
