"""Rows of (key, other, value) gathered into maps of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STRIPE_BLOCKS = 16
# Entries of one map at most, whatever the size of the key.
MAP_ENTRIES = 10_000


def block_of(other: str, blocks: int = STRIPE_BLOCKS) -> Column:
    """The block of an entry, the same at every size."""
    return F.pmod(F.xxhash64(other), F.lit(blocks)).cast("int")


def cut(rows: DataFrame, key: str, other: str, blocks: int = STRIPE_BLOCKS, entries: int = MAP_ENTRIES) -> DataFrame:
    """``rows`` with the ``block`` and ``part`` of the map they go to, partitioned by (key, block)."""
    placed = rows.withColumn("block", block_of(other, blocks))
    number = F.row_number().over(Window.partitionBy(key, "block").orderBy(other))
    return placed.withColumn("part", F.floor((number - 1) / entries).cast("int"))


def gather(placed: DataFrame, key: str, other: str, value: str) -> DataFrame:
    """The maps of rows that ``cut`` has placed, made where the rows are."""
    return placed.groupBy(key, "block", "part").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(other, value)))).alias("stripe")
    )


def stripes(
    rows: DataFrame, key: str, other: str, value: str, blocks: int = STRIPE_BLOCKS, entries: int = MAP_ENTRIES
) -> DataFrame:
    """``key, block, part, stripe``: other -> value, sorted, in maps of at most ``entries``.

    The block of an entry is ``pmod(xxhash64(other), blocks)`` at every size; it spreads a
    large key over tasks. Inside a block the entries are sorted once and cut into parts, so a
    task never gathers more than one map.
    """
    return gather(cut(rows, key, other, blocks, entries), key, other, value)


def unroll(striped: DataFrame, key: str, other: str, value: str) -> DataFrame:
    """The flat rows of ``stripes``."""
    return striped.select(key, F.explode("stripe").alias(other, value))
