"""Adjacent token pairs and their relative frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import tokenize
from tidemill.operators.counts import unnested
from tidemill.operators.stripes import STRIPE_BLOCKS, block_of, cut, gather
from tidemill.runtime import attach, scratch_path
from tidemill.sources.sinks import write_table


def bigrams(lines: DataFrame) -> DataFrame:
    """``a, b`` for every two neighboring tokens of a line."""
    tokens = lines.select(tokenize(F.col("line")).alias("t"))
    rest = F.greatest(F.size("t") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("t", 1, rest).alias("a"), F.slice("t", 2, rest).alias("b"))
    exploded = tokens.select(F.explode_outer(pairs).alias("p")).select("p.a", "p.b")
    # Both tests, so that later joins on ``a`` add no filter of their own and share this plan.
    return unnested(unnested(exploded, "a"), "b")


def bigram_counts(lines: DataFrame) -> DataFrame:
    """``a, b, n``."""
    return bigrams(lines).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def _kept(counts: DataFrame) -> DataFrame:
    """The counts as a table. Both uses below read it; in one plan, every use would count again."""
    return write_table(counts, scratch_path(counts.sparkSession, "bigrams"))


def relative_frequencies(counts: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``a, b, value``: share of ``b`` among the successors of ``a``; ``(a, *)`` holds the total of ``a``.

    The totals come from an aggregate joined back, not from a window over ``a``: a window
    would bring all successors of a frequent word into one task.
    """
    kept = _kept(counts)
    marginals = kept.groupBy("a").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("fan"))
    joined = attach(kept, marginals, ["a"], ["b"], "fan", hot_rows=hot_rows)
    shares = joined.select("a", "b", (F.col("n") / F.col("total")).alias("value"))
    return shares.unionByName(
        marginals.select("a", F.lit("*").alias("b"), F.col("total").cast("double").alias("value"))
    )


def relative_frequency_stripes(counts: DataFrame, blocks: int = STRIPE_BLOCKS, hot_rows: int | None = None) -> DataFrame:
    """``a, block, part, stripe``: the shares of all successors of ``a`` as maps.

    The total of ``a`` is given to each of its blocks, so it meets the rows where their maps are made
    and these are shuffled once. The blocks spread a frequent word whatever ``hot_rows`` says.
    """
    kept = _kept(counts)
    sums = kept.groupBy("a", block_of("b", blocks).alias("block")).agg(F.sum("n").alias("sum"))
    totals = sums.select("a", "block", F.sum("sum").over(Window.partitionBy("a")).alias("total"))
    joined = cut(kept, "a", "b", blocks).join(totals, ["a", "block"])
    return gather(joined.select("a", "block", "part", "b", (F.col("n") / F.col("total")).alias("f")), "a", "b", "f")
