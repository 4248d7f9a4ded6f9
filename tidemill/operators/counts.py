"""Word, prefix and line counts. Every count is combined inside the tasks before its shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import distinct_tokens, first_pieces, has_token, prefix2, tokenize


def unnested(exploded: DataFrame, column: str) -> DataFrame:
    """Rows of an outer explode without those of empty arrays.

    A plain explode makes the optimizer test the size of the array below it, and that would
    compute the tokens twice.
    """
    return exploded.filter(F.col(column).isNotNull())


def words(lines: DataFrame) -> DataFrame:
    """Every token of every line as ``term``."""
    return unnested(lines.select(F.explode_outer(tokenize(F.col("line"))).alias("term")), "term")


def word_count(lines: DataFrame) -> DataFrame:
    """``term, n``."""
    return words(lines).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def prefixes(lines: DataFrame) -> DataFrame:
    """The two-letter prefix of every token that has two letters."""
    return words(lines).filter(F.length("term") >= 2).select(prefix2(F.col("term")).alias("prefix"))


def prefix_count(lines: DataFrame) -> DataFrame:
    """``prefix, n``."""
    return prefixes(lines).groupBy("prefix").agg(F.count(F.lit(1)).alias("n"))


def top_counts(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest of a count table, ties by key."""
    key = counts.columns[0]
    return counts.orderBy(F.desc("n"), key).limit(k)


def count_of(counts: DataFrame, key: str) -> DataFrame:
    """The row of one key; the filter moves below the aggregation."""
    return counts.filter(F.col(counts.columns[0]) == key)


def nonempty_line_count(lines: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """One row: number of lines with at least one token, among the first ``max_tokens`` pieces."""
    line = F.col("line") if max_tokens is None else first_pieces(F.col("line"), max_tokens)
    return lines.filter(has_token(line)).agg(F.count(F.lit(1)).alias("n"))


def line_terms(lines: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """Each distinct token of each line, with ``width``, the number of them in its line."""
    distinct = lines.select("doc_id", "line_no", distinct_tokens(F.col("line"), max_tokens).alias("u"))
    return unnested(
        distinct.select("doc_id", "line_no", F.size("u").alias("width"), F.explode_outer("u").alias("term")), "term"
    )


def line_freq(lines: DataFrame, max_tokens: int | None = None) -> DataFrame:
    """``term, n``: number of lines that contain the term."""
    return line_terms(lines, max_tokens).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
