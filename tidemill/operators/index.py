"""Inverted index: postings as flat rows, as bounded lists, and as gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import tokenize
from tidemill.operators.counts import unnested
from tidemill.runtime import attach, partitions_by_size

# Document numbers or list positions that share their upper bits form a block of at most
# 2 ** BLOCK_BITS entries of one term.
BLOCK_BITS = 16
# Bytes of documents whose postings are counted in one task.
TASK_BYTES = 4 << 20


def term_freq(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", unit: tuple[str, ...] = ()) -> DataFrame:
    """``term, doc_id, tf``: the flat postings, which all other forms come from.

    ``unit`` names further columns that make up what is indexed, as ``("line_no",)`` for lines.
    The texts are dealt by document over partitions of bounded size, which count their postings
    by themselves: a task holds those of its own texts, and the postings are not shuffled.
    """
    ids = [F.col(doc_id).alias("doc_id"), *unit]
    texts = docs.select(doc_id, *unit, text)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    dealt = texts.repartition(partitions_by_size(texts, TASK_BYTES, cores), doc_id)
    tokens = dealt.select(*ids, F.explode_outer(tokenize(F.col(text))).alias("term"))
    return unnested(tokens, "term").groupBy("term", "doc_id", *unit).agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(postings: DataFrame) -> DataFrame:
    """``term, df``."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def posting_lists(postings: DataFrame, block_bits: int = BLOCK_BITS, hot_rows: int | None = None) -> DataFrame:
    """``term, block, df, postings``: (doc_id, tf) sorted by document.

    The block of a document is ``doc_id >> block_bits`` for every term; blocks in order give
    the whole list. ``postings`` is read twice and should be stored.
    """
    # The frequency joins the flat rows, whose number says how hot a term is; no list is moved for it.
    sized = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    joined = attach(postings, sized, ["term"], ["doc_id"], "df", hot_rows=hot_rows)
    return joined.groupBy("term", F.shiftright("doc_id", block_bits).alias("block"), "df").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")
    ).select("term", "block", "df", "postings")


def flat_postings(lists: DataFrame) -> DataFrame:
    """``term, df, doc_id, tf`` of posting lists."""
    return lists.select("term", "df", F.explode("postings").alias("p")).select("term", "df", "p.doc_id", "p.tf")


def _carried(rows: DataFrame, order: str, block_bits: int, summary: list, carry: list) -> DataFrame:
    """Rows with their block of ``order`` and what the earlier blocks of their term add up to.

    Only one summary row per block passes the window over the whole term.
    """
    blocked = rows.withColumn("_block", F.shiftright(order, block_bits))
    before = Window.partitionBy("term").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    per_block = blocked.groupBy("term", "_block").agg(*summary)
    return blocked.join(per_block.select("term", "_block", *[c(before) for c in carry]), ["term", "_block"])


def gap_encode(postings: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``term, pos, gap, tf``: distance to the previous document of the list, from 0 for the first."""
    rows = _carried(
        postings,
        "doc_id",
        block_bits,
        [F.count(F.lit(1)).alias("_rows"), F.max("doc_id").alias("_last")],
        [
            lambda w: F.coalesce(F.sum("_rows").over(w), F.lit(0)).alias("_skipped"),
            lambda w: F.coalesce(F.max("_last").over(w), F.lit(0)).alias("_from"),
        ],
    )
    inside = Window.partitionBy("term", "_block").orderBy("doc_id")
    return rows.select(
        "term",
        (F.col("_skipped") + F.row_number().over(inside) - 1).alias("pos"),
        (F.col("doc_id") - F.coalesce(F.lag("doc_id").over(inside), "_from")).alias("gap"),
        "tf",
    )


def gap_decode(gaps: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``term, doc_id, tf`` from gaps: a running sum in list order."""
    rows = _carried(
        gaps,
        "pos",
        block_bits,
        [F.sum("gap").alias("_gaps")],
        [lambda w: F.coalesce(F.sum("_gaps").over(w), F.lit(0)).alias("_from")],
    )
    inside = Window.partitionBy("term", "_block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("term", (F.col("_from") + F.sum("gap").over(inside)).alias("doc_id"), "tf")


def doc_set(postings: DataFrame, term: str) -> DataFrame:
    """Documents of one term, each once."""
    return postings.filter(F.col("term") == term).select("doc_id").distinct()


def both(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents in both sets."""
    return left.intersect(right)


def either(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents in one of the sets."""
    return left.union(right).distinct()
