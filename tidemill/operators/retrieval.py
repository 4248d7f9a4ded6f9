"""Boolean retrieval: postfix queries over AND and OR."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import snippet
from tidemill.operators.index import both, doc_set, either
from tidemill.sources.sinks import INDEX_BUCKETS, bucket_of

OPERATORS = ("AND", "OR")


def query_terms(query: str) -> list[str]:
    """Distinct words of a query, as written."""
    return list(dict.fromkeys(w for w in query.split() if w not in OPERATORS))


def _fold(query: str, word, conjunction, disjunction):
    stack: list = []
    for piece in query.split():
        if piece not in OPERATORS:
            stack.append(word(piece))
        elif len(stack) < 2:
            raise ValueError(f"{piece} lacks an operand: {query!r}")
        else:
            right, left = stack.pop(), stack.pop()
            stack.append((conjunction if piece == "AND" else disjunction)(left, right))
    if len(stack) != 1:
        raise ValueError(f"not one postfix expression: {query!r}")
    return stack[0]


def matches(query: str, has: dict[str, Column]) -> Column:
    """The query as one condition over a flag per word."""
    return _fold(query, has.__getitem__, lambda a, b: a & b, lambda a, b: a | b)


def _flags(postings: DataFrame, words: Sequence[str], ids: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """One row per document with a flag per word; flags are combined before the shuffle."""
    names = {w: f"_has{i}" for i, w in enumerate(words)}
    flags = [F.bool_or(F.col("term") == w).alias(n) for w, n in names.items()]
    found = postings.filter(F.col("term").isin(*words)).groupBy(*ids).agg(*flags)
    return found, {w: F.col(n) for w, n in names.items()}


def search(postings: DataFrame, query: str, ids: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``ids`` of the documents a query matches, by one pass over the postings of its words.

    The documents of an index of lines have the ids ``("doc_id", "line_no")``.
    """
    words = query_terms(query)
    matches(query, {w: F.lit(True) for w in words})  # a malformed query fails before any scan
    found, has = _flags(postings, words, ids)
    return found.filter(matches(query, has)).select(*ids)


def search_sets(postings: DataFrame, query: str) -> DataFrame:
    """The same by intersecting and uniting document sets."""
    return _fold(query, lambda w: doc_set(postings, w), both, either)


def search_many(postings: DataFrame, queries: Sequence[tuple[int, str]]) -> DataFrame:
    """``qid, doc_id`` of many queries, by one join of the postings with the words asked for.

    The plan is the same for one query and for thousands: queries are rows, not columns.
    """
    rows = []
    for qid, query in queries:
        words = query_terms(query)
        matches(query, {w: F.lit(True) for w in words})
        rows.append((qid, query.split(), words))
    asked = postings.sparkSession.createDataFrame(rows, "qid int, pieces array<string>, words array<string>")
    terms = asked.select("qid", F.explode("words").alias("term"))
    have = postings.join(terms, "term").groupBy("qid", "doc_id").agg(F.collect_set("term").alias("have"))
    return have.join(asked, "qid").filter(holds(F.col("pieces"), F.col("have"))).select("qid", "doc_id")


def holds(pieces: Column, have: Column) -> Column:
    """Value of a postfix query for a set of words: a stack of truth values, folded over the pieces."""

    def step(stack: Column, piece: Column) -> Column:
        left, right = F.element_at(stack, -2), F.element_at(stack, -1)
        rest = F.slice(stack, 1, F.size(stack) - 2)
        return (
            F.when(piece == "AND", F.concat(rest, F.array(left & right)))
            .when(piece == "OR", F.concat(rest, F.array(left | right)))
            .otherwise(F.concat(stack, F.array(F.array_contains(have, piece))))
        )

    return F.aggregate(pieces, F.array().cast("array<boolean>"), step)[0]


def stored_postings(spark: SparkSession, path: str, words: Sequence[str], buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Postings of the given words from a stored index; other buckets are not listed."""
    wanted = reduce(lambda a, b: a | b, [(F.col("bucket") == bucket_of(F.lit(w), buckets)) & (F.col("term") == w) for w in words])
    return spark.read.parquet(path).filter(wanted).drop("bucket")


def hydrate(found: DataFrame, docs: DataFrame, ids: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """The found rows with the text of their document, shortened for display."""
    return found.join(docs.select(*ids, snippet(F.col(text)).alias("snippet")), list(ids))


def show_results(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, snippet`` in document order."""
    return hydrate(found, docs).orderBy("doc_id")
