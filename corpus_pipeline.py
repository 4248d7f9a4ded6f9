"""Documents to training sequences: five stages, each one of the operators in ``tidemill.llm``.

Every stage takes any table with the columns of documents, also an empty one, and all but the
last return the same columns; extra columns keep their values whatever their names. Texts that
are null or have no letter leave in the first stage. A null lang or source is an ordinary value
that teaches nothing and conflicts with nothing. Rows with a null ``doc_id`` pass line and
near-duplicate removal as they are. Rows of one ``doc_id`` are one document there: they lose the
same lines, and stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.decontam import remove_contamination
from tidemill.llm.langid import identify, learn
from tidemill.llm.linededup import drop_repeated_lines
from tidemill.llm.neardup import near_duplicates
from tidemill.llm.packing import pack_documents
from tidemill.llm.shared import stored
from tidemill.sources.tpch import read_table

# Language identification and packing are not expressible in SQL; tests hold the stages
# against brute force.
ORACLE_SQL = None


def _beside(docs: DataFrame, operator, condition=None) -> DataFrame:
    """The columns of ``docs`` after an operator that adds columns of its own.

    Only the columns of documents go through the operator under their own names, so an extra
    column that happens to have the name of a result keeps its values.
    """
    known = ("doc_id", "text", "lang", "source", "n_chars")
    names = [c if c.lower() in known else f"__extra_{i}" for i, c in enumerate(docs.columns)]
    made = operator(docs.toDF(*names))
    made = made if condition is None else made.filter(condition)
    return made.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear."""
    model = learn(docs)
    return _beside(docs, lambda rows: identify(rows, model), ~F.col("rejected"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that an earlier document has."""
    return _counted(_beside(docs, drop_repeated_lines))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    # Merged, so that it is the same join at every size.
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct().hint("merge")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly benchmark go."""
    items = read_table(spark, sf_dir, "benchmark")
    return _counted(_beside(docs, lambda rows: remove_contamination(rows, items)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document in the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one returns is stored and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
