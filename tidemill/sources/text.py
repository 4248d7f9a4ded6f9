"""Line-oriented inputs: text collections, adjacency lists, labelled instances, models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.functions.text import LINE_BREAK
from tidemill.runtime import cut_lineage, spread_input


def lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line of each document: ``doc_id, line_no, line``, counted from 0."""
    return spread_input(docs.select(doc_id, text), doc_id).select(
        F.col(doc_id).alias("doc_id"), F.posexplode(F.split(text, LINE_BREAK)).alias("line_no", "line")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, path, line_no, line``: one row per line of the files under ``path``.

    ``line_no`` counts the lines of a file from 0, and ``doc_id`` is a hash of path and number, so
    neither depends on how the files are split. The lines are kept once: a split knows the place
    of its lines only relative to its own first one, and the counts of the splits before it make
    that absolute.
    """
    place = ["path", "split"]
    read = cut_lineage(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    ))
    splits = read.groupBy(*place).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    begins = splits.select(*place, (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    numbered = read.join(begins, place).withColumn("line_no", F.col("at") + F.col("shift"))
    return numbered.select(F.xxhash64("path", "line_no").alias("doc_id"), "path", "line_no", "line")


def parse_adjacency(raw: DataFrame, value: str = "value") -> DataFrame:
    """``node n1 n2 ...`` lines as ``id, neighbors``; a lone id has no neighbors."""
    parts = F.split(F.trim(F.regexp_replace(F.col(value), r"\s+", " ")), " ")
    return raw.select(parts.alias("_p")).select(
        F.col("_p")[0].cast("bigint").alias("id"),
        F.slice("_p", 2, F.greatest(F.size("_p") - 1, F.lit(0))).cast("array<bigint>").alias("neighbors"),
    )


def read_adjacency(spark: SparkSession, path: str) -> DataFrame:
    """``parse_adjacency`` over text files."""
    return parse_adjacency(spark.read.text(path))


def parse_instances(raw: DataFrame, value: str = "value") -> DataFrame:
    """``docid label f1 f2 ...`` lines as ``doc_id, label, features``."""
    return raw.select(F.split(value, " ").alias("_p")).select(
        F.col("_p")[0].alias("doc_id"),
        F.col("_p")[1].alias("label"),
        F.slice("_p", 3, F.greatest(F.size("_p") - 2, F.lit(0))).cast("array<int>").alias("features"),
    )


def read_instances(spark: SparkSession, path: str) -> DataFrame:
    """``parse_instances`` over text files."""
    return parse_instances(spark.read.text(path))


def parse_model_line(value: Column) -> Column:
    """A ``(feature,weight)`` line as a struct."""
    form = r"\(([^,]+),([^)]+)\)"
    return F.struct(
        F.regexp_extract(value, form, 1).cast("int").alias("feature"),
        F.regexp_extract(value, form, 2).cast("double").alias("weight"),
    )


def parse_model(raw: DataFrame, value: str = "value") -> DataFrame:
    """``(feature,weight)`` lines as ``feature, weight``."""
    return raw.select(parse_model_line(F.col(value)).alias("m")).select("m.feature", "m.weight")


def read_model(spark: SparkSession, path: str, model_id: str) -> DataFrame:
    """One text model as rows ``model_id, feature, weight``."""
    return parse_model(spark.read.text(path)).select(F.lit(model_id).alias("model_id"), "feature", "weight")


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """All models that ``write_models`` left below ``path``, as rows ``model_id, feature, weight``."""
    raw = spark.read.schema("value string, model_id string").text(path)
    return raw.select("model_id", parse_model_line(F.col("value")).alias("m")).select("model_id", "m.feature", "m.weight")
