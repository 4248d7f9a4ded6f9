"""Writers. All replace what the target held before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_BUCKETS = 64


def write_text(df: DataFrame, path: str, sep: str = "\t", null: str = "") -> None:
    """One line per row, columns joined by ``sep``; a null is written as ``null``.

    Every row has as many fields as ``df`` has columns. Separators and line ends inside values
    are written as they are; choose a ``sep`` that no value has.
    """
    fields = [F.coalesce(F.col(c).cast("string"), F.lit(null)) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode("overwrite").text(path)


def write_models(models: DataFrame, path: str) -> None:
    """Rows ``model_id, feature, weight`` as text, a folder per model, ``(feature,weight)`` a line."""
    line = F.format_string("(%d,%s)", "feature", F.col("weight").cast("string")).alias("value")
    models.select("model_id", line).write.mode("overwrite").partitionBy("model_id").text(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Keep an intermediate result as Parquet and return it read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucket_of(term: Column, buckets: int) -> Column:
    """The bucket folder of a term."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def write_index(postings: DataFrame, path: str, buckets: int = INDEX_BUCKETS) -> None:
    """Keep ``term, doc_id, tf`` by bucket of the term, sorted by term and document.

    Postings meet by bucket, and adaptive execution cuts what is larger than its advisory size: a
    task sorts that much at any size of the index, and none writes a very frequent term alone.
    Ranges would count the postings twice, as their bounds come from a sample. Sorted files give
    row groups that a lookup of one term can skip.
    """
    key = ["bucket", "term", "doc_id"]
    keyed = postings.withColumn("bucket", bucket_of(F.col("term"), buckets)).hint("rebalance", F.col("bucket"))
    keyed.sortWithinPartitions(*key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def fetch_postings(spark: SparkSession, path: str, term: str, buckets: int = INDEX_BUCKETS) -> DataFrame:
    """Postings of one term: one bucket folder is listed, and row groups of other terms are skipped."""
    index = spark.read.parquet(path)
    return index.filter((F.col("bucket") == bucket_of(F.lit(term), buckets)) & (F.col("term") == term)).select(
        "term", "doc_id", "tf"
    )
