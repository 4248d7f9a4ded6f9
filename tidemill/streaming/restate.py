"""Daily totals that late events correct."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.streaming.windows import cents


class DailyTotals:
    """A table of totals per day and key, kept up to date by micro-batches.

    Every batch stores its own sums under its number and its days; the days it touches are then
    added up over all batches and replace their partitions of the table. No other day is
    written. Both writes overwrite partitions that follow from the batch alone, so a batch that
    runs again, after a failure or by mistake, leaves everything as it was. Adding up reads sums
    of the touched days, never events.
    """

    def __init__(self, folder: str, key: str):
        self.parts, self.table, self.progress, self.key = f"{folder}/parts", f"{folder}/totals", f"{folder}/progress", key

    def _write(self, rows: DataFrame, path: str, *partitions: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)

    def apply(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = batch.filter(F.col("ts").isNotNull()).groupBy(F.to_date("ts").alias("day"), self.key).agg(
            F.count(F.lit(1)).alias("n"), F.sum(cents(F.col("value"))).alias("total_cents")
        )
        self._write(own.withColumn("batch", F.lit(number).cast("bigint")), self.parts, "batch", "day")
        parts = spark.read.schema(self._part_schema(own)).parquet(self.parts)
        touched = parts.filter(F.col("batch") == number).select("day").distinct()
        total = parts.join(touched, "day", "left_semi").groupBy("day", self.key).agg(
            F.sum("n").alias("n"), F.sum("total_cents").alias("total_cents")
        )
        self._write(total, self.table, "day")

    def _part_schema(self, own: DataFrame) -> str:
        key = own.schema[self.key].dataType.simpleString()
        return f"{self.key} {key}, n bigint, total_cents bigint, batch bigint, day date"

    def follow(self, stream: DataFrame) -> None:
        """Take all there is of a stream, going on where the last run ended."""
        query = (
            stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", self.progress).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def read(self, spark: SparkSession, key_type: str = "string") -> DataFrame:
        """``key, n, total_cents, day``."""
        return spark.read.schema(f"{self.key} {key_type}, n bigint, total_cents bigint, day date").parquet(self.table)
