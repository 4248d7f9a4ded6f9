"""Files as a stream, and running a stream to the end of what there is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.runtime import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows of a file of a replayed table, about.
ROWS_PER_FILE = 1_000_000


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for streams: state on disk, times in UTC.

    State that a query keeps per key then does not have to fit into an executor's heap, and the
    caller's session keeps its settings.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return session


def replay(rows: DataFrame, folder: str, by: str, slices: int, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write ``rows`` to ``folder`` as ``slices`` arrivals, one after the other in the order of ``by``.

    Slices cover equal spans of ``by``; rows without a value arrive last. A slice is a filter
    on ``by``, which reaches the scan. The files of one slice are in no order, so they belong in
    one micro-batch: every slice has the same number of files, which is returned for ``files``.
    """
    low, high, n = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    if low is None:
        rows.write.mode("append").parquet(folder)
        return 1
    per_slice = max(1, -(-n // (slices * rows_per_file)))
    borders = [low + (high - low) * k / slices for k in range(1, slices)]
    for k in range(slices):
        mine = F.lit(True)
        if k:
            mine &= F.col(by) >= F.lit(borders[k - 1])
        if k < slices - 1:
            mine &= F.col(by) < F.lit(borders[k])
        else:
            mine |= F.col(by).isNull()
        rows.filter(mine).repartition(per_slice).write.mode("append").parquet(folder)
        # A partition without rows leaves no file; empty files take the place of those.
        for _ in range((k + 1) * per_slice - _file_count(rows, folder)):
            rows.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return per_slice


def _file_count(rows: DataFrame, folder: str) -> int:
    return len(rows.sparkSession.read.schema(rows.schema).parquet(folder).inputFiles())


def files(session: SparkSession, folder: str, schema, per_batch: int = 1) -> DataFrame:
    """The Parquet files of ``folder``, old ones first, ``per_batch`` a micro-batch."""
    return session.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def drain(stream: DataFrame, target: str, checkpoint: str) -> DataFrame:
    """Append what the stream gives for all input there is to ``target``; the rows written so far.

    The sink keeps a log of the files of every batch, so a batch that is repeated after a
    failure, or a run that is continued from ``checkpoint``, writes no row twice.
    """
    query = (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(target)


def drained(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """``drain`` into new scratch folders, for the caller's session."""
    target = scratch_path(spark, name)
    drain(stream, target, scratch_path(spark, f"{name}-progress"))
    return spark.read.schema(stream.schema).parquet(target)
