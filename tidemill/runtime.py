"""Session, checkpoint and join helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# A key is hot once it owns this many rows of the larger side. MAX_HOT_KEYS bounds what is
# broadcast for them; any key left out owns less than 1 / MAX_HOT_KEYS of all rows.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000
HOT_SALTS = 4_096
# Up to this many rows of a few numbers each are broadcast whole.
SMALL_ROWS = 100_000


def build_session(app: str = "tidemill", cpus: str = "*", **settings: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a private one where a local session names none."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    if folder is None:
        folder = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidemill-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder and forget how it was made."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def keep_partitioned(
    df: DataFrame, *keys: str, then: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """``cut_lineage`` with the rows hash-partitioned and sorted by ``keys``.

    A later join or grouping on ``keys`` then leaves these rows where they are. ``then`` is a
    step that keeps the partitioning and runs after it. ``df`` is computed and stored first,
    under the settings of its own session. Spark remembers the layout of a checkpoint just for
    a plan that is fixed in advance, so the stored rows are laid out in a session of their own,
    in which adaptive execution is off; that plan reads, shuffles and sorts, and joins nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    fixed = spark.newSession()
    fixed.conf.set("spark.sql.adaptive.enabled", "false")
    rows = fixed.read.schema(df.schema).parquet(path)
    return cut_lineage(then(rows.repartition(shuffle_partitions(df), *keys)).sortWithinPartitions(*keys))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path inside the shared folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of ``scratch_path`` once nothing reads it any more."""
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def tidy_session(spark: SparkSession) -> SparkSession:
    """A session that deletes what a query has shuffled as soon as the query ends.

    Shuffled files otherwise stay until the driver collects its garbage. Its queries have to store
    what they give, since nothing they shuffled is there to be read again.
    """
    tidy = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        tidy.conf.set(name, spark.conf.get(name))
    tidy.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return tidy


def _setting_bytes(spark: SparkSession, name: str) -> int:
    text = spark.conf.get(name).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40, "p": 50}
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)


def spread_input(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan over all cores if it is smaller than one file split per core.

    A file of one row group is otherwise read by one task. Larger inputs keep their splits
    and are not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size < cores * _setting_bytes(spark, "spark.sql.files.maxPartitionBytes")
    return df.repartition(cores, key) if small else df


def shuffle_partitions(df: DataFrame) -> int:
    """The configured number. Given explicitly to ``repartition``, it is not lowered for a
    small input, which matters where a stage turns few bytes into much work."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _planned_bytes(df: DataFrame) -> int | None:
    """The planner's size of ``df``; None where it knows none and takes a huge number."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 50 else None


def partitions_by_size(df: DataFrame, partition_bytes: int, least: int | None = None) -> int:
    """So many partitions that one has ``partition_bytes`` of ``df``, ``least`` or the configured number at least."""
    size = _planned_bytes(df)
    least = shuffle_partitions(df) if least is None else least
    return max(least, -(-size // partition_bytes) if size is not None else 0)


def is_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; counts no more than one beyond.

    For rows of a fixed width this bounds the bytes of a broadcast.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def attach(
    big: DataFrame,
    dim: DataFrame,
    on: list[str],
    spread: list[str],
    fan: str,
    how: str = "inner",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``big`` with ``dim`` (unique on ``on``) when a few keys may own most of ``big``.

    ``fan`` is a column of ``dim``: the number of rows of ``big`` per key. The keys with the
    largest fan, at most MAX_HOT_KEYS, are broadcast; a salt that follows from ``spread`` is
    part of the join's keys, so their rows leave the partition of their key. All other rows
    have the salt 0 and meet ``dim`` in an ordinary join, for which the planner picks the strategy.
    """
    values = [c for c in dim.columns if c not in on]
    packed = dim.select(
        *on, F.col(fan).alias("_fan"), F.struct(*values).alias("_dim")
    )
    hot = (
        packed.filter(F.col("_fan") >= (HOT_ROWS if hot_rows is None else hot_rows))
        .orderBy(F.desc("_fan"), *on)
        .limit(MAX_HOT_KEYS)
        .select(*on, F.col("_dim").alias("_hot"))
    )
    salt = F.pmod(F.xxhash64(*spread), F.lit(HOT_SALTS)) + 1
    salted = big.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot").isNull(), F.lit(0).cast("bigint")).otherwise(salt)
    )
    # A literal 0 would become a condition beside the join's keys; this zero is not seen through.
    zero = F.pmod(F.xxhash64(*on), F.lit(1).cast("bigint"))
    cold = packed.select(*on, F.col("_dim").alias("_cold"), zero.alias("_salt"))
    joined = salted.join(cold, [*on, "_salt"], "left").withColumn(
        "_value", F.coalesce("_hot", "_cold")
    )
    if how == "inner":
        joined = joined.filter(F.col("_value").isNotNull())
    kept = [c for c in big.columns if c not in values]
    return joined.select(*kept, *[F.col(f"_value.{v}").alias(v) for v in values])
