"""The last row of another table at or before a row's time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.runtime import scratch_path, shuffle_partitions


class _Carry:
    """The key at the end of what was read, its last right row, and whether the key is the partition's first."""

    def __init__(self):
        self.first_key = self.key = self.right = None
        self.seen = False


def _matched(arrow: pa.Schema):
    """Left rows with the last right row of their key in this partition, and one summary row.

    A left row is ``open`` if its key may go on from the partition before: it is the
    partition's first key and no right row of it came yet.
    """

    def run(batches):
        part, carry = TaskContext.get().partitionId(), _Carry()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, rights = batch.column("key"), batch.column("r")
            here = np.arange(n)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            is_right = batch.column("side").to_numpy() == 0
            begin = np.maximum.accumulate(np.where(new, here, 0))
            last = np.maximum.accumulate(np.where(is_right, here, -1))
            # Row n of `pool` is the right row carried from the batches before; null stands for none.
            pool = pa.concat_arrays([rights, pa.array([carry.right], rights.type)])
            if not carry.seen:
                carry.seen, carry.first_key = True, keys[0].as_py()
                goes_on = False
            else:
                goes_on = keys[0].as_py() == carry.key
            carried = goes_on & (begin == 0) & (last < begin)
            place = np.where(last >= begin, last, np.where(carried, n, -1))
            taken = pool.take(pa.array(place, mask=place < 0))
            first = begin == 0 if keys[0].as_py() == carry.first_key else np.zeros(n, bool)
            left = ~is_right
            unmatched = taken.is_null().to_numpy(zero_copy_only=False)
            columns = {"l": batch.column("l").filter(left), "r": taken.filter(left), "open": pa.array((first & unmatched)[left])}
            yield _made(arrow, int(left.sum()), part=part, **columns)
            end = int(place[-1])
            carry.right, carry.key = (pool[end].as_py() if end >= 0 else None), keys[n - 1].as_py()
        if carry.seen:
            own = {"first_key": [carry.first_key], "last_key": [carry.key], "r": [carry.right]}
            yield _made(arrow, 1, part=part, **{k: pa.array(v, arrow.field(k).type) for k, v in own.items()})

    return run


def _made(arrow: pa.Schema, n: int, part: int, **columns) -> pa.RecordBatch:
    columns["part"] = pa.array(np.full(n, part, np.int32))
    return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)


def asof_join(left: DataFrame, right: DataFrame, key: str, time: str, tie: str, prefix: str = "last_") -> DataFrame:
    """Every row of ``left`` with the columns of the last row of ``right`` that has its ``key``
    and is not later, under names that begin with ``prefix``; nulls where there is none.

    Of right rows of one key and time the one with the largest ``tie`` counts; a null tie is the
    smallest. Rows without a key or a time have no partner.

    Both sides are sorted together over range partitions of key and time, so a frequent key is
    split. Inside a partition the last right row is carried along. Every partition hands on one
    row with its last key and right row; from these, one row per partition, the rows at the
    head of a partition get what the partitions before hold.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = left.sparkSession
    l_type, r_type = left.schema, right.schema
    timed = F.col(key).isNotNull() & F.col(time).isNotNull()
    tie_type = r_type[tie].dataType

    def tagged(rows: DataFrame, side: int) -> DataFrame:
        whole = F.struct(*[F.col(c) for c in rows.columns])
        none = F.lit(None)
        return rows.filter(timed).select(
            F.col(key).alias("key"), F.col(time).alias("time"), F.lit(side).alias("side"),
            (F.col(tie) if side == 0 else none.cast(tie_type)).alias("tie"),
            (whole if side else none.cast(l_type)).alias("l"), (none.cast(r_type) if side else whole).alias("r"),
        )

    order = ["key", "time", "side", "tie"]
    rows = tagged(left, 1).unionByName(tagged(right, 0))
    rows = rows.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order).select("key", "side", "l", "r")
    key_type = l_type[key].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("open", T.BooleanType()), T.StructField("l", l_type),
        T.StructField("r", r_type), T.StructField("first_key", key_type), T.StructField("last_key", key_type),
    ])
    path = scratch_path(spark, "asof")
    rows.mapInArrow(_matched(to_arrow_schema(schema)), schema).write.parquet(path)
    made = spark.read.schema(schema).parquet(path)

    ends = made.filter(F.col("first_key").isNotNull())
    asks = ends.select("part", F.col("first_key").alias("key"), F.lit(None).cast(r_type).alias("r"), F.lit(0).alias("gives"))
    gives = ends.select("part", F.col("last_key").alias("key"), "r", F.lit(1).alias("gives"))
    before = Window.partitionBy("key").orderBy("part", "gives").rowsBetween(Window.unboundedPreceding, -1)
    carried = asks.unionByName(gives).withColumn("carried", F.last("r", ignorenulls=True).over(before)).filter("gives = 0")
    # One row per range partition: the bound of what is broadcast.
    found = made.filter(F.col("open").isNotNull()).join(F.broadcast(carried.select("part", "carried")), "part", "left")
    chosen = F.when(F.col("open"), F.col("carried")).otherwise(F.col("r"))
    found = found.select("l", chosen.alias("r"))
    untimed = left.filter(~timed).select(F.struct(*left.columns).alias("l"), F.lit(None).cast(r_type).alias("r"))
    return found.unionByName(untimed).select("l.*", *[F.col("r")[c].alias(prefix + c) for c in right.columns])
