"""Small helpers of the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.runtime import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def utf8(column: pa.Array) -> list[bytes]:
    """The values of a string column as UTF-8; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def small(batches, rows: int = 1024):
    """The batches in slices, so that a task turns few rows into Python objects at a time."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def others(df: DataFrame, *own: str) -> list[str]:
    """The columns of ``df`` that none of the operator's own columns replaces."""
    taken = {name.lower() for name in own}
    return [name for name in df.columns if name.lower() not in taken]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it from there.

    A lost executor then costs a second read, not the work that led to ``df``, and rows whose
    values depend on the task that made them (row numbers, file names) stay as they are.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
