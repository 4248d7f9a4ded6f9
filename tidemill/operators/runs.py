"""A table function over ordered partitions, to be called from SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_label_runs(spark: SparkSession, name: str, key: tuple[str, str], label: tuple[str, str], time: tuple[str, str]) -> None:
    """Register ``name`` for ``SELECT * FROM name(TABLE(t) PARTITION BY key ORDER BY time)``.

    It returns ``key, run, label, first, last, n``: every stretch of rows of a key that follow
    each other with the same label (nulls are equal), numbered from 1. The arguments are names
    and types of columns. A partition comes as Arrow batches in the wanted order; between two
    batches only the run that is still open is kept.
    """

    @F.arrow_udtf(returnType=f"{key[0]} {key[1]}, run bigint, label {label[1]}, first {time[1]}, last {time[1]}, n bigint")
    class LabelRuns:
        def __init__(self):
            self.open, self.run, self.types = None, 0, None

        def eval(self, batch):
            import numpy as np
            import pyarrow as pa

            n = batch.num_rows
            if not n:
                return
            keys, labels, times = (batch.column(c[0]) for c in (key, label, time))
            self.types = (keys.type, labels.type, times.type)
            new = np.ones(n, bool)
            codes = labels.dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] = codes[1:] != codes[:-1]
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], n) - 1
            size = end - begin + 1
            firsts = times.take(pa.array(begin)).to_pylist()
            rows = list(zip(keys.take(pa.array(begin)).to_pylist(), labels.take(pa.array(begin)).to_pylist(), firsts, times.take(pa.array(end)).to_pylist(), size.tolist()))
            if self.open is not None:
                if self.open[1] == rows[0][1]:
                    rows[0] = (rows[0][0], rows[0][1], self.open[2], rows[0][3], self.open[4] + rows[0][4])
                else:
                    rows.insert(0, self.open)
            self.open = rows.pop()
            if rows:
                yield self._table(rows)

        def terminate(self):
            if self.open is not None:
                yield self._table([self.open])

        def _table(self, rows):
            import pyarrow as pa

            keys, labels, first, last, n = zip(*rows)
            numbers = range(self.run + 1, self.run + 1 + len(rows))
            self.run += len(rows)
            k, l, t = self.types
            return pa.table({key[0]: pa.array(keys, k), "run": pa.array(numbers, pa.int64()), "label": pa.array(labels, l),
                             "first": pa.array(first, t), "last": pa.array(last, t), "n": pa.array(n, pa.int64())})

    spark.udtf.register(name, LabelRuns)
