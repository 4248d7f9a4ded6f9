"""Outer joins of two extracts where keys are missing and a few keys own most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
# Keys that may be broadcast. A key left out owns less than 1 / MAX_HOT of the rows.
MAX_HOT = 1_000


def hot_keys(rows: DataFrame, key: str, least: int, most: int = MAX_HOT) -> list:
    """The keys with at least ``least`` rows, the most frequent ones first."""
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") >= least)
    return [r[key] for r in counted.orderBy(F.desc("count"), key).limit(most).collect()]


def outer_join(many: DataFrame, one: DataFrame, key: str, how: str = "full", least: int = HOT_ROWS, most: int = MAX_HOT) -> DataFrame:
    """``many`` and ``one`` joined on ``key``, which is unique in ``one``: ``how`` is full or right.

    An outer join of both sides can neither be broadcast nor split by adaptive execution: an
    unmatched row of ``one`` must come once. So rows go three ways. Those without a key match
    nothing and are added as they are, without a shuffle. Rows of the keys that own at least
    ``least`` rows of ``many`` meet a broadcast of the at most ``most`` rows of ``one`` with
    these keys; every such key has rows on the left, so nothing of ``one`` is left over. All
    other rows meet in an ordinary outer join. Columns other than the key need different names.
    """
    if how not in ("full", "right"):
        raise ValueError("how is full or right")
    hot = hot_keys(many, key, least, most)
    null_many, null_one = many.filter(F.col(key).isNull()), one.filter(F.col(key).isNull())
    parts = [many.filter(F.col(key).isNotNull()), one.filter(F.col(key).isNotNull())]
    cold = [p.filter(~F.col(key).isin(hot)) if hot else p for p in parts]
    joined = cold[0].join(cold[1], key, how)
    if hot:
        own = parts[1].filter(F.col(key).isin(hot))
        joined = joined.unionByName(parts[0].filter(F.col(key).isin(hot)).join(F.broadcast(own), key, "left" if how == "full" else "inner"))
    columns = joined.columns
    if how == "full":
        joined = joined.unionByName(null_many, allowMissingColumns=True)
    return joined.unionByName(null_one, allowMissingColumns=True).select(*columns)
