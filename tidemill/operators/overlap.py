"""Pairs of intervals that overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlapping_pairs(rows: DataFrame, key: str, ident: str, begin: str, end: str, width: int) -> DataFrame:
    """``key, a, b``: identifiers ``a < b`` of rows with one key whose closed intervals meet.

    ``begin`` and ``end`` are whole numbers. An interval has the lowest level on which it is not longer
    than a bin; bins of level j are ``width * 2 ** j`` wide, so on its own level and on all
    above it lies in two bins at most, however long it is. A pair meets on the level of its
    longer interval: the longer one stands on its own level only, the other one on all levels
    from its own up to the highest that any interval has. Of the bins that both have, the one
    in which the later interval begins counts, so a pair comes once. The join is on key, level
    and bin. Rows with a null in any of the columns, or an end before the begin, overlap with nothing.
    """
    whole = rows.select(
        F.col(key).alias("key"), F.col(ident).alias("id"), F.col(begin).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e")
    ).filter("key IS NOT NULL AND id IS NOT NULL AND s IS NOT NULL AND e >= s")
    level = F.expr(f"cast(greatest(0, ceil(log2((e - s + 1) / {width}.0))) as int)")
    leveled = whole.withColumn("level", level)
    # The logarithm is not exact: one level more is never wrong, one less would be.
    leveled = leveled.withColumn("level", F.expr(f"if(e - s + 1 > shiftleft({width}L, level), level + 1, level)"))
    top = leveled.agg(F.max("level")).first()[0]
    bins = F.expr(f"sequence(cast(floor(s / shiftleft({width}L, on)) as bigint), cast(floor(e / shiftleft({width}L, on)) as bigint))")
    longer = leveled.withColumn("on", F.col("level")).withColumn("bin", F.explode(bins))
    shorter = leveled.withColumn("on", F.explode(F.sequence(F.col("level"), F.lit(top or 0)))).withColumn("bin", F.explode(bins))
    x = shorter.select("key", "on", "bin", *[F.col(c).alias(f"{c}_x") for c in ("id", "s", "e", "level")])
    y = longer.select("key", "on", "bin", *[F.col(c).alias(f"{c}_y") for c in ("id", "s", "e", "level")])
    met = x.join(y, ["key", "on", "bin"]).filter(
        F.expr(f"""s_x <= e_y AND s_y <= e_x AND (level_x < level_y OR id_x < id_y) AND id_x <> id_y
        AND bin = floor(greatest(s_x, s_y) / shiftleft({width}L, on))""")
    )
    return met.select(F.col("key").alias(key), F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))
