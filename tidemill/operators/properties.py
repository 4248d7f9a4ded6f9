"""JSON text as variants: typed access without a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parsed(rows: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``column`` as a variant, and apart from them the rows whose text is not JSON.

    A null text is no broken one; it stays, as a null variant.
    """
    tried = rows.withColumn("_variant", F.try_parse_json(column))
    broken = F.col("_variant").isNull() & F.col(column).isNotNull()
    good = tried.filter(~broken).withColumn(column, F.col("_variant")).drop("_variant")
    return good, tried.filter(broken).drop("_variant")


def schema(rows: DataFrame, column: str) -> str:
    """The schema that holds all variants of ``column``, merged in one aggregate; ``VOID`` where there are none."""
    return rows.filter(F.col(column).isNotNull()).agg(F.schema_of_variant_agg(column)).first()[0]


def typed(rows: DataFrame, column: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """``rows`` with a column per name, of a path and type; null where the path is missing or of another type."""
    return rows.withColumns({name: F.try_variant_get(column, path, kind) for name, (path, kind) in paths.items()})
