"""Registration of queries beside the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.sources.tpch import read_table

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """Attribute access to the Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        frame = read_table(self.spark, self.folder, name)
        setattr(self, name, frame)  # the schema of a table is looked up once per query
        return frame


class Catalog:
    """Queries by name, each with its SQL or with none."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        self.queries[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            self.sql[name] = sql
