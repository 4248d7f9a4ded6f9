"""TPC-H style tables from Parquet or from pipe-delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The column order of the public TPC-H table files.
TBL_SCHEMAS = {
    "region": "r_regionkey bigint, r_name string, r_comment string",
    "nation": "n_nationkey bigint, n_name string, n_regionkey bigint, n_comment string",
    "supplier": "s_suppkey bigint, s_name string, s_address string, s_nationkey bigint, s_phone string, "
    "s_acctbal double, s_comment string",
    "customer": "c_custkey bigint, c_name string, c_address string, c_nationkey bigint, c_phone string, "
    "c_acctbal double, c_mktsegment string, c_comment string",
    "part": "p_partkey bigint, p_name string, p_mfgr string, p_brand string, p_type string, p_size int, "
    "p_container string, p_retailprice double, p_comment string",
    "partsupp": "ps_partkey bigint, ps_suppkey bigint, ps_availqty int, ps_supplycost double, ps_comment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int, o_comment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate date, l_commitdate date, l_receiptdate date, l_shipinstruct string, l_shipmode string, "
    "l_comment string",
}


def read_tbl(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A ``.tbl`` file: fields by position, nothing quoted, a trailing delimiter allowed."""
    return spark.read.csv(path, schema=TBL_SCHEMAS[table], sep="|", quote="", dateFormat="yyyy-MM-dd")


def read_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of ``folder`` kept as Parquet."""
    return spark.read.parquet(f"{folder}/{table}.parquet")
