"""Seven parameterised reports over the TPC-H style tables.

``date`` is ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd`` and is compared at that granularity.
Every join meets unique keys on one side. Q4 and Q7 sum lineitems per order first; Q5 joins
them with the chosen orders, as its groups by month would not make them fewer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import after_period, before_period, day_text, in_period, year_month
from tidemill.functions.numbers import charge, disc_price, money
from tidemill.runtime import SMALL_ROWS, cut_lineage


def ship_count(lineitem: DataFrame, date: str) -> DataFrame:
    """Q1: number of lineitems shipped at ``date``."""
    return lineitem.filter(in_period(lineitem, "l_shipdate", date)).agg(F.count(F.lit(1)).alias("n"))


def clerks(orders: DataFrame, lineitem: DataFrame, date: str, clerk: str = "o_clerk", limit: int | None = 20) -> DataFrame:
    """Q2: clerk of every order with a lineitem shipped at ``date``, first ``limit`` by order."""
    shipped = lineitem.filter(in_period(lineitem, "l_shipdate", date)).select("l_orderkey")
    found = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select(
        F.col(clerk).alias("clerk"), "o_orderkey"
    )
    ranked = found.orderBy("o_orderkey", "clerk")
    return ranked if limit is None else ranked.limit(limit)


def parts_suppliers(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame, date: str, limit: int | None = 20
) -> DataFrame:
    """Q3: part and supplier name of every lineitem shipped at ``date``; ``?`` where absent.

    Names do not change which rows come first, so the limit is taken before the lookups. The
    rows are kept, so that lineitem is read once, and the lookups fetch only their names.
    """
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    shipped = lineitem.filter(in_period(lineitem, "l_shipdate", date)).select(*keys)
    part, supplier = part.select("p_partkey", "p_name"), supplier.select("s_suppkey", "s_name")
    if limit is not None:
        shipped = cut_lineage(shipped.orderBy(*keys).limit(limit))
        # At most ``limit`` rows of four numbers.
        wanted = F.broadcast(shipped) if limit <= SMALL_ROWS else shipped
        part = part.join(wanted, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
        supplier = supplier.join(wanted, F.col("s_suppkey") == F.col("l_suppkey"), "left_semi")
    return (
        shipped.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .orderBy(*keys)
        .select(
            "l_orderkey",
            F.coalesce("p_name", F.lit("?")).alias("p_name"),
            F.coalesce("s_name", F.lit("?")).alias("s_name"),
        )
    )


def _per_customer(lineitem: DataFrame, orders: DataFrame, extra: list[str]) -> DataFrame:
    per_order = lineitem.groupBy("l_orderkey", *extra).agg(F.count(F.lit(1)).alias("n"))
    return (
        per_order.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", *extra)
        .agg(F.sum("n").alias("n"))
    )


def nation_volume(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, date: str
) -> DataFrame:
    """Q4: lineitems shipped at ``date`` per nation of the customer; ``?`` for an unknown nation."""
    shipped = lineitem.filter(in_period(lineitem, "l_shipdate", date))
    per_nation = (
        _per_customer(shipped, orders, [])
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_nation.join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_nationkey").cast("bigint").alias("n_nationkey"), F.coalesce("n_name", F.lit("?")).alias("n_name"), "n"
        )
        .orderBy("n_nationkey")
    )


def monthly_volume(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    nations: Sequence[str] = ("CANADA", "UNITED STATES"),
) -> DataFrame:
    """Q5: lineitems per month of shipping for customers of the given nations."""
    chosen = nation.filter(F.col("n_name").isin(*nations)).select("n_nationkey", "n_name")
    buyers = customer.join(chosen, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    wanted = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")
    shipped = lineitem.select("l_orderkey", year_month(F.col("l_shipdate")).alias("month"))
    return (
        shipped.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_name", "month")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("n_name", "month")
    )


def pricing_summary(lineitem: DataFrame, date: str) -> DataFrame:
    """Q6: quantities, prices and averages per return flag and line status at ``date``."""
    price, off, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    sums = {
        "sum_qty": money(F.col("l_quantity")),
        "sum_base_price": money(price),
        "sum_disc_price": disc_price(price, off),
        "sum_charge": charge(price, off, tax),
    }
    means = {"avg_qty": F.col("l_quantity"), "avg_price": price, "avg_disc": off}
    return (
        lineitem.filter(in_period(lineitem, "l_shipdate", date))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            *[F.sum(e).cast("double").alias(c) for c, e in sums.items()],
            *[F.round(F.sum(money(e)).cast("double") / F.count(F.lit(1)), 6).alias(c) for c, e in means.items()],
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def shipping_priority(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    date: str,
    priority: str = "o_shippriority",
    limit: int | None = 10,
) -> DataFrame:
    """Q7: revenue of orders placed before ``date`` from lineitems shipped after it, best first."""
    revenue = (
        lineitem.filter(after_period(lineitem, "l_shipdate", date))
        .groupBy("l_orderkey")
        .agg(F.sum(disc_price(F.col("l_extendedprice"), F.col("l_discount"))).alias("revenue"))
    )
    placed = orders.filter(before_period(orders, "o_orderdate", date)).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col(priority).alias("priority")
    )
    ranked = (
        revenue.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "c_name",
            "o_orderkey",
            F.col("revenue").cast("double").alias("revenue"),
            day_text(F.col("o_orderdate")).alias("o_orderdate"),
            "priority",
        )
        .orderBy(F.desc("revenue"), "o_orderkey")
    )
    return ranked if limit is None else ranked.limit(limit)
