"""Reports and their relational building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.functions.dates import day_text, in_period, year_month
from tidemill.functions.numbers import charge, disc_price
from tidemill.operators import relational as R
from tidemill.plans import reports
from tidemill.runtime import scratch_path
from tidemill.sources.sinks import write_text
from tidemill.sources.tpch import TBL_SCHEMAS, read_tbl

MONTH = "1996-01"
NATIONS = ("NATION_3", "NATION_24")
IN_MONTH = "l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-02-01'"
PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
DISC = f"{PRICE} * (1 - CAST(l_discount AS DECIMAL(4,2)))"
CHARGE = f"{DISC} * (1 + CAST(l_tax AS DECIMAL(4,2)))"


def _in_month(t):
    return R.where(t.lineitem, in_period(t.lineitem, "l_shipdate", MONTH))


def _tbl_round_trip(t):
    """Write lineitem as pipe-delimited text in TPC-H column order, read it back by position."""
    names = [field.split()[0] for field in TBL_SCHEMAS["lineitem"].split(", ")]
    df = t.lineitem
    fields = [
        day_text(F.col(c)) if c == "l_shipdate" else F.col(c).cast("string") if c in df.columns else F.lit("")
        for c in names
    ]
    path = scratch_path(t.spark, "tbl")
    write_text(df.select(F.concat(F.concat_ws("|", *fields), F.lit("|")).alias("value")), path)
    back = read_tbl(t.spark, path, "lineitem")
    return back.select(*[c for c in names if c in df.columns and c != "l_shipdate"], day_text(F.col("l_shipdate")).alias("l_shipdate"))


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("q1_ship_count", lambda t: reports.ship_count(t.lineitem, MONTH),
        f"SELECT count(*) AS n FROM lineitem WHERE {IN_MONTH}")
    add("q2_clerks", lambda t: reports.clerks(t.orders, t.lineitem, MONTH, clerk="o_orderpriority"),
        f"""SELECT o_orderpriority AS clerk, o_orderkey FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {IN_MONTH}) ORDER BY o_orderkey LIMIT 20""")
    add("q3_parts_suppliers", lambda t: reports.parts_suppliers(t.lineitem, t.part, t.supplier, MONTH),
        f"""SELECT l_orderkey, coalesce(p_name, '?') AS p_name, coalesce(s_name, '?') AS s_name
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
        WHERE {IN_MONTH} ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20""")
    add("q4_nation_volume",
        lambda t: reports.nation_volume(t.lineitem, t.orders, t.customer, t.nation, MONTH),
        f"""SELECT CAST(c_nationkey AS BIGINT) AS n_nationkey, n_name, count(*) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        LEFT JOIN nation ON n_nationkey = c_nationkey WHERE {IN_MONTH} GROUP BY ALL""")
    add("q5_monthly_two_nations",
        lambda t: reports.monthly_volume(t.lineitem, t.orders, t.customer, t.nation, NATIONS),
        f"""SELECT n_name, strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey WHERE n_name IN {NATIONS} GROUP BY ALL""")
    add("q6_pricing_summary", lambda t: reports.pricing_summary(t.lineitem, MONTH),
        f"""SELECT l_returnflag, l_linestatus,
        CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
        CAST(sum({PRICE}) AS DOUBLE) AS sum_base_price,
        CAST(sum({DISC}) AS DOUBLE) AS sum_disc_price,
        CAST(sum({CHARGE}) AS DOUBLE) AS sum_charge,
        round(CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) AS avg_qty,
        round(CAST(sum({PRICE}) AS DOUBLE) / count(*), 6) AS avg_price,
        round(CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / count(*), 6) AS avg_disc,
        count(*) AS n FROM lineitem WHERE {IN_MONTH} GROUP BY ALL""")
    add("q7_shipping_priority",
        lambda t: reports.shipping_priority(t.lineitem, t.orders, t.customer, "1998-06", priority="o_orderpriority"),
        f"""SELECT c_name, o_orderkey, CAST(sum({DISC}) AS DOUBLE) AS revenue,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority AS priority
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        WHERE o_orderdate < TIMESTAMP '1998-06-01' AND l_shipdate >= TIMESTAMP '1998-07-01'
        GROUP BY ALL ORDER BY revenue DESC, o_orderkey LIMIT 10""")

    add("src_tbl", _tbl_round_trip,
        """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem""")
    add("date_granularity",
        lambda t: R.count_in_periods(t.lineitem, "l_shipdate", ["1996", MONTH, "1996-01-01"]),
        """SELECT d AS date, count(*) FILTER (WHERE strftime(l_shipdate, '%Y-%m-%d').starts_with(d)) AS n
        FROM lineitem, (VALUES ('1996'), ('1996-01'), ('1996-01-01')) v(d) GROUP BY d""")
    add("date_prefix",
        lambda t: R.where(t.orders, in_period(t.orders, "o_orderdate", "1996-02")).select("o_orderkey", day_text(F.col("o_orderdate")).alias("o_orderdate")),
        """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
        WHERE strftime(o_orderdate, '%Y-%m-%d') LIKE '1996-02%'""")
    add("year_month",
        lambda t: t.lineitem.select(year_month(F.col("l_shipdate")).alias("month")).groupBy("month").agg(F.count(F.lit(1)).alias("n")),
        "SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n FROM lineitem GROUP BY 1")
    add("disc_price",
        lambda t: t.lineitem.groupBy("l_suppkey").agg(F.sum(disc_price(F.col("l_extendedprice"), F.col("l_discount"))).cast("double").alias("disc_price")),
        f"SELECT l_suppkey, CAST(sum({DISC}) AS DOUBLE) AS disc_price FROM lineitem GROUP BY 1")
    add("charge",
        lambda t: t.lineitem.groupBy("l_suppkey").agg(F.sum(charge(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"))).cast("double").alias("charge")),
        f"SELECT l_suppkey, CAST(sum({CHARGE}) AS DOUBLE) AS charge FROM lineitem GROUP BY 1")

    add("op_filter", lambda t: _in_month(t).select("l_orderkey", "l_linenumber", "l_partkey"),
        f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE {IN_MONTH}")
    add("op_project", lambda t: R.project(t.orders, "o_orderkey", "o_custkey", "o_orderpriority"),
        "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
    add("op_shuffle_join",
        lambda t: R.equi_join(t.lineitem, t.orders, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey"),
        "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    add("op_semi_join", lambda t: R.keep_matching(t.orders, _in_month(t), "o_orderkey", "l_orderkey").select("o_orderkey"),
        f"SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {IN_MONTH})")
    add("op_broadcast_join",
        lambda t: R.lookup(t.customer, t.nation, "c_nationkey", "n_nationkey").select("c_custkey", "n_name"),
        "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
    add("op_broadcast_left_join",
        lambda t: R.lookup_or(t.lineitem, R.where(t.supplier, F.col("s_acctbal") > 0), "l_suppkey", "s_suppkey", "s_name").groupBy("s_name").agg(F.count(F.lit(1)).alias("n")),
        """SELECT coalesce(s_name, '?') AS s_name, count(*) AS n FROM lineitem
        LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s_suppkey GROUP BY 1""")
    add("op_in_broadcast",
        lambda t: R.keep_members(t.customer, R.where(t.nation, F.col("n_name").isin(*NATIONS)), "c_nationkey", "n_nationkey").select("c_custkey"),
        f"SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name IN {NATIONS})")
    add("op_group_sum",
        lambda t: R.group_sum(t.lineitem, ["l_returnflag", "l_linestatus"], qty=F.col("l_quantity").cast("bigint"), lines=F.lit(1)),
        "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, count(*) AS lines FROM lineitem GROUP BY 1, 2")
    add("op_group_list_sum",
        lambda t: R.group_sum(t.lineitem, ["l_orderkey"], revenue=disc_price(F.col("l_extendedprice"), F.col("l_discount"))).withColumn("revenue", F.col("revenue").cast("double")),
        f"SELECT l_orderkey, CAST(sum({DISC}) AS DOUBLE) AS revenue FROM lineitem GROUP BY 1")
    add("op_count", lambda t: R.count_rows(t.lineitem), "SELECT count(*) AS n FROM lineitem")
    add("op_avg",
        lambda t: R.group_avg(t.lineitem, ["l_returnflag"], avg_qty=F.col("l_quantity")).withColumn("avg_qty", F.round("avg_qty", 6)),
        "SELECT l_returnflag, round(avg(l_quantity), 6) AS avg_qty FROM lineitem GROUP BY 1")
    add("op_sort", lambda t: R.ordered(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey"),
        "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey")
    add("op_limit",
        lambda t: R.first_rows(t.orders.select("o_orderkey", "o_totalprice"), 20, F.desc("o_totalprice"), "o_orderkey"),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
