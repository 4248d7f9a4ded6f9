"""Joins over time, reconciliation, groupings, sketches, variants and table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.operators import properties, sketches
from tidemill.operators.asof import asof_join
from tidemill.operators.cube import grouped_totals
from tidemill.operators.overlap import overlapping_pairs
from tidemill.operators.reconcile import outer_join
from tidemill.operators.runs import register_label_runs
from tidemill.runtime import scratch_path

PRICE = "CAST(round(l_extendedprice * 100) AS BIGINT)"
DAYS = "datediff('day', DATE '1970-01-01', CAST({} AS DATE))"
DIMS = ["l_returnflag", "l_linestatus", "ship_year"]
SETS = [["l_returnflag", "l_linestatus"], ["ship_year"], []]
# A third of the rows has one key; every eleventh has none.
SKEWED = "CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END"
BROKEN = "CASE WHEN event_id % 7 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END"
SKETCH_BY = "week"


def purchases_after_views(t) -> DataFrame:
    left = t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    right = t.events.filter(F.col("event_type") == "view").select("user_id", "ts", "event_id", "value")
    found = asof_join(left, right, "user_id", "ts", "event_id")
    return found.select("event_id", "user_id", F.col("last_event_id").alias("view_id"), F.col("last_value").alias("view_value"))


def open_orders(t) -> DataFrame:
    """Open from the order's day to its last shipping day."""
    shipped = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    days = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_custkey", "o_orderkey", F.unix_date(F.to_date("o_orderdate")).alias("b"), F.unix_date(F.to_date("last")).alias("e")
    )
    return overlapping_pairs(days, "o_custkey", "o_orderkey", "b", "e", 32)


def _extracts(t) -> tuple[DataFrame, DataFrame]:
    many = t.lineitem.select(F.expr(SKEWED).alias("key"), "l_orderkey", "l_linenumber")
    one = t.part.filter("p_partkey % 5 <> 0").select(F.expr("nullif(p_partkey, 3)").alias("key"), "p_name")
    return many, one


def reconciled(how: str):
    def build(t) -> DataFrame:
        joined = outer_join(*_extracts(t), "key", how)
        state = F.when(F.col("l_orderkey").isNull(), "right only").when(F.col("p_name").isNull(), "left only").otherwise("both")
        return joined.groupBy(F.col("key").cast("string").alias("key"), state.alias("state")).agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("l_orderkey"), F.lit(0)).alias("orders"), F.min("p_name").alias("p_name")
        )

    return build


def _reconciled_sql(how: str) -> str:
    return f"""WITH a AS (SELECT {SKEWED} AS key, l_orderkey FROM lineitem), b AS (SELECT nullif(p_partkey, 3) AS key, p_name FROM part WHERE p_partkey % 5 <> 0)
    SELECT CAST(coalesce(a.key, b.key) AS VARCHAR) AS key, CASE WHEN l_orderkey IS NULL THEN 'right only' WHEN p_name IS NULL THEN 'left only' ELSE 'both' END AS state,
    count(*) AS n, CAST(coalesce(sum(l_orderkey), 0) AS BIGINT) AS orders, min(p_name) AS p_name FROM a {how} JOIN b ON a.key = b.key GROUP BY ALL"""


def _grouped(how):
    def build(t) -> DataFrame:
        rows = t.lineitem.withColumn("ship_year", F.year("l_shipdate").cast("bigint"))
        return grouped_totals(rows, DIMS, {"price": F.expr(PRICE), "quantity": F.col("l_quantity").cast("bigint")}, how)

    return build


def _grouped_sql(groups: str) -> str:
    dims = ", ".join(DIMS)
    return f"""SELECT {dims}, CAST(grouping({dims}) AS BIGINT) AS grouping, count(*) AS n, CAST(sum({PRICE}) AS BIGINT) AS price,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM (SELECT *, year(l_shipdate) AS ship_year FROM lineitem) GROUP BY {groups}"""


def merged_sketches(t) -> DataFrame:
    """Weekly figures from stored daily sketches, and how far they are from exact ones."""
    week = F.date_format(F.date_trunc("week", "day"), "yyyy-MM-dd")
    rows = t.events.withColumn("day", F.to_date("ts"))
    path = scratch_path(t.spark, "daily-sketches")
    sketches.store(sketches.build(rows, ["day"], "user_id", "value"), path, "day")
    daily = t.spark.read.schema("hll binary, kll binary, day date").parquet(path)
    merged = sketches.estimates(sketches.merge(daily, [week.alias("week")]), [0.5, 0.9])
    weekly = rows.withColumn("week", week)
    whole = sketches.estimates(sketches.merge(sketches.build(weekly, ["week"], "user_id", "value"), ["week"]), [0.5])
    exact = weekly.groupBy("week").agg(F.countDistinct("user_id").alias("users"))
    median = merged.select("week", F.col("quantiles")[0].alias("median"))
    below = weekly.join(median, "week").groupBy("week").agg(
        F.avg((F.col("value") < F.col("median")).cast("int")).alias("less"), F.avg((F.col("value") <= F.col("median")).cast("int")).alias("most")
    )
    joined = merged.join(whole.select("week", F.col("n_distinct").alias("from_whole")), "week").join(exact, "week").join(below, "week")
    return joined.select(
        "week",
        "n",
        "users",
        (F.col("n_distinct") == F.col("from_whole")).alias("merged_is_whole"),
        (F.abs(F.col("n_distinct") - F.col("users")) <= F.greatest(F.lit(1.0), 4 * 1.04 / 2 ** (sketches.LOG_BUCKETS / 2) * F.col("users"))).alias("users_close"),
        ((F.col("less") <= 0.52) & (F.col("most") >= 0.48)).alias("median_close"),
    )


def variants(t) -> DataFrame:
    good, broken = properties.parsed(t.events.withColumn("props", F.expr(BROKEN)), "props")
    read = properties.typed(good, "props", {"k": ("$.k", "bigint"), "missing": ("$.none", "string")})
    counted = read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("sum_k"), F.max("k").alias("max_k"), F.count("missing").alias("n_missing")
    )
    return counted.join(broken.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_broken")), "event_type", "left").fillna(0, ["n_broken"])


def label_runs(t) -> DataFrame:
    register_label_runs(t.spark, "event_runs", ("user_id", "bigint"), ("event_type", "string"), ("ts", "timestamp_ntz"))
    view = f"run_events_{abs(hash(t.folder))}"
    t.events.select("user_id", "event_type", "ts", "event_id").createOrReplaceTempView(view)
    found = t.spark.sql(f"SELECT * FROM event_runs(TABLE({view}) PARTITION BY user_id ORDER BY (ts, event_id))")
    stamp = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return found.select("user_id", "run", "label", F.date_format("first", stamp).alias("first_ts"), F.date_format("last", stamp).alias("last_ts"), "n")


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("asof_join", purchases_after_views,
        """SELECT p.event_id, p.user_id, v.event_id AS view_id, v.value AS view_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view'
        QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
    begin, end = DAYS.format("o_orderdate"), DAYS.format("max(l_shipdate)")
    add("interval_overlap_join", open_orders,
        f"""WITH o AS (SELECT o_custkey, o_orderkey, {begin} AS b, {end} AS e FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey, o_orderkey, o_orderdate)
        SELECT x.o_custkey, x.o_orderkey AS a, y.o_orderkey AS b FROM o x JOIN o y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey
        AND x.b <= x.e AND y.b <= y.e AND x.b <= y.e AND y.b <= x.e""")
    add("full_outer_reconcile", reconciled("full"), _reconciled_sql("FULL"))
    add("right_outer_reconcile", reconciled("right"), _reconciled_sql("RIGHT"))
    dims = ", ".join(DIMS)
    add("sales_cube", _grouped("cube"), _grouped_sql(f"CUBE ({dims})"))
    add("sales_rollup", _grouped("rollup"), _grouped_sql(f"ROLLUP ({dims})"))
    add("sales_grouping_sets", _grouped(SETS), _grouped_sql(f"GROUPING SETS ({', '.join('(' + ', '.join(s) + ')' for s in SETS)})"))
    add("sketch_store", merged_sketches,
        """SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week, count(value) AS n, count(DISTINCT user_id) AS users,
        true AS merged_is_whole, true AS users_close, true AS median_close FROM events GROUP BY 1""")
    add("props_variant", variants,
        f"""WITH p AS (SELECT event_type, {BROKEN} AS props FROM events), v AS (
        SELECT *, CASE WHEN good THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM (SELECT *, props IS NULL OR json_valid(props) AS good FROM p))
        SELECT event_type, count(*) FILTER (good) AS n, CAST(sum(k) AS BIGINT) AS sum_k, max(k) AS max_k, CAST(0 AS BIGINT) AS n_missing, count(*) FILTER (NOT good) AS n_broken FROM v GROUP BY event_type""")
    stamp = "'%Y-%m-%d %H:%M:%S.%f'"
    add("table_function_runs", label_runs,
        f"""SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY grp) AS run, label, strftime(first, {stamp}) AS first_ts, strftime(last, {stamp}) AS last_ts, n FROM (
        SELECT user_id, grp, any_value(event_type) AS label, min(ts) AS first, max(ts) AS last, count(*) AS n FROM (
        SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS grp FROM (
        SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) OR
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1 THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, grp)""")
