"""Graph operators over the foreign keys of the tables: customer to order to part to supplier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.catalog.base import Catalog
from tidemill.operators import graph as G
from tidemill.operators import rank as R
from tidemill.operators.components import component_count, weak_components
from tidemill.runtime import cut_lineage, scratch_path
from tidemill.sources.text import parse_adjacency

# Customers 1, 10 and 100.
SOURCES = (4, 40, 400)
ITERATIONS = 4
SHOWN = "CAST(CAST(rank AS FLOAT) AS DOUBLE)"

# Four times the key, plus the kind of node.
KINDS = {"customer": ("c_custkey", 0), "orders": ("o_orderkey", 1), "part": ("p_partkey", 2), "supplier": ("s_suppkey", 3)}

GRAPH = """nodes AS (
  SELECT 4 * c_custkey AS id FROM customer UNION ALL SELECT 4 * o_orderkey + 1 FROM orders
  UNION ALL SELECT 4 * p_partkey + 2 FROM part UNION ALL SELECT 4 * s_suppkey + 3 FROM supplier),
trade AS (SELECT 4 * o_custkey AS src, 4 * o_orderkey + 1 AS dst FROM orders),
supply AS (SELECT 4 * l_partkey + 2 AS src, 4 * l_suppkey + 3 AS dst FROM lineitem),
edges AS (
  SELECT * FROM trade UNION ALL SELECT * FROM supply
  UNION ALL SELECT 4 * l_orderkey + 1, 4 * l_partkey + 2 FROM lineitem),
degrees AS (SELECT src, count(*) AS degree FROM edges GROUP BY 1),
links AS MATERIALIZED (
  SELECT src, dst, count(*) / any_value(degree) AS share FROM edges JOIN degrees USING (src) GROUP BY src, dst)"""


COMPONENTS = f"""WITH RECURSIVE {GRAPH}, ends AS (SELECT * FROM trade UNION ALL SELECT * FROM supply),
    apart AS MATERIALIZED (SELECT src AS u, dst AS v FROM ends UNION SELECT dst, src FROM ends),
    labels(id, component) USING KEY (id) AS (SELECT id, id FROM nodes
    UNION SELECT v, min(component) FROM (SELECT apart.v, l.component FROM labels l JOIN apart ON u = l.id
    JOIN recurring.labels k ON k.id = apart.v WHERE l.component < k.component) GROUP BY v)"""


def _node(column: str, kind: int):
    return (4 * F.col(column) + kind).cast("bigint")


def _nodes(t, kinds=tuple(KINDS)):
    frames = [getattr(t, table).select(_node(*KINDS[table]).alias("id")) for table in kinds]
    return reduce(DataFrame.unionByName, frames)


def _edge(df, src, src_kind, dst, dst_kind):
    return df.select(_node(src, src_kind).alias("src"), _node(dst, dst_kind).alias("dst"))


def _trade(t):
    return _edge(t.orders, "o_custkey", 0, "o_orderkey", 1)


def _supply(t):
    return _edge(t.lineitem, "l_partkey", 2, "l_suppkey", 3)


def _edges(t):
    return _trade(t).unionByName(_supply(t)).unionByName(_edge(t.lineitem, "l_orderkey", 1, "l_partkey", 2))


def personalized_sql(sources, iterations: int, last: str) -> str:
    """The walk with one block of CTEs per iteration; ``last`` is the final statement over ``r``."""
    values = ", ".join(f"({s})" for s in sources)
    steps = [f"sources AS (SELECT source FROM (VALUES {values}) v(source))",
             "r0 AS (SELECT CAST(source AS BIGINT) AS id, CAST(source AS BIGINT) AS source, 1.0::DOUBLE AS rank FROM sources)"]
    for i in range(iterations):
        steps.append(
            f"m{i} AS MATERIALIZED (SELECT id, source, sum(mass) AS mass FROM ("
            f"SELECT dst AS id, source, rank * share AS mass FROM r{i} JOIN links ON src = id "
            "JOIN nodes ON nodes.id = dst UNION ALL SELECT source, source, 0.0 FROM sources) GROUP BY 1, 2)".replace("ON src = id", f"ON src = r{i}.id")
        )
        steps.append(f"x{i} AS (SELECT source, greatest(0.0, 1 - sum(mass)) AS missing FROM m{i} GROUP BY 1)")
        steps.append(
            f"r{i + 1} AS MATERIALIZED (SELECT id, source, 0.85 * mass + CASE WHEN id = source THEN 0.15 + 0.85 * missing ELSE 0 END AS rank "
            f"FROM m{i} JOIN x{i} USING (source))"
        )
    steps.append(f"r AS (SELECT nodes.id, s.source, coalesce(k.rank, 0.0) AS rank FROM nodes CROSS JOIN (SELECT CAST(source AS BIGINT) AS source FROM sources) s "
                 f"LEFT JOIN r{iterations} k ON k.id = nodes.id AND k.source = s.source)")
    return f"WITH {GRAPH}, " + ", ".join(steps) + " " + last


def uniform_sql(iterations: int) -> str:
    steps = ["total AS (SELECT count(*) AS n FROM nodes)", "r0 AS (SELECT id, 1.0::DOUBLE / n AS rank FROM nodes, total)"]
    for i in range(iterations):
        steps.append(f"m{i} AS MATERIALIZED (SELECT n.id, coalesce(sum(r.rank * share), 0.0) AS mass FROM nodes n "
                     f"LEFT JOIN links ON dst = n.id LEFT JOIN r{i} r ON r.id = src GROUP BY 1)")
        steps.append(f"r{i + 1} AS MATERIALIZED (SELECT id, 0.15 / n + 0.85 * (mass + (SELECT greatest(0.0, 1 - sum(mass)) FROM m{i}) / n) AS rank "
                     f"FROM m{i}, total)")
    return f"WITH {GRAPH}, " + ", ".join(steps) + f" SELECT id, round(rank, 10) AS rank, round(ln(rank), 8) AS log_rank FROM r{iterations}"


def _walk(t, sources=SOURCES, iterations=ITERATIONS):
    return R.personalized(_nodes(t), _edges(t), sources, iterations)


def _components(t):
    """Components of two of the three kinds of edges: with those from orders to parts as well,
    everything would be one component."""
    return weak_components(_nodes(t), _trade(t).unionByName(_supply(t)))


def _rounded(df, digits=8):
    return df.withColumn("rank", F.round("rank", digits))


def _shown(df):
    """Ranks in single precision, where the last bit of a double never decides."""
    return df.withColumn("rank", F.col("rank").cast("float").cast("double"))


def _state_after_one(t):
    """Kept edges, and the state of the walk after one iteration."""
    known, links = R.prepare(_nodes(t), _edges(t))
    state = R.personalized_step(R.start_at(known, SOURCES), links)
    return state, links


def _received(t):
    state, links = _state_after_one(t)
    return R.distribute(state, links, state.filter(F.col("id") == F.col("source")))


def _partition_facts(t, by_range):
    """One row: whether every key is in one partition, and whether ranges are disjoint."""
    placed = G.partition_graph(_edges(t), 16, by_range, "src").select("src", F.spark_partition_id().alias("part"))
    placed = cut_lineage(placed)
    keys = placed.groupBy("src").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("part").alias("parts"))
    before = F.max("last").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    ranges = placed.groupBy("part").agg(F.min("src").alias("first"), F.max("src").alias("last")).select("first", before.alias("before"))
    overlaps = ranges.agg(F.count_if(F.col("before") >= F.col("first")).alias("overlapping_ranges"))
    facts = keys.agg(F.sum("edges").alias("edges"), F.count(F.lit(1)).alias("keys"), F.count_if(F.col("parts") == 1).alias("keys_in_one_partition"))
    overlapping = overlaps.scalar() if by_range else F.lit(None).cast("bigint")
    return facts.select(F.lit("range" if by_range else "hash").alias("kind"), "edges", "keys", "keys_in_one_partition", overlapping.alias("overlapping_ranges"))


def _resumed(t):
    """Two iterations are stored, and two more go on from there."""
    base = scratch_path(t.spark, "walk")
    R.prepare_run(_nodes(t), _edges(t), SOURCES, base)
    R.run(t.spark, base, 0, ITERATIONS // 2)
    return R.all_nodes(_nodes(t), SOURCES, R.run(t.spark, base, ITERATIONS // 2, ITERATIONS))


def _vectors(t):
    """``id, ranks``: the ranks at the start in the order of the sources."""
    order = F.array_position(F.array(*[F.lit(s).cast("bigint") for s in SOURCES]), F.col("source"))
    placed = F.array_sort(F.collect_list(F.struct(order.alias("place"), "rank")))
    return R.all_nodes(_nodes(t), SOURCES).groupBy("id").agg(placed.alias("p")).select("id", F.col("p.rank").alias("ranks"))


def _lineitem_lines(t):
    """``order part supplier`` lines with uneven blanks, and lone customer ids."""
    lines = t.lineitem.select(F.concat(F.lit(" "), F.concat_ws("\t  ", "l_orderkey", "l_partkey", "l_suppkey")).alias("value"))
    return lines.unionByName(t.customer.select(F.col("c_custkey").cast("string").alias("value")))


def _adjacency(t):
    return parse_adjacency(_lineitem_lines(t))


def register(catalog: Catalog) -> None:
    add = catalog.add
    add("src_adjacency",
        lambda t: _adjacency(t).select("id", F.explode_outer("neighbors").alias("dst")).fillna(-1),
        """SELECT l_orderkey AS id, l_partkey AS dst FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey FROM lineitem
        UNION ALL SELECT c_custkey, -1 FROM customer""")
    add("graph_stats", lambda t: G.graph_stats(_nodes(t), _edges(t)),
        f"""WITH {GRAPH} SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges,
        (SELECT count(*) FROM degrees) AS active_nodes""")
    add("init_ranks", lambda t: R.all_nodes(_nodes(t), SOURCES),
        f"""WITH {GRAPH} SELECT id, CAST(s AS BIGINT) AS source, CASE WHEN id = s THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS rank
        FROM nodes, (VALUES {', '.join(f'({s})' for s in SOURCES)}) v(s)""")
    add("partition_graph", lambda t: _partition_facts(t, False).unionByName(_partition_facts(t, True)),
        f"""WITH {GRAPH} SELECT kind, count(*) AS edges, count(DISTINCT src) AS keys, count(DISTINCT src) AS keys_in_one_partition,
        CASE WHEN kind = 'range' THEN CAST(0 AS BIGINT) END AS overlapping_ranges FROM edges, (VALUES ('hash'), ('range')) v(kind) GROUP BY kind""")
    add("ppr_distribute", lambda t: _received(t).select("id", "source", F.round("mass", 8).alias("mass")),
        personalized_sql(SOURCES, 2, "SELECT id, source, round(mass, 8) AS mass FROM m1"))
    add("ppr_missing_mass",
        lambda t: R.missing_mass(_received(t)).withColumn("missing", F.round("missing", 8)),
        personalized_sql(SOURCES, 2, "SELECT CAST(source AS BIGINT) AS source, round(missing, 8) AS missing FROM x1"))
    add("ppr_jump", lambda t: _rounded(_state_after_one(t)[0].select("id", "source", "rank")),
        personalized_sql(SOURCES, 1, "SELECT id, source, round(rank, 8) AS rank FROM r1"))
    add("ppr", lambda t: _shown(_walk(t)), personalized_sql(SOURCES, ITERATIONS, f"SELECT id, source, {SHOWN} AS rank FROM r"))
    add("ppr_topk", lambda t: R.top_nodes(_shown(_walk(t)), 10),
        personalized_sql(SOURCES, ITERATIONS, f"""SELECT source, CAST(row_number() OVER (PARTITION BY source ORDER BY {SHOWN} DESC, id) AS INTEGER)
        AS position, id, {SHOWN} AS rank, printf('%.5f', {SHOWN}) AS score FROM r QUALIFY position <= 10"""))
    add("ppr_single", lambda t: _shown(_walk(t, SOURCES[:1]).drop("source")),
        personalized_sql(SOURCES[:1], ITERATIONS, f"SELECT id, {SHOWN} AS rank FROM r"))
    add("pagerank",
        lambda t: _rounded(R.uniform(_nodes(t), _edges(t), ITERATIONS), 10).withColumn("log_rank", F.round("log_rank", 8)),
        uniform_sql(ITERATIONS))
    add("ppr_resumed", lambda t: _shown(_resumed(t)), personalized_sql(SOURCES, ITERATIONS, f"SELECT id, source, {SHOWN} AS rank FROM r"))
    add("pagerank_report", lambda t: R.report(_rounded(R.uniform(_nodes(t), _edges(t), ITERATIONS), 10), 20),
        "SELECT CAST(row_number() OVER (ORDER BY rank DESC, id) AS INTEGER) AS position, id, printf('%.5f', log_rank) AS score FROM ("
        + uniform_sql(ITERATIONS) + ") ORDER BY rank DESC, id LIMIT 20")
    add("missing_structure",
        lambda t: G.missing_structure(_nodes(t, ("customer", "orders", "part")), _edges(t)),
        f"WITH {GRAPH} SELECT dst, count(*) AS n FROM supply GROUP BY 1")
    add("duplicate_structure", lambda t: G.duplicate_structure(G.nodes_of(_adjacency(t))),
        """SELECT id, count(*) AS n FROM (SELECT l_orderkey AS id FROM lineitem UNION ALL SELECT c_custkey FROM customer)
        GROUP BY 1 HAVING count(*) > 1""")
    add("weak_components", _components, f"{COMPONENTS} SELECT id, component FROM labels")
    add("component_count", lambda t: component_count(_components(t)), f"{COMPONENTS} SELECT count(DISTINCT component) AS components FROM labels")
    add("dump_text",
        lambda t: G.readable(_vectors(t), _edges(t)),
        f"""WITH {GRAPH}, lists AS (SELECT src AS id, list(dst ORDER BY dst) AS l FROM edges GROUP BY 1)
        SELECT '{{' || nodes.id || ' [' || {" || ', ' || ".join(f"CASE WHEN nodes.id = {s} THEN '1.0' ELSE '0.0' END" for s in SOURCES)} || '] ['
        || coalesce(array_to_string(l[1:10], ', '), '') || CASE WHEN len(l) > 10 THEN ' ... (' || (len(l) - 10) || ' more) ]' ELSE ']' END || '}}' AS value
        FROM nodes LEFT JOIN lists ON lists.id = nodes.id""")
