"""Random-walk ranks: personalized for several sources at once, and uniform.

A walk state has a row per reached node and source: ``id, source, rank, parts``. ``parts`` is
the number of pieces the out-edges of the node are stored in, 0 for a node without any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.operators.graph import require_nodes
from tidemill.runtime import attach, cut_lineage, keep_partitioned
from tidemill.sources.sinks import write_table

JUMP = 0.15
EDGES_PER_PART = 100_000


def _adjacency(placed: DataFrame) -> DataFrame:
    """A row per piece of a node's out-edges with one share: ``src, part, share, dst_parts, targets``.

    Edges that know the parts of their target make several rows of a piece, whose sum is the degree.
    """
    landed = "dst_parts" in placed.columns
    rest = ["dst_parts"] if landed else []
    lists = placed.groupBy("src", "part", "degree", "copies", *rest).agg(
        F.collect_list("dst").alias("targets"), (F.col("copies") * F.count(F.lit(1))).alias("sent")
    )
    whole = F.sum("sent").over(Window.partitionBy("src", "part")) if landed else F.col("sent")
    parts = F.col("dst_parts") if landed else F.lit(None).cast("int").alias("dst_parts")
    return lists.select("src", "part", (F.col("copies") / F.coalesce("degree", whole)).alias("share"), parts, "targets")


def _placed(edges: DataFrame, heavy: DataFrame, edges_per_part: int) -> DataFrame:
    """``src, part, degree, copies, dst``: edges with the piece they belong to.

    Only the copies of edges of nodes with several pieces are united, which have a ``degree`` here; the
    others are one piece of bounded size as they are. ``heavy`` has fewer rows than there are pieces
    of ``edges_per_part`` edges, and is broadcast.
    """
    one = F.lit(1).cast("bigint")
    plain = edges.select("src", F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("degree"), one.alias("copies"), "dst")
    if heavy.isEmpty():
        return plain
    known = F.broadcast(heavy)
    pieces = F.ceil(F.col("degree") / edges_per_part)
    united = edges.join(known, "src").groupBy("src", "degree", "dst").agg(F.count(F.lit(1)).alias("copies"))
    part = F.pmod(F.xxhash64("dst"), pieces).cast("int")
    return plain.join(known.select("src"), "src", "left_anti").unionByName(united.withColumn("part", part))


def prepare(
    nodes: DataFrame,
    edges: DataFrame,
    edges_per_part: int = EDGES_PER_PART,
    hot_rows: int | None = None,
    landed: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Nodes as ``id, parts`` and edges as ``src, part, share, dst_parts, targets``, both kept.

    The edges are written once, gathered, partitioned and sorted by (src, part) for the joins of the
    steps. ``share`` is what a node sends to each target; copies of an edge count repeatedly. The
    out-edges of a node with a great many are stored in several parts, so that each step joins
    ranks with pieces of bounded size. Edges to ids without a node are left out after the shares
    are set; their mass then counts as missing. Without ``landed`` they stay, and ``dst_parts`` is
    null: a walk that starts with every node at home drops them where they arrive. Two records
    for one id are an error when the nodes are read.
    """
    edges = edges.filter(F.col("src").isNotNull())
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    marks = nodes.select("id", one.alias("records"), zero.alias("degree"), zero.alias("origins")).union(
        edges.select("src", zero, one, zero)
    )
    if landed:
        marks = marks.union(edges.groupBy("dst").agg(F.count(F.lit(1)).alias("n")).select("dst", zero, zero, "n"))
    sized = cut_lineage(marks.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("records", "degree", "origins")]))
    twice = F.raise_error(F.format_string("%d records for node %d", "records", "id")).cast("int")
    parts = F.ceil(F.col("degree") / edges_per_part).cast("int")
    known = sized.filter(F.col("records") > 0).select(
        "id", F.when(F.col("records") > 1, twice).otherwise(parts).alias("parts"), "origins"
    )
    heavy = sized.filter(F.col("degree") > edges_per_part).select(F.col("id").alias("src"), "degree")
    placed = _placed(edges, heavy, edges_per_part)
    if landed:
        targets = known.select(F.col("id").alias("dst"), F.col("parts").alias("dst_parts"), "origins")
        placed = attach(placed, targets, ["dst"], ["src"], "origins", "left", hot_rows).drop("origins")
    links = keep_partitioned(placed, "src", "part", then=_adjacency)
    return known.select("id", "parts"), links.filter(F.col("dst_parts").isNotNull()) if landed else links


def start_at(known: DataFrame, sources: Sequence[int]) -> DataFrame:
    """All mass of each source at the source itself; a source without a node is an error."""
    require_nodes(known, list(sources))
    return known.filter(F.col("id").isin(*sources)).select(
        "id", F.col("id").alias("source"), F.lit(1.0).alias("rank"), "parts"
    )


def distribute(state: DataFrame, edges: DataFrame, home: DataFrame) -> DataFrame:
    """``id, source, mass, parts``: what arrives when every node sends its rank along its edges.

    ``home`` rows are kept even if nothing arrives. Mass is summed inside the tasks before the
    shuffle by target.
    """
    sent = state.filter(F.col("parts") > 0).select(
        F.col("id").alias("src"), "source", "rank", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    arrived = sent.join(edges, ["src", "part"]).select(
        F.explode("targets").alias("id"), "source", (F.col("rank") * F.col("share")).alias("mass"), F.col("dst_parts").alias("parts")
    )
    return (
        arrived.unionByName(home.select("id", "source", F.lit(0.0).alias("mass"), "parts"))
        .groupBy("id", "source")
        .agg(F.sum("mass").alias("mass"), F.max("parts").alias("parts"))
    )


def missing_mass(received: DataFrame) -> DataFrame:
    """``source, missing``: the part of each source's mass that no node received, at least 0."""
    return received.groupBy("source").agg(F.greatest(F.lit(0.0), 1 - F.sum("mass")).alias("missing"))


def jump_home(received: DataFrame, missing: DataFrame, jump: float = JUMP) -> DataFrame:
    """Next state: the jump and all missing mass go to the source.

    ``missing`` has one row per source, a list the caller passed in, and is broadcast.
    """
    stay = (1 - jump) * F.col("mass")
    back = F.when(F.col("id") == F.col("source"), jump + (1 - jump) * F.col("missing")).otherwise(0.0)
    joined = received.join(F.broadcast(missing), "source")
    return joined.select("id", "source", (stay + back).alias("rank"), "parts")


def personalized_step(state: DataFrame, edges: DataFrame, jump: float = JUMP) -> DataFrame:
    """One iteration. What arrived is computed once and kept, then read for both uses."""
    home = state.filter(F.col("id") == F.col("source"))
    received = cut_lineage(distribute(state, edges, home))
    return jump_home(received, missing_mass(received), jump)


def all_nodes(nodes: DataFrame, sources: Sequence[int], state: DataFrame | None = None) -> DataFrame:
    """``id, source, rank`` for every node and source, 0 where a source does not reach.

    Without a state this is the rank vector at the start.
    """
    require_nodes(nodes, list(sources))
    every = nodes.select("id", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sources])).alias("source"))
    if state is None:
        return every.withColumn("rank", F.when(F.col("id") == F.col("source"), 1.0).otherwise(0.0))
    reached = state.select("id", "source", "rank")
    return every.join(reached, ["id", "source"], "left").withColumn("rank", F.coalesce("rank", F.lit(0.0)))


def personalized(
    nodes: DataFrame,
    edges: DataFrame,
    sources: Sequence[int],
    iterations: int,
    jump: float = JUMP,
    **options: int,
) -> DataFrame:
    """``id, source, rank`` of every node for each source after a number of iterations."""
    known, links = prepare(nodes, edges, **options)
    state = start_at(known, sources)
    for _ in range(iterations):
        state = personalized_step(state, links, jump)
    return all_nodes(nodes, sources, state)


def _iteration(base: str, number: int) -> str:
    return f"{base}/iter{number:04d}"


def prepare_run(nodes: DataFrame, edges: DataFrame, sources: Sequence[int], base: str) -> None:
    """Store the edges and iteration 0 of a walk under ``base``."""
    known, links = prepare(nodes, edges)
    write_table(links, f"{base}/edges")
    write_table(start_at(known, sources), _iteration(base, 0))


def run(spark: SparkSession, base: str, start: int, end: int, jump: float = JUMP) -> DataFrame:
    """Go on from stored iteration ``start`` and store each one up to ``end``."""
    edges = keep_partitioned(spark.read.parquet(f"{base}/edges"), "src", "part")
    state = spark.read.parquet(_iteration(base, start))
    for number in range(start, end):
        state = write_table(personalized_step(state, edges, jump), _iteration(base, number + 1))
    return state


def uniform(nodes: DataFrame, edges: DataFrame, iterations: int, jump: float = JUMP, **options: int) -> DataFrame:
    """``id, rank, log_rank``: jump and missing mass are shared by all nodes alike."""
    known, links = prepare(nodes, edges, landed=False, **options)
    total = known.count()
    home = known.select("id", F.lit(0).cast("bigint").alias("source"), "parts")
    state = home.withColumn("rank", F.lit(1.0 / total))
    for _ in range(iterations):
        # Every node is at home and knows its parts; what arrives elsewhere is missing.
        received = cut_lineage(distribute(state, links, home).filter(F.col("parts").isNotNull()))
        missing: Column = missing_mass(received).select("missing").scalar()
        rank = jump / total + (1 - jump) * (F.col("mass") + missing / total)
        state = received.select("id", "source", rank.alias("rank"), "parts")
    return state.select("id", "rank", F.log("rank").alias("log_rank"))


def report(ranks: DataFrame, k: int) -> DataFrame:
    """``position, id, score``: the ``k`` best nodes of a uniform rank with their log rank."""
    best = ranks.orderBy(F.desc("rank"), "id").limit(k)
    position = F.row_number().over(Window.orderBy(F.desc("rank"), "id"))
    return best.select(position.alias("position"), "id", F.format_string("%.5f", "log_rank").alias("score"))


def top_nodes(ranks: DataFrame, k: int) -> DataFrame:
    """The ``k`` best nodes per source; every task passes on at most ``k`` of each."""
    best = Window.partitionBy("source").orderBy(F.desc("rank"), "id")
    ranked = ranks.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= k)
    return ranked.select("source", "position", "id", "rank", F.format_string("%.5f", "rank").alias("score"))
