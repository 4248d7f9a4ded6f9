import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import graph as G
from tidemill.operators import rank as R
from tidemill.operators.components import component_count, weak_components
from tidemill.sources.text import parse_adjacency, read_adjacency


@pytest.fixture(scope="module")
def make(spark):
    def build(*lines):
        adjacency = parse_adjacency(spark.createDataFrame([(s,) for s in lines], "value string"))
        return G.nodes_of(adjacency), G.edges_of(adjacency)

    return build


def reference_walk(lines, source, iterations, jump=0.15):
    """Plain power iteration with all lost mass going back to the source."""
    adjacency = {int(s.split()[0]): [int(x) for x in s.split()[1:]] for s in lines}
    rank = {n: float(n == source) for n in adjacency}
    for _ in range(iterations):
        got = dict.fromkeys(adjacency, 0.0)
        for n, out in adjacency.items():
            for m in out:
                if m in got:
                    got[m] += rank[n] / len(out)
        missing = max(0.0, 1 - sum(got.values()))
        rank = {n: (1 - jump) * (g + (missing if n == source else 0)) + (jump if n == source else 0) for n, g in got.items()}
    return rank


def test_parse_adjacency(spark, tmp_path):
    (tmp_path / "g.txt").write_text(" 1 2\t3 3\n2  3\n3\n")
    got = sorted((r["id"], r["neighbors"]) for r in read_adjacency(spark, str(tmp_path / "g.txt")).collect())
    assert got == [(1, [2, 3, 3]), (2, [3]), (3, [])]


def test_hand_worked_walk(make):
    nodes, edges = make("1 2 3", "2 3", "3")
    for iterations, want in [(1, [0.15, 0.425, 0.425]), (2, [0.51125, 0.06375, 0.425])]:
        got = {r["id"]: r["rank"] for r in R.personalized(nodes, edges, [1], iterations).collect()}
        assert [got[i] for i in (1, 2, 3)] == pytest.approx(want)


def test_stats_and_checks(make, rows):
    nodes, edges = make("1 2 3", "2 3", "3")
    assert rows(G.graph_stats(nodes, edges)) == [(3, 3, 2)]
    nodes, edges = make("1 2 2 9", "2", "2 1")
    assert rows(G.missing_structure(nodes, edges)) == [(9, 1)]
    assert rows(G.duplicate_structure(nodes)) == [(2, 2)]
    with pytest.raises(ValueError):
        G.require_unique(nodes)
    with pytest.raises(Exception, match="2 records for node 2"):
        R.personalized(nodes, edges, [1], 1)


def test_an_absent_source_is_an_error_everywhere(make, tmp_path):
    nodes, edges = make("1 2", "2")
    known, _ = R.prepare(nodes, edges)
    for run in (lambda: R.personalized(nodes, edges, [1, 77], 1), lambda: R.start_at(known, [1, 77]), lambda: R.all_nodes(nodes, [77]),
                lambda: R.prepare_run(nodes, edges, [77], str(tmp_path / "walk"))):
        with pytest.raises(ValueError, match="77"):
            run()


LINES = ["0 1 2 3 4 5 6 7 8 9", "1 0 0 2", "2 0 99", "3", "4 3 5", "5 0", "6 7", "7 6 6 6 0", "8", "9 0 1"]


@pytest.mark.parametrize("options", [{}, {"edges_per_part": 2, "hot_rows": 1}])
def test_walk_equals_plain_iteration(make, options):
    """Copies of edges, dangling nodes, an edge to nowhere; also with edges split into parts."""
    nodes, edges = make(*LINES)
    got = R.personalized(nodes, edges, [0, 4, 8], 5, **options)
    for source in (0, 4, 8):
        want = reference_walk(LINES, source, 5)
        have = {r["id"]: r["rank"] for r in got.filter(F.col("source") == source).collect()}
        assert have == pytest.approx(want) and sum(have.values()) == pytest.approx(1)


def test_steps(make, rows):
    nodes, edges = make("1 2 3", "2 3", "3")
    known, links = R.prepare(nodes, edges)
    state = R.start_at(known, [1, 3])
    received = R.distribute(state, links, state)
    assert {(i, s): m for i, s, m, _ in rows(received)} == {(1, 1): 0.0, (2, 1): 0.5, (3, 1): 0.5, (3, 3): 0.0}
    assert rows(R.missing_mass(received)) == [(1, 0.0), (3, 1.0)]
    assert {(i, s): r for i, s, r in rows(R.all_nodes(nodes, [1, 3])) if r} == {(1, 1): 1.0, (3, 3): 1.0}


def test_stored_iterations_can_be_resumed(spark, make, tmp_path):
    nodes, edges = make(*LINES)
    base = str(tmp_path / "walk")
    R.prepare_run(nodes, edges, [0], base)
    R.run(spark, base, 0, 2)
    last = R.all_nodes(nodes, [0], R.run(spark, base, 2, 4))
    assert {r["id"]: r["rank"] for r in last.collect()} == pytest.approx(reference_walk(LINES, 0, 4))


def test_uniform_rank(make):
    nodes, edges = make("1 2", "2 1", "3 1", "4")
    got = {r["id"]: r["rank"] for r in R.uniform(nodes, edges, 3).collect()}
    rank = dict.fromkeys((1, 2, 3, 4), 0.25)
    for _ in range(3):
        mass = {1: rank[2] + rank[3], 2: rank[1], 3: 0.0, 4: 0.0}
        lost = 1 - sum(mass.values())
        rank = {n: 0.0375 + 0.85 * (m + lost / 4) for n, m in mass.items()}
    assert got == pytest.approx(rank) and sum(got.values()) == pytest.approx(1)


def test_top_nodes(make):
    nodes, edges = make(*LINES)
    best = R.top_nodes(R.personalized(nodes, edges, [0, 4], 3), 3).orderBy("source", "position").collect()
    assert [(r["source"], r["position"]) for r in best] == [(s, p) for s in (0, 4) for p in (1, 2, 3)]
    assert best[0]["id"] == 0 and best[0]["score"] == f"{best[0]['rank']:.5f}"


def test_partitioning_keeps_rows_and_keys_together(make, rows):
    _, edges = make(*LINES)
    for by_range in (False, True):
        parted = G.partition_graph(edges, 3, by_range, "src")
        assert rows(parted) == rows(edges)
        placed = parted.select("src", F.spark_partition_id().alias("part")).collect()
        places = {}
        for r in placed:
            places.setdefault(r["src"], set()).add(r["part"])
        assert all(len(p) == 1 for p in places.values()) and 1 < len({r["part"] for r in placed}) <= 3
        if by_range:
            order = [p.pop() for _, p in sorted(places.items())]
            assert order == sorted(order)


def test_rank_report(make):
    nodes, edges = make("1 2", "2 1", "3 1", "4")
    ranks = R.uniform(nodes, edges, 3)
    logs = {r["id"]: r["log_rank"] for r in ranks.collect()}
    got = R.report(ranks, 2).orderBy("position").collect()
    best = sorted(logs, key=lambda i: (-logs[i], i))[:2]
    assert [(r["position"], r["id"], r["score"]) for r in got] == [(k + 1, i, f"{logs[i]:.5f}") for k, i in enumerate(best)]


def test_readable(spark, make):
    nodes, edges = make("1 " + " ".join(str(i) for i in range(2, 14)), "2")
    ranks = nodes.withColumn("ranks", F.array(F.lit(0.5), F.lit(0.0)))
    assert sorted(r[0] for r in G.readable(ranks, edges).collect()) == [
        "{1 [0.5, 0.0] [2, 3, 4, 5, 6, 7, 8, 9, 10, 11 ... (2 more) ]}",
        "{2 [0.5, 0.0] []}",
    ]


def find_components(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(n)}


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_components(spark, hot_rows):
    chance = random.Random(3)
    pairs = [(chance.randrange(120), chance.randrange(120)) for _ in range(70)]
    pairs += [(i, i + 1) for i in range(130, 150)] + [(160, i) for i in range(161, 175)] + [(200, 200)]
    nodes = spark.range(210).select("id")
    edges = spark.createDataFrame(pairs, "src bigint, dst bigint")
    labels = weak_components(nodes, edges, hot_rows)
    assert {r["id"]: r["component"] for r in labels.collect()} == find_components(210, pairs)
    assert component_count(labels).first()[0] == len(set(find_components(210, pairs).values()))


def test_components_without_edges(spark, rows):
    edges = spark.createDataFrame([], "src bigint, dst bigint")
    assert rows(weak_components(spark.range(3).select("id"), edges)) == [(0, 0), (1, 1), (2, 2)]


ODD = [(1, 2), (1, 2), (1, 2), (1, 3), (1, 4), (1, None), (2, 1), (3, 99), (3, 1), (None, 1), (77, 1), (77, 2), (77, 3)]


@pytest.mark.parametrize("options", [{}, {"edges_per_part": 2, "hot_rows": 1}])
def test_uniform_rank_of_odd_edges(spark, options):
    """Copies, edges to or from no node and nulls; also with edges split into parts."""
    nodes, edges = spark.range(1, 6).select("id"), spark.createDataFrame(ODD, "src bigint, dst bigint")
    got = {r["id"]: r["rank"] for r in R.uniform(nodes, edges, 4, **options).collect()}
    walk = {r["id"]: r["rank"] for r in R.personalized(nodes, edges, [1], 4, **options).collect()}
    uniform, personal = dict.fromkeys(range(1, 6), 0.2), {n: float(n == 1) for n in range(1, 6)}
    degree = {s: sum(1 for a, _ in ODD if a == s) for s, _ in ODD}

    def arrived(rank):
        mass = dict.fromkeys(rank, 0.0)
        for s, d in ODD:
            if s in rank and d in rank:
                mass[d] += rank[s] / degree[s]
        return mass, 1 - sum(mass.values())

    for _ in range(4):
        mass, lost = arrived(uniform)
        uniform = {n: 0.03 + 0.85 * (m + lost / 5) for n, m in mass.items()}
        mass, lost = arrived(personal)
        personal = {n: 0.85 * m + (n == 1) * (0.15 + 0.85 * lost) for n, m in mass.items()}
    assert got == pytest.approx(uniform) and walk == pytest.approx(personal)


@pytest.mark.parametrize("landed", [True, False])
def test_edges_are_kept_as_pieces(spark, landed):
    """A step reads a row per node and piece, not one per edge, and no piece grows with the node or with copies."""
    edges = spark.range(4000).select((F.col("id") % 40).alias("src"), (F.col("id") % 1000).alias("dst"))
    edges = edges.union(spark.range(900).select(F.lit(7), F.col("id"))).union(spark.range(5000).select(F.lit(8), F.lit(9)))
    _, links = R.prepare(spark.range(1000).select("id"), edges, edges_per_part=200, landed=landed)
    kept = links.select("src", "part", "share", F.size("targets").alias("n")).collect()
    assert len(kept) < 120 and max(r["n"] for r in kept) <= 300
    sent = {}
    for r in kept:
        sent[r["src"]] = sent.get(r["src"], 0) + r["share"] * r["n"]
    assert sent == pytest.approx(dict.fromkeys(range(40), 1.0))
