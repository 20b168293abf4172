"""Networks: published goldens, brute force on small random networks, a hub with many edges."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from opsmart.operators import betweenness, blocks, graph

# The 15-node network of the published example (miles).
LINES = [
    ("COMANCHE_PLANT", "CS_TRANS_HUB", 8), ("COMANCHE_PLANT", "PUE_HUB", 5), ("CS_TRANS_HUB", "DEN_TRANS_HUB", 70),
    ("CS_TRANS_HUB", "CS_NORTH_SUB", 8), ("CS_TRANS_HUB", "CS_SOUTH_SUB", 10), ("CS_TRANS_HUB", "PUE_HUB", 45),
    ("DEN_TRANS_HUB", "DEN_NORTH_SUB", 6), ("DEN_TRANS_HUB", "DEN_SOUTH_SUB", 8), ("DEN_TRANS_HUB", "DEN_EAST_SUB", 10),
    ("DEN_TRANS_HUB", "BLD_HUB", 28), ("DEN_TRANS_HUB", "FC_HUB", 65), ("PAWNEE_PLANT", "FC_HUB", 12),
    ("PAWNEE_PLANT", "BLD_HUB", 40), ("BLD_HUB", "FC_HUB", 45), ("BLD_HUB", "BLD_EAST_SUB", 5),
    ("FC_HUB", "FC_SOUTH_SUB", 6), ("PUE_HUB", "PUE_NORTH_SUB", 7),
]
DEGREE = {"DEN_TRANS_HUB": 0.4286, "CS_TRANS_HUB": 0.3571, "COMANCHE_PLANT": 0.1429, "BLD_HUB": 0.2857,
          "FC_HUB": 0.2857, "PUE_HUB": 0.2143, "PAWNEE_PLANT": 0.1429}
BETWEENNESS = {"DEN_TRANS_HUB": 0.7253, "CS_TRANS_HUB": 0.5714, "COMANCHE_PLANT": 0.2637, "BLD_HUB": 0.2527,
               "FC_HUB": 0.1429, "PUE_HUB": 0.1429}


@pytest.fixture(scope="module")
def power(spark):
    edges = spark.createDataFrame(LINES, "src string, dst string, weight long").cache()
    names = sorted({n for line in LINES for n in line[:2]})
    return spark.createDataFrame([(n,) for n in names], "node string"), edges


def test_power_grid_scores(power):
    nodes, edges = power
    got = {r["node"]: (r["degree_centrality"], r["betweenness_centrality"]) for r in betweenness.scored_nodes(nodes, edges).collect()}
    assert len(got) == 15
    for node, (degree, between) in got.items():
        assert degree == DEGREE.get(node, 0.0714)
        assert between == BETWEENNESS.get(node, 0.0)


def test_power_grid_path_and_failure(spark, power):
    nodes, edges = power
    path = [(r["node"], r["distance"]) for r in graph.shortest_path(edges, "COMANCHE_PLANT", "FC_HUB").orderBy("step").collect()]
    assert path == [("COMANCHE_PLANT", 0), ("CS_TRANS_HUB", 8), ("DEN_TRANS_HUB", 78), ("FC_HUB", 143)]
    assert graph.is_connected(graph.connected_components(edges, nodes))
    left = graph.islands_without(edges, nodes, spark.createDataFrame([("DEN_TRANS_HUB",)], "node string"))
    sizes = sorted(r["size"] for r in graph.component_sizes(left).collect())
    assert sizes == [1, 1, 1, 5, 6] and not graph.is_connected(left)
    counts = graph.counts(edges, nodes).first()
    assert (counts["nodes"], counts["edges"]) == (15, 17)


def nation_edges():
    tree = [(n // 2, n, 1 + n % 5) for n in range(1, 25)]
    chords = [(n, (7 * n + 3) % 25, 3 + n % 7) for n in range(0, 25, 4) if n != (7 * n + 3) % 25]
    return tree, chords


def test_network_with_equal_paths(spark):
    tree, chords = nation_edges()
    edges = spark.createDataFrame(tree + chords, "src int, dst int, weight int")
    nodes = spark.range(25).select(F.col("id").cast("int").alias("node"))
    got = [r["distance"] for r in graph.shortest_distances(edges, 0).orderBy("node").collect()]
    assert got == [0, 2, 5, 3, 10, 6, 5, 6, 14, 15, 7, 8, 8, 9, 11, 7, 12, 17, 17, 20, 8, 9, 11, 12, 13]
    golden = {2: 0.4185, 5: 0.4149, 3: 0.2826, 4: 0.2464, 1: 0.2391, 10: 0.2083, 6: 0.1975, 7: 0.1739}
    plain = {r["node"]: r["betweenness_centrality"] for r in betweenness.betweenness_centrality(edges, nodes).collect()}
    batched = {r["node"]: r["betweenness_centrality"] for r in betweenness.betweenness_centrality(edges, nodes, whole_steps=0, links_in_memory=0, rows_per_batch=100).collect()}
    assert {n: round(plain[n], 4) for n in golden} == golden
    assert all(abs(plain[n] - batched[n]) < 1e-12 for n in plain)
    islands = graph.connected_components(spark.createDataFrame(chords, "src int, dst int, weight int"), nodes)
    assert graph.component_sizes(islands).count() == 19


def brute_betweenness(n, edges):
    """All pairs, all shortest paths, counted on the distance matrix."""
    inf = float("inf")
    w = {}
    for a, b, c in edges:
        if a != b:
            w[a, b] = w[b, a] = min(c, w.get((a, b), inf))
    d = [[0 if i == j else w.get((i, j), inf) for j in range(n)] for i in range(n)]
    for k, i, j in itertools.product(range(n), repeat=3):
        d[i][j] = min(d[i][j], d[i][k] + d[k][j])
    ways = [[0] * n for _ in range(n)]
    for s in range(n):
        for v in sorted(range(n), key=lambda x: d[s][x]):
            if d[s][v] < inf:
                ways[s][v] = 1 if v == s else sum(ways[s][u] for u in range(n) if (u, v) in w and d[s][u] + w[u, v] == d[s][v])
    score = [0.0] * n
    for s, t in itertools.combinations(range(n), 2):
        if d[s][t] < inf:
            for v in range(n):
                if v not in (s, t) and d[s][v] + d[v][t] == d[s][t]:
                    score[v] += ways[s][v] * ways[v][t] / ways[s][t]
    return [x * 2 / ((n - 1) * (n - 2)) for x in score]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_networks_against_brute_force(spark, seed):
    """Several components, hanging trees, pairs, isolated nodes, parallel edges and self-loops."""
    rng = random.Random(seed)
    n = 26
    edges = [(rng.randrange(18), rng.randrange(18), rng.randint(1, 4)) for _ in range(20)] + [(20, 21, 1), (22, 23, 2), (23, 24, 1), (3, 3, 1)]
    df = spark.createDataFrame(edges, "src long, dst long, weight long")
    nodes = spark.range(n).withColumnRenamed("id", "node")
    got = {r["node"]: r["betweenness_centrality"] for r in betweenness.betweenness_centrality(df, nodes).collect()}
    for node, expected in enumerate(brute_betweenness(n, edges)):
        assert abs(got[node] - expected) < 1e-9, node
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b, _ in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    found = {r["node"]: r["component"] for r in graph.connected_components(df, nodes).collect()}
    assert found == {x: find(x) for x in range(n)}


def test_hub_and_chain(spark):
    """A hub with a third of all edges and a long chain end up in the right components."""
    hub = spark.range(1, 3001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"), F.lit(1).alias("weight"))
    chain = spark.range(10000, 16000).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("weight"))
    edges = hub.unionByName(chain)
    nodes = spark.range(0, 3001).unionByName(spark.range(10000, 16001)).withColumnRenamed("id", "node")
    sizes = {r["component"]: r["size"] for r in graph.component_sizes(graph.connected_components(edges, nodes)).collect()}
    assert sizes == {0: 3001, 10000: 6001}


def test_unreachable_and_trivial_paths(spark):
    edges = spark.createDataFrame([(1, 2, 1), (3, 4, 1)], "src int, dst int, weight int")
    assert graph.shortest_path(edges, 1, 4).count() == 0
    assert [tuple(r) for r in graph.shortest_path(edges, 1, 1).collect()] == [(0, 1, 0)]


def smallest_reached(nodes, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return sorted(((n, n if n is None else find(n)) for n in nodes), key=str)


@pytest.mark.parametrize("turned", [False, True])
def test_ends_with_one_link_leave_before_the_rounds(spark, monkeypatch, turned):
    """3,000 orders of ten shipments each, of which every tenth order shares one with the order before: rounds get the shared ones only."""
    links = spark.range(30000).select((F.col("id") / 10).cast("long").alias("src"), (-1 - F.col("id")).alias("dst"))
    common = spark.range(9, 3000, 10).select(F.col("id").alias("src"), (-1 - (F.col("id") - 1) * 10).alias("dst"))
    edges = links.unionByName(common)
    if turned:
        edges = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    nodes = spark.range(3000).unionByName(spark.range(30000).select((-1 - F.col("id")).alias("id"))).withColumnRenamed("id", "node")
    written, real = [], graph.materialize_counted

    def counting(df, **values):
        table, seen = real(df, **values)
        written.append((table.columns, seen["rows"]))
        return table, seen

    monkeypatch.setattr(graph, "materialize_counted", counting)
    found = graph.connected_components(edges, nodes)
    assert sum(rows for columns, rows in written if columns == ["a", "b"] or columns == ["root_a", "root_b"]) <= 600
    assert found.count() == 33000
    sizes = {r["size"]: r["count"] for r in graph.component_sizes(found).groupBy("size").count().collect()}
    assert sizes == {11: 2400, 22: 300}
    assert found.filter("component > node").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_links_that_go_both_ways(spark, seed):
    """Targets that are sources too, double and turned links, self-loops, nulls, ends that are no node, nodes that come twice."""
    rng = random.Random(seed)
    some = lambda: None if rng.random() < 0.05 else f"n{rng.randrange(60):02d}"
    edges = [(some(), some()) for _ in range(30)]
    edges += [(b, a) for a, b in edges[:8]] + edges[:5] + [("n03", "n03"), ("n70", "n71"), ("n71", "n72"), ("n70", "n72")]
    nodes = [f"n{i:02d}" for i in range(5, 75)] + ["n08", "n70", None]
    found = graph.connected_components(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame([(n,) for n in nodes], "node string"))
    assert sorted(((r["node"], r["component"]) for r in found.collect()), key=str) == smallest_reached(nodes, edges)


def test_connected_means_one_component(spark):
    connected = lambda *names: graph.is_connected(spark.createDataFrame([(n,) for n in names], "component long"))
    assert connected(4, 4) and connected(None, None)
    assert not connected() and not connected(4, 5) and not connected(4, None)
