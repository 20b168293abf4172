"""Biconnected blocks, betweenness over them, and what shortest distances write."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_graph import brute_betweenness

from opsmart.operators import betweenness, blocks, graph


def network(spark, edges, n):
    return spark.createDataFrame(edges, "src long, dst long, weight long"), spark.range(n).withColumnRenamed("id", "node")


def plain_blocks(edges):
    """Sets of links that share a block: two links do where they lie on a common cycle without repeated nodes."""
    neighbours, number, low, stack, out = defaultdict(set), {}, {}, [], []
    for a, b, _ in edges:
        if a != b:
            neighbours[a].add(b)
            neighbours[b].add(a)

    def visit(node, up):
        number[node] = low[node] = len(number)
        for other in sorted(neighbours[node]):
            if other not in number:
                stack.append((node, other))
                visit(other, node)
                low[node] = min(low[node], low[other])
                if low[other] >= number[node]:
                    block = set()
                    while True:
                        link = stack.pop()
                        block.add(frozenset(link))
                        if link == (node, other):
                            break
                    out.append(frozenset(block))
            elif other != up and number[other] < number[node]:
                stack.append((node, other))
                low[node] = min(low[node], number[other])

    for node in sorted(neighbours):
        if node not in number:
            visit(node, None)
    return set(out)


def test_blocks_equal_a_depth_first_search(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(40), rng.randrange(40), 1) for _ in range(44)] + [(50, 51, 1), (51, 52, 1), (50, 52, 1), (52, 53, 1)]
    df, nodes = network(spark, edges, 60)
    weights = nodes.withColumn("reach", F.lit(1.0))
    cut = blocks.biconnected_blocks(graph.arcs(df), weights)
    found = defaultdict(set)
    for r in cut.links.collect():
        found[r["block"]].add(frozenset((r["src"], r["dst"])))
    assert {frozenset(b) for b in found.values()} == plain_blocks(edges)
    size = {r["root"]: r["size"] for r in cut.sizes.collect()}
    for block, links in found.items():
        members = cut.members.filter(F.col("block") == block).collect()
        assert {r["node"] for r in members} == set().union(*links)
        assert sum(r["outside"] for r in members) == size[members[0]["root"]]


@pytest.mark.parametrize("links_in_memory", [0, 1000])
def test_blocks_against_brute_force(spark, links_in_memory):
    """A ring of rings with hanging trees and chains, cut into blocks; searched in tasks and with joins."""
    rng = random.Random(7)
    edges = [(i, (i + 1) % 6, rng.randint(1, 3)) for i in range(6)] + [(0, 3, 2)]
    for k in range(3):
        at = 6 + 4 * k
        edges += [(k, at, 1), (at, at + 1, 1), (at + 1, at + 2, 2), (at + 2, at + 3, 1), (at + 3, at, 2)]
    edges += [(18, 19, 1), (19, 20, 1), (20, 7, 1), (21, 22, 1), (22, 23, 1), (23, 21, 1)]
    df, nodes = network(spark, edges, 25)
    found = betweenness.betweenness_centrality(df, nodes, whole_steps=0, links_in_memory=links_in_memory, rows_per_batch=40)
    got = {r["node"]: r["betweenness_centrality"] for r in found.collect()}
    for node, expected in enumerate(brute_betweenness(25, edges)):
        assert abs(got[node] - expected) < 1e-9, node


def test_a_block_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(betweenness, "STEPS_PER_TASK", 50)
    rng = random.Random(9)
    edges = [(rng.randrange(30), rng.randrange(30), rng.randint(1, 5)) for _ in range(60)]
    df, nodes = network(spark, edges, 30)
    got = {r["node"]: r["betweenness_centrality"] for r in betweenness.betweenness_centrality(df, nodes).collect()}
    for node, expected in enumerate(brute_betweenness(30, edges)):
        assert abs(got[node] - expected) < 1e-9, node


def test_long_chain_and_deep_tree_need_no_search(spark, monkeypatch):
    """100,000 nodes in a chain and as many in a tree of long branches: all blocks are links, scores follow by formula."""
    searched = []
    real = betweenness._in_memory
    monkeypatch.setattr(betweenness, "_in_memory", lambda b, *a: searched.append(b.count()) or real(b, *a))
    monkeypatch.setattr(betweenness, "_dependencies", None)  # would fail
    n = 100_000
    chain = spark.range(1, n).select(F.col("id").alias("src"), (F.col("id") - 1).alias("dst"))
    tree = spark.range(1, n).select((F.col("id") + n).alias("src"), (F.when(F.col("id") < 11, 0).otherwise(F.col("id") - 10) + n).alias("dst"))
    edges = chain.unionByName(tree).withColumn("weight", F.lit(1))
    nodes = spark.range(2 * n).withColumnRenamed("id", "node")
    got = betweenness.betweenness_centrality(edges, nodes)
    pairs = F.col("betweenness_centrality") * ((2 * n - 1) * (2 * n - 2) / 2)
    row = {r["node"]: r["pairs"] for r in got.select("node", pairs.alias("pairs")).filter("node IN (0, 1, 500, 99999, 100000, 100001)").collect()}
    assert got.count() == 2 * n and searched == [0]
    for node in (0, 1, 500, 99_999):
        assert abs(row[node] - node * (n - 1 - node)) < 1
    branches = [len(range(b, n, 10)) for b in range(1, 11)]
    assert abs(row[n] - ((n - 1) ** 2 - sum(b * b for b in branches)) / 2) < 1
    assert abs(row[n + 1] - (branches[0] - 1) * (n - branches[0])) < 1


def test_distances_write_each_row_a_few_times(spark, monkeypatch):
    """On a chain every round finds one row; all rounds together write little more than those rows."""
    written = []
    real = graph.materialize_counted

    def counting(df, **values):
        table, seen = real(df, **values)
        written.append(seen["rows"])
        return table, seen

    monkeypatch.setattr(graph, "materialize_counted", counting)
    n = 14
    edges = spark.range(n).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"), F.lit(1).alias("weight"))
    got = {r["node"]: r["distance"] for r in graph.shortest_distances(edges, 0).collect()}
    assert got == {i: i for i in range(n + 1)}
    assert sum(written) <= (n + 1) * 6  # each row once, and once more per doubling of a run


def test_distances_are_shortened_within_and_across_buckets(spark):
    rng = random.Random(11)
    edges = [(rng.randrange(30), rng.randrange(30), rng.choice([1, 1, 2, 9, 20])) for _ in range(70)]
    df, _ = network(spark, edges, 30)
    far = {i: float("inf") for i in range(30)} | {0: 0}
    for _ in range(30):
        for a, b, w in edges:
            far[a], far[b] = min(far[a], far[b] + w), min(far[b], far[a] + w)
    got = {r["node"]: r["distance"] for r in graph.shortest_distances(df, 0).collect()}
    assert got == {i: d for i, d in far.items() if d < float("inf")}
    assert graph.shortest_distances(df.limit(0), 0).collect() == [(0, 0)]
