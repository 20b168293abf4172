"""Undirected weighted networks given as an edge table (and optionally a node table).

Edges have the columns ``src``, ``dst`` and, where needed, ``weight`` (positive;
integers keep equal paths exactly equal). Self-loops are ignored and parallel
edges count once with their lowest weight. Iterations keep their state in
checkpointed frames. A hub with very many edges is handled by pre-aggregation
and by adaptive skew joins: nothing is collected per node.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, materialize, materialize_counted

JOINS_PER_PLAN = 8


def arcs(edges: DataFrame, weighted: bool = True) -> DataFrame:
    """Both directions of every edge, once each."""
    ends = edges.filter(F.col("src") != F.col("dst"))
    cost = F.col("weight") if weighted else F.lit(1)
    both = F.inline(
        F.array(
            F.struct(F.col("src").alias("src"), F.col("dst").alias("dst"), cost.alias("weight")),
            F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), cost.alias("weight")),
        )
    )
    return ends.select(both).groupBy("src", "dst").agg(F.min("weight").alias("weight"))


def counts(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Number of nodes and of distinct undirected edges, one row."""
    lines = (
        edges.filter(F.col("src") != F.col("dst"))
        .select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
        .distinct()
    )
    return lines.agg(F.count("*").alias("edges")).withColumn("nodes", nodes.agg(F.count("*")).scalar())


def degree_centrality(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Degree and degree / (n - 1) for every node; a node without edges scores 0."""
    degrees = arcs(edges, weighted=False).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    total = nodes.agg(F.count("*")).scalar()
    degree = F.coalesce(F.col("degree"), F.lit(0))
    return nodes.select("node").join(degrees, "node", "left").select(
        "node",
        degree.cast("long").alias("degree"),
        F.coalesce(degree / F.nullif(total - 1, F.lit(0)), F.lit(0.0)).alias("degree_centrality"),
    )


def _linked_pairs(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.filter(F.col(first) != F.col(second)).select(
        F.least(first, second).alias("a"), F.greatest(first, second).alias("b")
    ).distinct()


def _contracted(links: DataFrame) -> DataFrame | None:
    """(node, root) for every node of the links (a, b), the root being the same node all over a component.

    Randomised contraction (Boegeholz, Brand and Todor 2020): in every round each
    node joins the neighbour that comes first in a fresh random order, and the
    links are rewritten to the joined nodes. The links shrink by a constant
    factor per round whatever the shape of the network, so all rounds together
    cost little more than the first ones, and long chains need no more rounds
    than other networks of the same size.
    """
    links, seen = materialize_counted(links)
    joined = []
    while seen["rows"]:
        place = lambda c: F.xxhash64(c, F.lit(len(joined)))
        ends = links.select(
            F.inline(
                F.array(
                    F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                    F.struct(F.col("b").alias("node"), F.col("a").alias("other")),
                )
            )
        )
        nearest = ends.groupBy("node").agg(F.min_by("other", place("other")).alias("other"))
        root = F.when(place("other") < place("node"), F.col("other")).otherwise(F.col("node"))
        joined.append(materialize(nearest.select("node", root.alias("root"))))
        first = joined[-1].select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        second = joined[-1].select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        old = links
        links, seen = materialize_counted(_linked_pairs(links.join(first, "a").join(second, "b"), "root_a", "root_b"))
        discard(old)
    if not joined:
        return None
    final = joined.pop()
    while joined:
        above = final.select(F.col("node").alias("root"), F.col("root").alias("top"))
        final = joined.pop().join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        if len(joined) % JOINS_PER_PLAN == 0:
            final = materialize(final)
    return final


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Component of every node, named by its smallest node.

    Links often lead from one kind of node to another with few links each. So each
    target first joins the smallest of its sources, and the link to every other source becomes
    one between the two sources. A target that is no source itself then has no links
    any more and leaves the network: only sources, and as many links less as there were such
    targets, are left to be contracted. The side with more nodes counts as the targets.
    """
    ends = {c: F.approx_count_distinct(c) for c in ("src", "dst")}
    links, seen = materialize_counted(edges.filter(F.col("src") != F.col("dst")).select("src", "dst"), **ends)
    if seen["src"] > seen["dst"]:
        links = links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    none = lambda c: F.lit(None).cast(links.schema[c].dataType)
    as_target = links.select(F.col("dst").alias("node"), F.col("src").alias("source"), none("dst").alias("target"))
    as_source = links.select(F.col("src").alias("node"), none("src").alias("source"), F.col("dst").alias("target"))
    met = materialize(
        as_target.unionByName(as_source).groupBy("node").agg(
            F.min("source").alias("first"), F.max("source").alias("last"), F.min("target").alias("low")
        )
    )
    shared = met.filter(F.col("first") != F.col("last")).select(F.col("node").alias("dst"), "first")
    passing = met.filter(F.col("first").isNotNull() & F.col("low").isNotNull()).select(F.col("node").alias("src"), "first")
    tops = _contracted(_linked_pairs(links.join(shared, "dst").select("src", "first").unionByName(passing), "src", "first"))
    discard(links)
    # All targets of a source are in its component, so the smallest node is a source or the smallest target of one.
    named = met.filter(F.col("low").isNotNull()).select("node", F.least("node", "low").alias("component"))
    if tops is not None:
        lowest = tops.join(named, "node").groupBy("root").agg(F.min("component").alias("lowest"))
        within = tops.join(lowest, "root").select("node", "lowest")
        named = named.join(within, "node", "left").select("node", F.coalesce("lowest", "component").alias("component"))
    named = materialize(named)
    left = met.filter(F.col("low").isNull()).select("node", "first")
    left = left.join(named.select(F.col("node").alias("first"), "component"), "first").select("node", "component")
    return nodes.select("node").join(named.unionByName(left), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def component_sizes(components: DataFrame) -> DataFrame:
    return components.groupBy("component").agg(F.count("*").alias("size"))


def is_connected(components: DataFrame) -> bool:
    names = components.agg(
        F.count("*").alias("rows"), F.count("component").alias("named"),
        F.min("component").alias("low"), F.max("component").alias("high"),
    ).first()
    return names["rows"] > 0 and names["named"] in (0, names["rows"]) and names["low"] == names["high"]


def remove_nodes(edges: DataFrame, removed: DataFrame) -> DataFrame:
    """Edges left after the nodes in ``removed`` and all their edges are gone."""
    gone = removed.select(F.col("node").alias("__gone"))
    return edges.join(gone, F.col("src") == F.col("__gone"), "left_anti").join(
        gone, F.col("dst") == F.col("__gone"), "left_anti"
    )


def islands_without(edges: DataFrame, nodes: DataFrame, removed: DataFrame) -> DataFrame:
    """Components of the network that remains when nodes fail. One row per remaining node."""
    left = nodes.select("node").join(removed.select("node"), "node", "left_anti")
    return connected_components(remove_nodes(edges, removed), left)


@dataclass
class _Run:
    """Distances written in some rounds: the table, its rows and its largest distance."""

    table: DataFrame
    rows: int
    most: object


def _shortest(runs: list[_Run]) -> DataFrame:
    """The smallest distance that the runs hold for each (source, node)."""
    return reduce(DataFrame.unionByName, [r.table for r in runs]).groupBy("source", "node").agg(F.min("distance").alias("distance"))


def _pushed(runs: list[_Run], new: _Run) -> tuple[list[_Run], list[DataFrame]]:
    """The runs with one more, and tables no longer needed. Neighbours of like size become one run, so that runs stay
    few and a row is rewritten seldom: as often as the logarithm of the rows."""
    runs, old = [*runs, new], []
    while len(runs) > 1 and runs[-2].rows <= 2 * runs[-1].rows:
        a, b = runs.pop(), runs.pop()
        table, seen = materialize_counted(_shortest([a, b]), most=F.max("distance"))
        old += [a.table, b.table]
        runs.append(_Run(table, seen["rows"], seen["most"]))
    return runs, old


def _distances(links: DataFrame, starts: DataFrame, target=None) -> DataFrame:
    """Shortest distance for each (source, node). ``starts`` holds the sources.

    Delta-stepping: distances are settled bucket by bucket, a bucket being as wide as the largest weight. A round
    extends the rows that the round before found in the bucket and writes only rows that are new or shorter. A row
    can only be reached from rows at most one weight away, so runs of rows that end before that are not read
    again, and what is written and read grows with the rows found, not with rounds times rows. With a ``target`` the
    rows of buckets after the one that settles it are left out.
    """
    cost = dict(links.dtypes)["weight"]
    width = links.agg(F.max("weight")).first()[0]
    near = F.min(F.when(F.col("node") == F.lit(target), F.col("distance"))) if target is not None else F.lit(None).cast(cost)
    values = {"most": F.max("distance"), "target": F.min(near) if target is None else near}
    first = starts.select(F.col("node").alias("source"), "node", F.lit(0).cast(cost).alias("distance"))
    table, seen = materialize_counted(first, **values)
    runs = [_Run(table, seen["rows"], seen["most"])]
    if width is None or not seen["rows"]:
        return table
    low, front, reached, old = 0, table, seen["target"], []
    while True:
        end = low + width
        while front is not None:
            offered = front.join(links, front["node"] == links["src"]).select(
                "source", F.col("dst").alias("node"), (F.col("distance") + F.col("weight")).cast(cost).alias("distance"),
                F.lit(None).cast(cost).alias("known"),
            )
            live = [r.table for r in runs if r.most >= low - width]
            held = reduce(DataFrame.unionByName, live).select("source", "node", F.lit(None).cast(cost).alias("distance"), F.col("distance").alias("known"))
            best = held.unionByName(offered).groupBy("source", "node").agg(F.min("distance").alias("distance"), F.min("known").alias("known"))
            better = best.filter(F.col("distance").isNotNull() & (F.col("known").isNull() | (F.col("distance") < F.col("known"))))
            inside = F.count_if(F.col("distance") < F.lit(end))
            table, seen = materialize_counted(better.select("source", "node", "distance"), inside=inside, **values)
            for unread in old:
                discard(unread)
            front, old = None, []
            if seen["inside"]:
                front = table.filter(F.col("distance") < F.lit(end))
            if seen["target"] is not None:
                reached = seen["target"] if reached is None else min(reached, seen["target"])
            if seen["rows"]:
                runs, old = _pushed(runs, _Run(table, seen["rows"], seen["most"]))
        waiting = [r for r in runs if r.most >= end]
        if not waiting or (reached is not None and reached < end):
            found = _shortest(runs)
            return found.filter(F.col("distance") < F.lit(end)) if target is not None else found
        ahead = _shortest([r for r in runs if r.most >= low - width]).filter(F.col("distance") >= F.lit(end))
        low = ahead.agg(F.min("distance")).first()[0]
        if low is None:  # what lies there was found at a shorter distance since
            return _shortest(runs)
        front = ahead.filter(F.col("distance") < F.lit(low + width))


def _one_node(edges: DataFrame, node) -> DataFrame:
    kind = edges.schema["src"].dataType
    return edges.sparkSession.range(1).select(F.lit(node).cast(kind).alias("node"))


def shortest_distances(edges: DataFrame, source) -> DataFrame:
    """Distance from one node to every node it can reach."""
    links = materialize(arcs(edges))
    return _distances(links, _one_node(edges, source)).select("node", "distance")


def shortest_path(edges: DataFrame, source, target) -> DataFrame:
    """Stations of a shortest path as (step, node, distance); no rows when there is none.

    Among equal paths the predecessor with the smallest id is taken. The stations are found by
    doubling: a round follows twice as many predecessors as the one before, so rounds grow with the
    logarithm of the path and nothing passes through the driver.
    """
    links = materialize(arcs(edges))
    found = materialize(_distances(links, _one_node(edges, source), target).select("node", "distance"))
    here = found.select(F.col("node").alias("src"), F.col("distance").alias("from_distance"))
    there = found.select(F.col("node").alias("dst"), F.col("distance").alias("to_distance"))
    back = materialize(
        links.join(here, "src").join(there, "dst")
        .filter(F.col("from_distance") + F.col("weight") == F.col("to_distance"))
        .groupBy(F.col("dst").alias("node")).agg(F.min("src").alias("up"))
    )
    stations, known = materialize(_one_node(edges, target)), 1
    while True:
        reached = stations.join(back, "node").select(F.col("up").alias("node"))
        more = materialize(stations.unionByName(reached).distinct())
        discard(stations)
        stations, before = more, known
        known = stations.count()
        if known == before:
            break
        twice = back.select(F.col("node").alias("up"), F.col("up").alias("further"))
        back, old = materialize(back.join(twice, "up").select("node", F.col("further").alias("up"))), back
        discard(old)
    order = Window.orderBy("distance")  # the stations of one path
    return stations.join(found, "node").select((F.row_number().over(order) - 1).alias("step"), "node", "distance")
