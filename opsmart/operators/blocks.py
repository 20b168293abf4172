"""Spanning trees and biconnected blocks of a network, in a number of steps that grows with the logarithm of its size.

Blocks are found after Tarjan and Vishkin (1985): a spanning forest is walked around as an Euler tour, which makes every
subtree an interval of places; the places that a subtree's other links lead to tell which tree links share a block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, materialize_counted
from .graph import JOINS_PER_PLAN, connected_components
from .ordered import number_rows


def both_ways(pairs: DataFrame, first: str, second: str, *more: str) -> DataFrame:
    """Each row once from either end, as (node, other, ...)."""
    way = lambda a, b: F.struct(F.col(a).alias("node"), F.col(b).alias("other"), *more)
    return pairs.select(F.inline(F.array(way(first, second), way(second, first))))


def spanning_forest(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that join each component to a tree, and the root (node, root) of every node.

    Each round every group of nodes takes its first link in a fixed random order (Boruvka); the groups joined by these
    links become one, named by one of them, which is found by doubling. Groups at least halve per round.
    """
    order = F.struct(F.xxhash64("a", "b").alias("h"), "a", "b")
    rest, seen = materialize_counted(pairs.select(F.col("a").alias("x"), F.col("b").alias("y"), order.alias("link")))
    taken, named = [], []
    while seen["rows"]:
        first = both_ways(rest, "x", "y", "link").groupBy("node").agg(F.min(F.struct("link", "other")).alias("m"))
        first = materialize(first.select("node", F.col("m.other").alias("up"), F.col("m.link").alias("link")))
        taken.append(materialize(first.select("link.a", "link.b").distinct()))
        # Two groups that take the same link point at each other: the smaller one is the root.
        back = first.select(F.col("node").alias("up"), F.col("up").alias("again"))
        up = F.when((F.col("again") == F.col("node")) & (F.col("node") < F.col("up")), F.col("node")).otherwise(F.col("up"))
        roots, moves = materialize(first.join(back, "up").select("node", up.alias("up"))), True
        discard(first)
        while moves:
            above = roots.select(F.col("node").alias("up"), F.col("up").alias("top"))
            further = roots.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved"))
            old = roots
            roots, moving = materialize_counted(further, moves=F.count_if("moved"))
            discard(old)
            roots, moves = roots.drop("moved"), moving["moves"]
        named.append(roots)
        x, y = (roots.select(F.col("node").alias(c), F.col("up").alias(f"new_{c}")) for c in ("x", "y"))
        left = rest.join(x, "x").join(y, "y").filter("new_x <> new_y")
        pair = [F.least("new_x", "new_y").alias("x"), F.greatest("new_x", "new_y").alias("y")]
        old = rest
        rest, seen = materialize_counted(left.groupBy(*pair).agg(F.min("link").alias("link")))
        discard(old)
    if not taken:
        none = pairs.select("a", "b").limit(0)
        return none, none.select(F.col("a").alias("node"), F.col("b").alias("root"))
    forest = taken[0]
    for more in taken[1:]:
        forest = forest.unionByName(more)
    final = named.pop()
    while named:
        above = final.select(F.col("node").alias("up"), F.col("up").alias("top"))
        final = named.pop().join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        if len(named) % JOINS_PER_PLAN == 0:
            final = materialize(final)
    return materialize(forest), materialize(final.select("node", F.col("up").alias("root")))


def tour_places(forest: DataFrame, roots: DataFrame) -> DataFrame:
    """The rooted forest as intervals: (node, parent, root, low, high), one row per node with a link.

    The Euler tour goes along every tree link in both directions. A link's place is its number of steps to the end of
    the tour, found by doubling; a node's interval reaches from the link back to its parent (``low``) to the link
    down from it (``high``), so the intervals of its subtree lie within and others outside. A root has no parent.
    """
    numbered = number_rows(both_ways(forest, "a", "b"), ["node"], ["other"], "place")
    arcs = materialize(numbered.withColumn("arc", F.monotonically_increasing_id()))
    degrees = arcs.groupBy("node").agg(F.max("place").alias("degree"))
    back = arcs.select(F.col("node").alias("other"), F.col("other").alias("node"), F.col("arc").alias("back"), F.col("place").alias("at"))
    opposite = arcs.join(back, ["node", "other"])
    turns = opposite.join(degrees.withColumnRenamed("node", "other"), "other").select(
        "arc", "back", "node", "other", "place", F.col("other").alias("from"), (F.pmod(F.col("at"), F.col("degree")) + 1).alias("turn")
    )
    start = arcs.select(F.col("node").alias("from"), F.col("place").alias("turn"), F.col("arc").alias("next"))
    whole = turns.join(start, ["from", "turn"]).join(roots, "node")
    closes = (F.col("from") == F.col("root")) & (F.col("turn") == 1)  # the tour would start again
    step = whole.select("arc", "back", "node", "other", "root", F.when(~closes, F.col("next")).alias("next"), F.lit(1).cast("long").alias("steps"))
    ends = materialize(step.select("arc", "back", "node", "other", "root"))
    state, going = materialize_counted(step.select("arc", "next", "steps"), open=F.count("next"))
    while going["open"]:
        ahead = state.select(F.col("arc").alias("next"), F.col("next").alias("after"), F.col("steps").alias("more"))
        further = state.join(ahead, "next", "left").select(
            "arc", F.col("after").alias("next"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps")
        )
        old = state
        state, going = materialize_counted(further, open=F.count("next"))
        discard(old)
    other_way = state.select(F.col("arc").alias("back"), F.col("steps").alias("low"))
    down = ends.join(state.select("arc", F.col("steps").alias("high")), "arc").join(other_way, "back").filter("high > low")
    inner = down.select(F.col("other").alias("node"), F.col("node").alias("parent"), "root", "low", "high")
    tops = inner.groupBy("root").agg(F.max("high").alias("longest")).select(
        F.col("root").alias("node"), F.lit(None).cast(inner.schema["parent"].dataType).alias("parent"), "root",
        F.lit(0).cast("long").alias("low"), (F.col("longest") + 1).alias("high"),
    )
    return materialize(inner.unionByName(tops))


def over_intervals(points: DataFrame, intervals: DataFrame, key: str, **values: Column) -> DataFrame:
    """Aggregates of the points in each interval: (root, key, ...). Points have ``root`` and ``at``, intervals ``low`` and ``high``.

    Points are added up per binary segment of every length, intervals are cut into the few segments that make them up.
    Every name in ``values`` is a column of the points, its value an aggregate of that column.
    """
    most = F.ceil(F.log2(F.col("top") + 2)).cast("int")
    tops = intervals.groupBy("root").agg(F.max("high").alias("top"))
    spread = points.join(tops, "root").withColumn("level", F.explode(F.sequence(F.lit(0), most)))
    index = F.expr("shiftright(at, level)").alias("index")
    segments = spread.groupBy("root", "level", index).agg(*(v.alias(n) for n, v in values.items()))
    # At a level the interval begins at ``a`` and ends before ``b``; an odd end has a segment of its own there.
    begin, end = F.expr("shiftright(low + (shiftleft(1L, level) - 1), level)"), F.expr("shiftright(high + 1, level)")
    cuts = intervals.withColumn("level", F.explode(F.sequence(F.lit(0), F.ceil(F.log2(F.col("high") - F.col("low") + 2)).cast("int"))))
    cuts = cuts.withColumns({"a": begin, "b": end}).filter("a < b")
    odd = F.filter(F.array(F.when(F.col("a") % 2 == 1, F.col("a")), F.when(F.col("b") % 2 == 1, F.col("b") - 1)), lambda x: x.isNotNull())
    cuts = cuts.select("root", key, "level", F.explode(F.array_distinct(odd)).alias("index"))
    return cuts.join(segments, ["root", "level", "index"]).groupBy("root", key).agg(*(v.alias(n) for n, v in values.items()))


@dataclass(frozen=True)
class Blocks:
    """``members``: (block, node, outside, root): the weight of a node and all that hangs on it outside the block.
    ``links``: (block, src, dst, weight), both directions. ``sizes``: (root, size), the weight of each component.
    """

    members: DataFrame
    links: DataFrame
    sizes: DataFrame


def biconnected_blocks(links: DataFrame, weights: DataFrame) -> Blocks:
    """Blocks of a network. ``links`` holds both directions of each link, ``weights`` (node, reach) of every node.

    A block is named by one of its nodes. Two nodes that only a single link connects are a block of two.
    """
    pairs = materialize(links.filter("src < dst").select(F.col("src").alias("a"), F.col("dst").alias("b")))
    forest, roots = spanning_forest(pairs)
    tree = tour_places(forest, roots)
    others = materialize(pairs.join(forest, ["a", "b"], "left_anti"))
    place = lambda c: tree.select(F.col("node").alias(c), F.col("low").alias(f"low_{c}"), F.col("high").alias(f"high_{c}"))
    crossing = materialize(others.join(place("a"), "a").join(place("b"), "b"))
    led_to = both_ways(crossing, "a", "b").join(place("other"), "other").groupBy("node").agg(
        F.min("high_other").alias("least"), F.max("high_other").alias("most")
    )
    points = tree.join(weights, "node").join(led_to, "node", "left").select(
        "root", F.col("high").alias("at"), "reach", "least", "most"
    )
    inner = tree.filter("parent IS NOT NULL")
    under = materialize(
        inner.join(
            over_intervals(points, inner, "node", reach=F.sum("reach"), least=F.min("least"), most=F.max("most")), ["root", "node"]
        )
    )
    # Tree links, named by their lower node, that share a block.
    apart = crossing.filter("high_a < low_b OR high_b < low_a").select(F.col("a").alias("src"), F.col("b").alias("dst"))
    above = tree.select(F.col("node").alias("parent"), F.col("parent").alias("top"), F.col("low").alias("low_p"), F.col("high").alias("high_p"))
    leaving = (F.col("least") < F.col("low_p")) | (F.col("most") > F.col("high_p"))
    onward = under.join(above, "parent").filter(F.col("top").isNotNull() & leaving).select(F.col("node").alias("src"), F.col("parent").alias("dst"))
    named = connected_components(apart.unionByName(onward), under.select("node")).withColumnRenamed("component", "block")
    under = materialize(under.join(named, "node"))

    sizes = materialize(tree.join(weights, "node").groupBy("root").agg(F.sum("reach").alias("size")))
    # What hangs on a node through each block below it.
    below = under.groupBy(F.col("parent").alias("node"), "block", "root").agg(F.sum("reach").alias("through"))
    lower = under.select("node", "block", "root", "reach").join(
        below.groupBy("node", "block").agg(F.sum("through").alias("through")), ["node", "block"], "left"
    ).select("block", "node", (F.col("reach") - F.coalesce("through", F.lit(0))).alias("outside"), "root")
    # The node nearest the root is in the block, though its own tree link is not.
    heads = below.join(under.select("node", "block"), ["node", "block"], "left_anti").join(sizes, "root").select(
        "block", "node", (F.col("size") - F.col("through")).alias("outside"), "root"
    )
    members = materialize(lower.unionByName(heads))
    child = under.select(F.col("node").alias("src"), F.col("parent").alias("dst"), "block")
    deeper = F.when(F.col("high_a") < F.col("high_b"), F.col("a")).otherwise(F.col("b"))
    rest = crossing.select("a", "b", deeper.alias("node")).join(named, "node").select(F.col("a").alias("src"), F.col("b").alias("dst"), "block")
    owned = both_ways(child.unionByName(rest), "src", "dst", "block").select(F.col("node").alias("src"), F.col("other").alias("dst"), "block")
    return Blocks(members, materialize(owned.join(links, ["src", "dst"]).select("block", "src", "dst", "weight")), sizes)
