"""Exact betweenness of weighted networks."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize, materialize_counted, scratch_path
from .blocks import biconnected_blocks
from .graph import _distances, arcs, degree_centrality, remove_nodes

#: A round of folding must fold this share of the nodes that are left; longer branches are left to the blocks.
FOLD_SHARE = 0.1
#: Nodes times links up to which cutting a network into blocks costs more than it saves.
WHOLE_STEPS = 10_000_000
#: Links (both directions) of a block up to which a task holds it; larger ones are solved with joins.
LINKS_IN_MEMORY = 200_000
#: Links that a task follows for the sources dealt to it.
STEPS_PER_TASK = 5_000_000
#: (source, node) rows held at once for blocks that are solved with joins.
ROWS_PER_BATCH = 50_000_000


def _fold_leaves(links: DataFrame, nodes: DataFrame):
    """Fold nodes with one neighbour into it, round by round, as long as a round folds a good share of the nodes.

    Every node carries ``reach`` (itself plus all nodes folded into it) and ``squares`` (sum of squared reaches of the
    branches folded into it). Returns the remaining links, the remaining nodes and the folded nodes of each round.
    """
    left, seen = materialize_counted(
        nodes.select("node").withColumns({"reach": F.lit(1).cast("double"), "squares": F.lit(0).cast("double")})
    )
    folded, size = [], seen["rows"]
    while True:
        degrees = links.groupBy("src").agg(F.count("*").alias("degree"), F.min("dst").alias("parent"))
        single = degrees.filter("degree = 1").select(F.col("src").alias("node"), "parent")
        # Two nodes that only have each other: the larger one folds.
        mutual = single.select(F.col("parent").alias("node"), F.col("node").alias("parent"))
        keep = single.join(mutual, ["node", "parent"], "left_semi").filter("node < parent")
        leaves, seen = materialize_counted(single.join(keep, ["node", "parent"], "left_anti").join(left, "node"))
        if seen["rows"] <= FOLD_SHARE * size:
            return links, left, folded
        folded.append(leaves)
        size -= seen["rows"]
        gained = leaves.groupBy(F.col("parent").alias("node")).agg(
            F.sum("reach").alias("more"), F.sum(F.col("reach") * F.col("reach")).alias("more_squares")
        )
        left = materialize(
            left.join(leaves.select("node"), "node", "left_anti").join(gained, "node", "left").select(
                "node",
                (F.col("reach") + F.coalesce("more", F.lit(0.0))).alias("reach"),
                (F.col("squares") + F.coalesce("more_squares", F.lit(0.0))).alias("squares"),
            )
        )
        links = materialize(remove_nodes(links, leaves))


def _from_source(source, neighbours: dict, reach: dict, through: dict) -> float:
    """Add what each node carries on shortest paths from one source (Brandes 2001); the weight that it reaches."""
    distance, ways, before, settled, seen = {source: 0}, {source: 1.0}, defaultdict(list), [], set()
    queue = [(0, source)]
    while queue:
        d, node = heapq.heappop(queue)
        if node in seen:
            continue
        seen.add(node)
        settled.append(node)
        for other, weight in neighbours[node]:
            far = d + weight
            known = distance.get(other)
            if known is None or far < known:
                distance[other], ways[other], before[other] = far, ways[node], [node]
                heapq.heappush(queue, (far, other))
            elif far == known:
                ways[other] += ways[node]
                before[other].append(node)
    carried = dict.fromkeys(settled, 0.0)
    for node in reversed(settled):
        for up in before[node]:
            carried[up] += ways[up] / ways[node] * (reach[node] + carried[node])
        if node != source:
            through[node] += reach[source] * carried[node]
    return sum(reach[n] for n in settled)


def _in_memory(blocks: DataFrame, node: str, weight: str) -> DataFrame:
    """(node, through, size) for blocks given as one row each: links (src, dst, weight) and members (node, outside).

    A block's sources are dealt to as many tasks as its nodes times its links need. Nodes are numbers within a task.
    """
    tasks = F.ceil(F.size("members").cast("double") * F.size("links") / STEPS_PER_TASK).cast("int")
    parts = blocks.withColumn("tasks", F.greatest(tasks, F.lit(1)))
    dealt = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))).repartition("block", "part")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("links", "members", "tasks", "part")}
                members, links = row["members"].values, row["links"].values
                names = members.field("node").to_pylist()
                number = {n: i for i, n in enumerate(names)}
                reach = dict(enumerate(members.field("outside").to_pylist()))
                neighbours, through, size = defaultdict(list), dict.fromkeys(reach, 0.0), {}
                for a, b, w in zip(*(links.field(c).to_pylist() for c in ("src", "dst", "weight"))):
                    neighbours[number[a]].append((number[b], w))
                for source in range(row["part"].as_py(), len(names), row["tasks"].as_py()):
                    size[source] = _from_source(source, neighbours, reach, through)
                yield pa.RecordBatch.from_arrays(
                    [members.field("node"), pa.array(through.values(), pa.float64()), pa.array(map(size.get, reach), pa.float64())],
                    names=["node", "through", "size"],
                )

    found = dealt.select("links", "members", "tasks", "part").mapInArrow(solve, f"node {node}, through double, size double")
    return found.groupBy("node").agg(F.sum("through").alias("through"), F.max("size").alias("size"))


def _repeated(start: DataFrame, step, keys: list[str], value: str) -> list[DataFrame]:
    """Results of applying ``step`` again and again until no row is left. Results of like size are added up on the way."""
    results, current = [], start
    while True:
        current, seen = materialize_counted(step(current))
        if not seen["rows"]:
            return [table for table, _ in results]
        new, size = current, seen["rows"]
        while results and results[-1][1] <= 2 * size:
            before = results.pop()[0]
            new, seen = materialize_counted(_add_up([before, new], keys, value))
            discard(before)
            size = seen["rows"]
        results.append((new, size))


def _add_up(frames: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).groupBy(*keys).agg(F.sum(value).alias(value))


def _dependencies(links: DataFrame, reach: DataFrame, sources: DataFrame) -> DataFrame:
    """What each node carries on shortest paths from a batch of sources, with joins: (node, through)."""
    found = materialize(_distances(links, sources))
    here = found.select("source", F.col("node").alias("src"), F.col("distance").alias("from_distance"))
    there = found.select("source", F.col("node").alias("dst"), F.col("distance").alias("to_distance"))
    ways = materialize(
        here.join(links, "src").join(there, ["source", "dst"])
        .filter(F.col("from_distance") + F.col("weight") == F.col("to_distance"))
        .select("source", "src", "dst")
    )
    # Number of shortest ways to each node, added up over their number of hops.
    origin = sources.select(F.col("node").alias("source"), "node", F.lit(1.0).alias("ways"))
    onward = lambda now: (
        now.join(ways.withColumnRenamed("src", "node"), ["source", "node"])
        .groupBy("source", F.col("dst").alias("node")).agg(F.sum("ways").alias("ways"))
    )
    keys = ["source", "node"]
    number = materialize(_add_up([origin, *_repeated(origin, onward, keys, "ways")], keys, "ways"))
    into = number.select("source", F.col("node").alias("dst"), F.col("ways").alias("ways_to"))
    outof = number.select("source", F.col("node").alias("src"), F.col("ways").alias("ways_from"))
    share = materialize(
        ways.join(into, ["source", "dst"]).join(outof, ["source", "src"])
        .select("source", "src", "dst", (F.col("ways_from") / F.col("ways_to")).alias("share"))
    )
    # Nodes behind a node, split over equal ways and added up over the number of hops.
    ends = found.join(reach, "node").select("source", "node", F.col("reach").alias("carried"))
    back = lambda now: (
        share.join(now.select("source", F.col("node").alias("dst"), "carried"), ["source", "dst"])
        .groupBy("source", F.col("src").alias("node")).agg(F.sum(F.col("share") * F.col("carried")).alias("carried"))
    )
    carried = reduce(DataFrame.unionByName, _repeated(ends, back, keys, "carried"), ends.filter(F.lit(False)))
    starts = reach.select(F.col("node").alias("source"), F.col("reach").alias("weight"))
    through = materialize(
        carried.filter("source <> node").join(starts, "source")
        .groupBy("node").agg(F.sum(F.col("weight") * F.col("carried")).alias("through"))
    )
    for table in (found, ways, number, share):
        discard(table)
    return through


def _with_joins(links: DataFrame, members: DataFrame, sizes: DataFrame, rows_per_batch: int) -> DataFrame:
    """(node, through) for blocks that no task holds. A node of two blocks is two nodes, so blocks do not meet.

    Sources run in batches that together hold ``rows_per_batch`` rows of (source, node); results are appended to one table.
    """
    spark = links.sparkSession
    named = lambda c: F.struct("block", F.col(c).alias("node")).alias(c)
    own_links = materialize(links.select(named("src"), named("dst"), "weight"))
    reach = materialize(members.join(sizes, "block").select(named("node"), F.col("outside").alias("reach"), "nodes"))
    rows = reach.agg(F.sum("nodes")).first()[0] or 0
    batches = -(-rows // rows_per_batch)
    slot = F.pmod(F.xxhash64("node"), F.lit(max(batches, 1)))
    path = scratch_path(spark)
    own = reach.select("node", "reach")
    schema = own.select(F.col("node.node").alias("node"), F.col("reach").alias("through")).schema
    for i in range(batches):
        through = _dependencies(own_links, own, reach.filter(slot == i).select("node"))
        through.select("node.node", "through").write.mode("append").parquet(path)
        discard(through)
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).groupBy("node").agg(F.sum("through").alias("through"))


def betweenness_centrality(
    edges: DataFrame, nodes: DataFrame, whole_steps: int = WHOLE_STEPS, links_in_memory: int = LINKS_IN_MEMORY,
    rows_per_batch: int = ROWS_PER_BATCH,
) -> DataFrame:
    """Weighted betweenness of every node, scaled by 2 / ((n-1)(n-2)), end points not counted.

    Exact: all sources are used. What follows from the shape of the network is counted by formula. Leaves are folded
    into their neighbours while many fall at once. What remains is cut into its biconnected blocks: paths between two
    blocks pass the nodes that join them, so only shortest paths within a block are searched, with each of its nodes
    weighing as much as hangs on it. Chains and trees are blocks of two and need no search; many small blocks need as much
    as their sizes squared, and only a block that is meshed as a whole needs its nodes times its links.

    A block of at most ``links_in_memory`` links is searched in tasks, from the sources dealt to each; a larger one with
    joins, in batches of sources. A core with fewer nodes times links than ``whole_steps`` is searched without being cut.
    All three give the same result.
    """
    nodes, seen = materialize_counted(nodes.select("node").distinct())
    n = seen["rows"]
    links, core, folded = _fold_leaves(materialize(arcs(edges)), nodes)
    kind, weight = nodes.schema["node"].dataType.simpleString(), links.schema["weight"].dataType.simpleString()
    size_of = lambda c: F.collect_list(F.struct(*c))
    n_links, n_core = links.count(), links.select("src").distinct().count()
    if n_links * n_core <= whole_steps and n_links <= links_in_memory:
        inner = core.join(links.select(F.col("src").alias("node")).distinct(), "node", "left_semi")
        members = inner.select(F.lit(0).alias("block"), "node", F.col("reach").alias("outside"))
        blocks = members.groupBy("block").agg(size_of(["node", "outside"]).alias("members")).join(
            links.groupBy(F.lit(0).alias("block")).agg(size_of(["src", "dst", "weight"]).alias("links")), "block"
        )
        found = materialize(_in_memory(blocks, kind, weight))
        rest = F.col("size") - F.col("reach")
        known = core.join(found, "node", "left").withColumn("size", F.coalesce("size", "reach"))
        core_scores = known.select("node", "reach", "squares", "size", "through", (rest * rest).alias("blocks_squared"))
    else:
        cut = biconnected_blocks(links, core.select("node", "reach"))
        sizes = materialize(
            cut.links.groupBy("block").agg(F.count("*").alias("n_links"), F.count_distinct("src").alias("nodes")).filter("nodes > 2")
        )
        small = sizes.filter(F.col("n_links") <= links_in_memory).select("block")
        large = sizes.filter(F.col("n_links") > links_in_memory).select("block", "nodes")
        blocks = cut.members.join(small, "block").groupBy("block").agg(size_of(["node", "outside"]).alias("members")).join(
            cut.links.join(small, "block").groupBy("block").agg(size_of(["src", "dst", "weight"]).alias("links")), "block"
        )
        parts = [_in_memory(blocks, kind, weight).select("node", "through")]
        parts.append(_with_joins(cut.links.join(large.select("block"), "block"), cut.members.join(large.select("block"), "block"), large, rows_per_batch))
        through = materialize(_add_up(parts, ["node"], "through"))
        branch = F.col("size") - F.col("outside")
        joined = cut.members.join(cut.sizes, "root").groupBy("node").agg(
            F.max("size").alias("size"), F.sum(branch * branch).alias("blocks_squared")
        )
        core_scores = core.join(joined, "node", "left").join(through, "node", "left").select(
            "node", "reach", "squares", F.coalesce("size", "reach").alias("size"), "through", F.coalesce("blocks_squared", F.lit(0.0)).alias("blocks_squared")
        )

    members = [materialize(core_scores)]
    for leaves in reversed(folded):
        roots = reduce(DataFrame.unionByName, members).select(F.col("node").alias("parent"), "size")
        rest = F.col("size") - F.col("reach")
        leaf = leaves.join(roots, "parent")
        members.append(leaf.select("node", "reach", "squares", "size", F.lit(None).cast("double").alias("through"), (rest * rest).alias("blocks_squared")))
    everyone = reduce(DataFrame.unionByName, members)

    # Pairs that this node parts: on different ones of its folded branches and blocks.
    others = F.col("size") - 1
    branches = (others * others - F.col("squares") - F.col("blocks_squared")) / 2
    scale = 2.0 / ((n - 1) * (n - 2)) if n > 2 else 0.0
    score = (branches + F.coalesce("through", F.lit(0.0)) / 2) * F.lit(scale)
    return materialize(everyone.select("node", score.alias("betweenness_centrality")))


def scored_nodes(nodes: DataFrame, edges: DataFrame, digits: int = 4) -> DataFrame:
    """Node table with both centralities, rounded half to even."""
    degree = degree_centrality(edges, nodes).select("node", F.bround("degree_centrality", digits).alias("degree_centrality"))
    between = betweenness_centrality(edges, nodes).select(
        "node", F.bround("betweenness_centrality", digits).alias("betweenness_centrality")
    )
    return nodes.join(degree, "node", "left").join(between, "node", "left")
