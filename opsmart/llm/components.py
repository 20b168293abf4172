"""Connected components of links, every node with the smallest one it reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import materialize


def _both(links: DataFrame) -> DataFrame:
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")),
                   F.struct(F.col("b").alias("node"), F.col("a").alias("other")))
    return links.select(F.inline(ends))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); alternating large and small stars.

    A large star ties each node's larger neighbours to its smallest one, a small star the smaller ones; no
    link between components is ever made, the links never grow in number, and rounds grow with the logarithm
    of the nodes. Minima are taken before the shuffle and joined back, so a hub with a third of
    all links is only a skewed join. Each round is a table in the checkpoint folder.
    """
    links = materialize(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = _both(links)
        least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
        large = both.filter("other > node").join(least, "node").select(F.col("other").alias("b"), F.col("least").alias("a"))
        large = large.filter("a <> b").distinct()
        small = large.groupBy("b").agg(F.min("a").alias("least"))
        tied = large.join(small, "b").select(
            F.inline(F.array(F.struct(F.col("least").alias("a"), F.col("b").alias("b")),
                             F.struct(F.col("least").alias("a"), F.col("a").alias("b"))))
        )
        links, old = materialize(tied.filter("a <> b").distinct()), links
        discard(old)
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state
