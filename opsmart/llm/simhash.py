"""SimHash fingerprints of texts and exact near-duplicates by Hamming distance, with vantage-point trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import arrow_map, id_and_text, materialize
from .components import components
from .words import SPACE, Texts, Words, slices

BITS = 64
SHINGLES_AT_ONCE = 500_000
PAIRS_AT_ONCE = 2_000_000


def fingerprint_table(
    df: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint) for every row; the fingerprint's 64 bits are those of a long.

    Words are lower-cased (A-Z), shingles of ``shingle`` words keep repeats, a shorter text is one shingle. A bit is
    set if it is in more than half of the shingles' XXH64 values. A null, empty or wordless text has
    fingerprint 0; a null id stays null; repeated rows stay.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for part in slices(batch, 1):
                yield {"doc_id": part.column(0), "fingerprint": _fingerprints(part.column(1), shingle, seed)}

    return arrow_map(id_and_text(df, id_col, text_col), "doc_id long, fingerprint long", rows)


def _fingerprints(column: pa.Array, shingle: int, seed: int) -> np.ndarray:
    texts = Texts.of(column, lower=True)
    words = Words.of(texts)
    n, counts = len(texts), words.counts
    lengths = words.ends - words.starts
    # the words with single spaces between them, so that a shingle is one run of bytes
    spaced = np.full(int(lengths.sum()) + len(lengths), 0x20, np.uint8)
    letters = np.ones(len(spaced), bool)
    letters[np.cumsum(lengths + 1) - 1] = False
    spaced[letters] = texts.data[~SPACE[texts.data]]
    joined = spaced.tobytes()
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    many = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    owner = np.repeat(np.arange(n), many)
    first = words.bounds[:-1][owner] + np.arange(len(owner)) - (np.cumsum(many) - many)[owner]
    last = np.minimum(first + shingle, words.bounds[1:][owner]) - 1
    digest = xxhash.xxh64_intdigest
    values = np.fromiter(
        (digest(joined[s:e], seed) for s, e in zip(starts[first].tolist(), ends[last].tolist())), np.uint64, len(owner)
    )
    set_in = np.zeros((n, BITS), np.int64)
    for at in range(0, len(values), SHINGLES_AT_ONCE):
        block, of = values[at:at + SHINGLES_AT_ONCE], owner[at:at + SHINGLES_AT_ONCE]
        ones = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first_of = np.flatnonzero(np.diff(of, prepend=-1))
        set_in[of[first_of]] += np.add.reduceat(ones, first_of, axis=0, dtype=np.int32)
    majority = (2 * set_in > many[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view("<u8").reshape(n).astype(np.int64)


def as_hex(fingerprint: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


@dataclass
class VantageTree:
    """A vantage-point tree over the bits of one mask.

    Inner node i splits by the distance to ``points[i]``: up to ``radii[i]`` goes to child 2i + 1, more to 2i + 2.
    All leaves are ``depth`` deep. Distances count differing bits under the mask.
    """

    mask: np.uint64
    depth: int
    points: np.ndarray
    radii: np.ndarray

    @classmethod
    def build(cls, sample: np.ndarray, mask: int, depth: int, seed: int) -> VantageTree:
        rng = np.random.default_rng(seed)
        mask = np.uint64(mask)
        inner = (1 << depth) - 1
        points, radii = np.zeros(inner, np.uint64), np.zeros(inner, np.int64)
        groups = {0: sample}
        for i in range(inner):
            own = groups.pop(i)
            near_far = [own, own]
            points[i] = rng.integers(0, 1 << 64, dtype=np.uint64)
            if len(own) > 1:
                # the candidate whose median split is the most even one
                best = -1
                for v in [*rng.choice(own, min(4, len(own)), replace=False), points[i], ~own[0]]:
                    d = np.bitwise_count((own ^ v) & mask).astype(np.int64)
                    radius = int(np.median(d))
                    for r in (radius - 1, radius):
                        even = min((d <= r).sum(), (d > r).sum())
                        if even > best:
                            best, points[i], radii[i] = even, v, r
                d = np.bitwise_count((own ^ points[i]) & mask).astype(np.int64)
                near_far = [own[d <= radii[i]], own[d > radii[i]]]
            else:
                radii[i] = int(mask).bit_count() // 2
            groups[2 * i + 1], groups[2 * i + 2] = near_far
        return cls(mask, depth, points, radii)

    def route(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, leaf, home) of every leaf in which a value has to be looked for.

        One leaf of a value is its home. By the triangle inequality values within ``radius`` of it lie on the other side
        of a split only if its own distance is within ``radius`` of the border; only then is that branch
        entered too. Meeting a pair once is enough, so at a split from home only the near side looks across.
        """
        row, node, home = np.arange(len(values)), np.zeros(len(values), np.int64), np.ones(len(values), bool)
        for _ in range(self.depth):
            d = np.bitwise_count((values[row] ^ self.points[node]) & self.mask).astype(np.int64)
            r = self.radii[node]
            near, to_far, to_near = d <= r, d > r - radius, d <= r + radius
            stay = home
            visit_near = np.where(stay, near, to_near)
            visit_far = np.where(stay, ~near | to_far, to_far)
            keep_near = stay & near
            keep_far = stay & ~near
            row, node, home = (
                np.concatenate([row[visit_near], row[visit_far]]),
                np.concatenate([2 * node[visit_near] + 1, 2 * node[visit_far] + 2]),
                np.concatenate([keep_near[visit_near], keep_far[visit_far]]),
            )
        return row, node - ((1 << self.depth) - 1), home


def bands(count: int) -> list[int]:
    """Masks that share out the 64 bits."""
    edges = [round(BITS * i / count) for i in range(count + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]


def near_links(fingerprints: DataFrame, max_bits: int = 4, masks: int = 3, leaf: int = 1_000, sample: int = 20_000) -> DataFrame:
    """Links (a, b), a < b, that connect all distinct longs in ``fingerprint`` with at most ``max_bits`` differing bits.

    Every pair within the distance is met in some leaf and connected there, directly or through others within the
    distance; links that add no connection inside a leaf are left out, so a leaf with n fingerprints gives
    fewer than n links of its own, never all its pairs.

    The bits are shared out to ``masks`` vantage-point trees: two fingerprints that differ in ``max_bits`` bits differ in at most
    ``max_bits // masks`` of them under one of the masks, so each tree is searched with that smaller radius,
    which makes pruning by the triangle inequality effective where distances over all 64 bits would leave nearly
    every branch open. The trees are built on the driver from ``sample`` fingerprints at most (by hash) and shape
    the leaves only; their size is bounded by the sample and every fingerprint is indexed and searched.
    A large leaf is cut by hash: home fingerprints into blocks that meet each other.
    """
    spark = fingerprints.sparkSession
    distinct = materialize(fingerprints.select("fingerprint").distinct())
    total = distinct.count()
    chosen = distinct.filter(F.pmod(F.xxhash64("fingerprint"), F.lit(max(total, sample))) < sample)
    values = np.sort(np.array([r[0] for r in chosen.collect()], dtype=np.int64)).astype(np.uint64)
    depth = max(0, min(int(np.ceil(np.log2(max(total / leaf, 1)))), int(np.log2(max(sample / 4, 1)))))
    trees = spark.sparkContext.broadcast([VantageTree.build(values, m, depth, i) for i, m in enumerate(bands(masks))])
    radius = max_bits // masks

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
            for i, tree in enumerate(trees.value):
                for at in range(0, len(own), 20_000):
                    block = own[at:at + 20_000]
                    row, node, home = tree.route(block, radius)
                    yield {"shard": (np.int64(i) << 48) + node, "home": home, "fingerprint": block[row].astype(np.int64)}

    routed = materialize(arrow_map(distinct, "shard long, home boolean, fingerprint long", shards))
    # a leaf of more than ``2 * leaf`` home fingerprints is cut into blocks; each row meets the home rows of each block
    sizes = routed.filter("home").groupBy("shard").agg(F.count("*").alias("n"))
    sizes = sizes.select("shard", F.ceil(F.col("n") / (2 * leaf)).cast("int").alias("blocks"))
    placed = routed.join(sizes, "shard")
    block = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    # task (i, j), i <= j, holds what is in block i or j of the leaf; every row meets the home rows of every block
    pairs = placed.select("shard", "home", "fingerprint", block.alias("own"), "blocks").select(
        "shard", "home", "fingerprint", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    )
    low, high = F.least("own", "with"), F.greatest("own", "with")
    tasks = pairs.select("shard", low.alias("i"), high.alias("j"), "home", "fingerprint")

    def connect(key: tuple, table: pa.Table) -> pa.Table:
        home = table.column("home").to_numpy(zero_copy_only=False)
        values = table.column("fingerprint").to_numpy(zero_copy_only=False).astype(np.uint64)
        a, b = _spanning(values, home, max_bits)
        return pa.table({"a": pa.array(a.astype(np.int64)), "b": pa.array(b.astype(np.int64))})

    return tasks.groupBy("shard", "i", "j").applyInArrow(connect, "a long, b long")


def _spanning(values: np.ndarray, home: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever is within the distance of a home value; one for each joining of two groups."""
    where = np.flatnonzero(home)
    fixed = values[where]
    group = np.arange(len(values))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, PAIRS_AT_ONCE // max(len(fixed), 1))
    for at in range(0, len(values), step):
        rows, columns = np.nonzero(np.bitwise_count(values[at:at + step, None] ^ fixed[None, :]) <= max_bits)
        rows, columns = rows + at, where[columns]
        while True:  # groups that a pair joins are tied to the smaller one, all at once
            x, y = group[rows], group[columns]
            apart = x != y
            if not apart.any():
                break
            rows, columns, x, y = rows[apart], columns[apart], x[apart], y[apart]
            high, low = np.maximum(x, y), np.minimum(x, y)
            chosen = np.full(len(values), -1)
            chosen[high] = np.arange(len(high))
            tied = np.flatnonzero(chosen >= 0)
            pair = chosen[tied]
            a.append(rows[pair])
            b.append(columns[pair])
            parent = np.arange(len(values))
            parent[tied] = low[pair]
            while (up := parent[parent]).tobytes() != parent.tobytes():
                parent = up
            group = parent[group]
    return values[np.concatenate(a)], values[np.concatenate(b)]


def near_duplicates(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row: groups of fingerprints linked at ``max_bits`` or fewer bits.

    ``component_id`` is the smallest id in the group, over any number of links. Rows with equal fingerprints are one point of
    the search, however many they are. Null ids have no part in ``component_id``; a group of null ids
    only has a null one. Empty texts share fingerprint 0 and are linked like any other.
    """
    prints = materialize(fingerprint_table(df, shingle, seed, id_col, text_col))
    named = _groups(prints, max_bits).select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def _groups(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fingerprint, least, root, component_id): smallest ids of a fingerprint and of its group, which has a root also without ids."""
    points = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    linked = materialize(components(near_links(points, max_bits)))
    roots = points.join(linked, points["fingerprint"] == linked["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    lowest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return roots.join(lowest, "root").select("fingerprint", "least", "root", "component_id")


def drop_near_duplicates(
    df: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text", seed: int = 42
) -> DataFrame:
    """One row of each group: of the rows with the group's smallest id the first in order.

    Likeness is of texts alone: rows of one id whose texts are no near copies are in different groups and all stay where
    they are the first of theirs. Rows without an id all stay. The order is that of the fingerprint, then of all columns.
    """
    place = df.columns.index(text_col)
    mark = "__fingerprint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                prints = _fingerprints(part.column(place).fill_null(""), shingle, seed)
                yield part.append_column(mark, pa.array(prints, pa.int64()))

    marked = materialize(df.mapInArrow(run, StructType([*df.schema, StructField(mark, LongType())])))
    ident = F.col(f"`{id_col}`")
    prints = marked.select(ident.cast("long").alias("doc_id"), F.col(mark).alias("fingerprint"))
    # Of a group's smallest id one fingerprint, and of the rows that have both one.
    first = _groups(prints, max_bits).filter(F.col("least") == F.col("component_id"))
    chosen = first.groupBy("root").agg(F.min("component_id").alias("__kept"), F.min("fingerprint").alias("__print")).drop("root")
    rows = marked.join(chosen, (ident.cast("long") == F.col("__kept")) & (F.col(mark) == F.col("__print")), "left_semi")
    whole = F.struct(F.col(f"`{text_col}`"), *(F.col(f"`{c}`") for c in df.columns if c != text_col))
    one = rows.groupBy(ident.alias("__kept"), mark).agg(F.min(whole).alias("__row"))
    stay = one.select(*(F.col("__row")[c].alias(c) for c in df.columns))
    return stay.unionByName(marked.filter(ident.isNull()).drop(mark))
