"""Exact highest inner products of query vectors against all vectors, by distributed histogram selection."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize
from .vectors import integer_vectors, matrix

#: Queries whose vectors are handed to all tasks at once; more queries take further passes over the vectors.
QUERIES_AT_ONCE = 8192
#: Scores held at once by a task.
SCORES_AT_ONCE = 1 << 20
BINS = 256
RESULT = "query_id long, rank int, vec_id long, score long"
#: Marks a query's own rows; no score is as low.
NO_SCORE = np.iinfo(np.int64).min


def scores(x: np.ndarray, queries: np.ndarray, exact_doubles: bool) -> np.ndarray:
    """Inner products of all rows with all queries. Doubles are exact below 2^53, and multiply faster."""
    if exact_doubles:
        return (x.astype(float) @ queries.T.astype(float)).astype(np.int64)
    return x @ queries.T


class Block:
    """Some queries: their ids in order, their vectors, and between which scores the k-th best of each lies.

    It is one of the scores from ``low`` on and below ``high``; ``above`` rows score ``high`` or more. A bin of a
    histogram holds ``width`` scores.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, lengths: np.ndarray, longest: float, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        bound = np.ceil(np.sqrt(lengths.astype(float)) * np.sqrt(longest) * (1 + 1e-9)) + 1  # no inner product is larger
        self.exact_doubles = bool(bound.max() < 2.0**53)
        self.low, self.high = -bound.astype(np.int64), bound.astype(np.int64) + 1
        self.above = np.zeros(len(ids), np.int64)

    @property
    def width(self) -> np.ndarray:
        return -(-(self.high - self.low) // BINS)

    def scored(self, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of a batch, piece by piece, and their scores with all queries; none for rows with the query's id."""
        column, width = batch.column("q"), self.vectors.shape[1]
        longest = int(np.diff(column.offsets.to_numpy()).max(initial=0))
        x = matrix(column, max(width, longest))[:, :width]
        own = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("vec_id").fill_null(0).to_numpy()
        step = max(1, SCORES_AT_ONCE // len(self.ids))
        for start in range(0, len(x), step):
            rows = np.arange(start, min(start + step, len(x)))
            out = scores(x[rows], self.vectors, self.exact_doubles)
            first, end = (np.searchsorted(self.ids, ids[rows], side) for side in ("left", "right"))
            for i in np.flatnonzero((first < end) & own[rows]):
                out[i, first[i]:end[i]] = NO_SCORE
            yield rows, out

    def histogram(self, batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of a task's scores per query and bin: of its highest bins, until they hold ``k`` scores.

        The k-th best of all rows is no lower than that of one task's rows, so lower bins never matter.
        """
        n, width = len(self.ids), self.width
        counts = np.zeros((n, BINS + 1), np.int64)  # the last one is for scores outside the range
        base = np.arange(n) * (BINS + 1)
        for batch in batches:
            for _, out in self.scored(batch):
                inside = (out >= self.low) & (out < self.high)
                bins = np.where(inside, np.where(inside, out - self.low, 0) // width, BINS)
                counts += np.bincount((bins + base).ravel(), minlength=counts.size).reshape(counts.shape)
        counts = counts[:, :BINS]
        higher = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        query, bin_ = np.nonzero((counts > 0) & (higher < self.k))
        return query, bin_, counts[query, bin_]

    def refine(self, query: np.ndarray, bin_: np.ndarray, rows: np.ndarray) -> None:
        """Narrow each query's range to the bin in which the sums of all tasks reach ``k``."""
        counts = np.zeros((len(self.ids), BINS), np.int64)
        counts[query, bin_] = rows
        upto = counts[:, ::-1].cumsum(axis=1)[:, ::-1] + self.above[:, None]  # rows in this bin and above
        reached = upto >= self.k
        width, found, each = self.width, reached.any(axis=1), np.arange(len(self.ids))
        at = BINS - 1 - np.argmax(reached[:, ::-1], axis=1)  # the highest such bin
        self.above = np.where(found, (upto - counts)[each, at], self.above)
        # A query with fewer than k rows wants them all: its range is the lowest score and what lies above it.
        low = np.where(found, self.low + at * width, self.low)
        self.high = np.where(found, np.minimum(low + width, self.high), low + 1)
        self.low = low

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        """A task's rows that score at least the k-th best score, of many equal ones those with the smallest ids."""
        held, size = [], 0
        for batch in batches:
            for rows, out in self.scored(batch):
                row, query = np.nonzero((out >= self.low) & (out != NO_SCORE))
                ids = batch.column("vec_id").take(pa.array(rows[row]))
                held.append((query, out[row, query], ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
                size += len(query)
                if size > SCORES_AT_ONCE:
                    held = [self._first(held)]
                    size = len(held[0][0])
        if held:
            query, score, ids, null = self._first(held)
            yield {"block_query": query, "query_id": self.ids[query], "vec_id": pa.array(ids, mask=null), "score": score}

    def _first(self, held: list) -> tuple[np.ndarray, ...]:
        query, score, ids, null = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((ids, null, -score, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        return tuple(c[order[place < self.k]] for c in (query, score, ids, null))


def _over(vectors: DataFrame, block: Block, schema: str, rows: Callable) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(block)  # at most QUERIES_AT_ONCE vectors
    return arrow_map(vectors, schema, lambda batches: rows(shared.value, batches))


def _histograms(block: Block, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    query, bin_, n = block.histogram(batches)
    yield {"query": query, "bin": bin_, "n": n}


def _highest(vectors: DataFrame, block: Block) -> DataFrame:
    """The ``k`` best rows of each query of a block. A pass scores all rows and narrows each range to one of 256 bins."""
    while True:
        exact = bool((block.width == 1).all())
        found = _over(vectors, block, "query int, bin int, n long", _histograms)
        sums = found.groupBy("query", "bin").agg(F.sum("n").alias("n")).toArrow()  # at most BINS rows a query
        block.refine(*(sums.column(c).to_numpy() for c in ("query", "bin", "n")))
        if exact:
            break
    best = _over(vectors, block, "block_query int, query_id long, vec_id long, score long", Block.best)
    order = Window.partitionBy("block_query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= block.k)
    return materialize(ranked.select("query_id", "rank", "vec_id", "score"))


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
    queries_at_once: int = QUERIES_AT_ONCE,
) -> DataFrame:
    """For every row with ``is_query`` (over ``vec_id``) the ``k`` rows with the highest integer inner product.

    Returns (query_id, rank from 1, vec_id, score); equal scores are ordered by the smaller id, a null id last, and with
    fewer than ``k`` other rows all of them are returned. Components are scaled and rounded down; see
    ``integer_vectors`` for vectors that take no part. A missing component of a shorter vector counts as zero. Rows
    with the query's id are not among its candidates; a row that repeats takes a place each time; equal queries are
    one query, and different vectors with one id are queries of their own. A null id is never a query.

    Queries go to the tasks in blocks of bounded size. For each block all vectors are scored several times: sums of
    the tasks' histograms narrow down the k-th score of each query until it is exact, and the last pass returns only
    rows that reach it. Scores are never stored; a task returns at most ``k`` rows of a query, the driver sees 256
    counts of it.
    """
    spark = df.sparkSession
    vectors = materialize(integer_vectors(df, scale, None, id_col, vector_col))
    length = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x)
    queries = vectors.filter(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id", "q").agg(F.lit(1).alias("one"))
    asked = materialize(queries.select("vec_id", "q", length.alias("length")))
    size, longest = asked.count(), vectors.agg(F.max(length)).first()[0]
    if not size:
        return spark.createDataFrame([], RESULT)
    blocks = -(-size // queries_at_once)
    dealt = materialize(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks))))
    results = []
    for i in range(blocks):
        rows = dealt.filter(F.col("block") == i).orderBy("vec_id", "q").toArrow()
        if rows.num_rows:
            q = rows.column("q").combine_chunks()
            width = int(np.diff(q.offsets.to_numpy()).max(initial=0))
            ids, lengths = rows.column("vec_id").to_numpy(), rows.column("length").to_numpy()
            results.append(_highest(vectors, Block(ids, matrix(q, width), lengths, float(longest), k)))
    return reduce(DataFrame.unionByName, results)
