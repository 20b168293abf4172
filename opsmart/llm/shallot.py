"""Exact centroid clustering of integer vectors with the bounds of the Shallot search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import arrow_map, materialize
from .vectors import integer_vectors, matrix

#: Bounds are doubles; a bound decides only where it does so by more than this share.
MARGIN = 1e-9
STATE = "vec_id long, q array<int>, cluster int, second int, upper double, lower double"


def squared(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances of rows, exact."""
    gap = x - points
    return np.einsum("ij,ij->i", gap, gap)


@dataclass(frozen=True)
class Centroids:
    """Integer centroids, and for each of them all others in order of their distance from it."""

    points: np.ndarray
    order: np.ndarray
    gaps: np.ndarray
    moves: np.ndarray  # how far each went in the last update

    @classmethod
    def of(cls, points: np.ndarray, before: np.ndarray | None = None) -> Centroids:
        k = len(points)
        every = np.sqrt(np.array([squared(points, p) for p in points], float).reshape(k, k))
        order = np.argsort(every, axis=1, kind="stable")
        gaps = np.take_along_axis(every, order, axis=1)
        own = order == np.arange(k)[:, None]  # equal centroids may stand before it
        order, gaps = order[~own].reshape(k, max(k - 1, 0)), gaps[~own].reshape(k, max(k - 1, 0))
        return cls(points, order, gaps, np.zeros(k) if before is None else np.sqrt(squared(points, before).astype(float)))


def assign(
    x: np.ndarray, near: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: Centroids
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest and second-nearest centroid of each row with their bounds, and how many distances were computed.

    ``upper`` bounds the distance to ``near`` from above, ``lower`` that to all other centroids from below. Both are
    widened by the centroids' moves; rows whose bounds still part need no distance, and one distance if a fresh upper
    bound parts them. Others start from the closer one of the two remembered centroids and scan its neighbours
    outwards. A centroid farther from it than the distances to nearest and second-nearest together can be neither
    of them, so this ball shrinks with every closer one found and ends the scan. Distances are compared as integers;
    of equal ones the smaller number counts as nearer.
    """
    points, moves, k = centroids.points, centroids.moves, len(centroids.points)
    near, second, upper, lower = near.copy(), second.copy(), upper.copy(), lower.copy()
    if k == 1:
        near[:] = 0
        return near, second, upper, lower, 0
    top = np.argsort(moves)[::-1][:2]
    upper = (upper + moves[near]) * (1 + MARGIN)
    lower = (lower - np.where(near == top[0], moves[top[1]], moves[top[0]])) * (1 - MARGIN)
    todo = np.flatnonzero(upper >= lower)
    nearest = squared(x[todo], points[near[todo]])
    looked = len(todo)
    upper[todo] = np.sqrt(nearest) * (1 + MARGIN)
    open_ = upper[todo] >= lower[todo]
    todo, nearest = todo[open_], nearest[open_]

    rows, a, b = x[todo], near[todo], second[todo]
    farther = squared(rows, points[b])
    looked += len(todo)
    swap = (farther < nearest) | ((farther == nearest) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    nearest, farther = np.where(swap, farther, nearest), np.where(swap, nearest, farther)
    home, inner = a.copy(), np.sqrt(nearest)
    active = np.arange(len(todo))
    for step in range(k - 1):
        reach = (inner[active] + np.sqrt(farther[active])) * (1 + MARGIN)
        active = active[centroids.gaps[home[active], step] <= reach]
        if not len(active):
            break
        j = centroids.order[home[active], step]
        fresh = (j != a[active]) & (j != b[active])
        at, j = active[fresh], j[fresh]
        distance = squared(rows[at], points[j])
        looked += len(at)
        first = (distance < nearest[at]) | ((distance == nearest[at]) & (j < a[at]))
        next_ = ~first & ((distance < farther[at]) | ((distance == farther[at]) & (j < b[at])))
        m = at[first]
        b[m], farther[m], a[m], nearest[m] = a[m], nearest[m], j[first], distance[first]
        b[at[next_]], farther[at[next_]] = j[next_], distance[next_]
    near[todo], second[todo], upper[todo], lower[todo] = a, b, np.sqrt(nearest), np.sqrt(farther)
    return near, second, upper, lower, looked


def _assigned(state: DataFrame, centroids: Centroids, last: bool) -> DataFrame:
    """One round over all vectors; the last one adds the exact squared distance."""
    context = state.sparkSession.sparkContext
    shared = context.broadcast(centroids)  # k centroids and k * k distances: bounded by the parameter k

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = shared.value
        for batch in batches:
            x = matrix(batch.column("q"), held.points.shape[1])
            known = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "second", "upper", "lower")]
            near, second, upper, lower, _ = assign(x, *known, held)
            out = {"vec_id": batch.column("vec_id"), "q": batch.column("q"), "cluster": near, "second": second, "upper": upper, "lower": lower}
            yield out | ({"distance": squared(x, held.points[near])} if last else {})

    return arrow_map(state, STATE + (", distance long" if last else ""), rows)


def _sums(state: DataFrame, width: int) -> DataFrame:
    """(cluster, i, n, total): vectors of each cluster and sums of their components, added up per batch first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            owner, x = batch.column("cluster").to_numpy(), matrix(batch.column("q"), width)
            clusters, owner = np.unique(owner, return_inverse=True)
            totals = np.zeros((len(clusters), width), np.int64)
            np.add.at(totals, owner, x)
            yield {
                "cluster": np.repeat(clusters, width), "i": np.tile(np.arange(width), len(clusters)),
                "n": np.repeat(np.bincount(owner), width), "total": totals.ravel(),
            }

    parts = arrow_map(state.select("cluster", "q"), "cluster int, i int, n long, total long", rows)
    return parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def start_points(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids hash lowest, in order of the hash; a null id is hashed as an empty text."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = vectors.select(key.alias("key"), "q").orderBy("key", "q").limit(k).collect()
    return np.array([r["q"] for r in chosen], np.int64)


def cluster(
    df: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, size: int = 64, seed: int = 1,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Clusters of vectors by ``rounds`` rounds of assignment and update and a last assignment, exact in integers.

    Returns (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector of exactly
    ``size`` components, scaled and rounded down; see ``integer_vectors`` for what is left out. A round is one pass over
    a written table, which remembers for each vector its nearest and second-nearest centroid and two bounds; only ``k``
    sums pass through the driver. Ties go to the smaller number, an empty centroid stays where it was. With fewer
    than ``k`` vectors each is a centroid; equal vectors give equal centroids, of which the later ones stay empty.
    Without vectors there are no rows.
    """
    spark = df.sparkSession
    vectors = materialize(integer_vectors(df, scale, size, id_col, vector_col))
    points = start_points(vectors, k, seed)
    if not len(points):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    centroids = Centroids.of(points)
    fresh = {"cluster": F.lit(0), "second": F.lit(min(1, len(points) - 1)), "upper": F.lit(float("inf")), "lower": F.lit(0.0)}
    state, old = vectors.withColumns(fresh), vectors
    for _ in range(rounds):
        state = materialize(_assigned(state, centroids, False))
        discard(old)
        old, moved = state, centroids.points.copy()
        for r in _sums(state, size).collect():  # k * size rows
            moved[r["cluster"], r["i"]] = r["total"] // r["n"]
        centroids = Centroids.of(moved, centroids.points)
    final = materialize(_assigned(state, centroids, True).select("vec_id", "cluster", "distance"))
    discard(old)
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in centroids.points.tolist()]
    named = F.array(*map(F.lit, digests))
    per_cluster = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = F.broadcast(per_cluster)  # k rows
    return final.join(sums, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia",
        final.agg(F.sum("distance")).scalar().alias("inertia"), named[F.col("cluster")].alias("centroid_sha256"),
    )
