import hashlib
import math

import numpy as np
import pytest

from opsmart.llm import queries, shallot, vectors


@pytest.fixture
def odd_vectors(spark):
    """Nulls in all columns, wrong lengths, non-finite and huge components, repeated rows and clashing names."""
    columns = "vec_id long, embedding array<float>, q string, cluster string, upper int, distance string"
    rows = [
        (None, None), (None, [0.5] * 4), (1, None), (2, []), (3, [0.1, None, 0.2, 0.3]), (4, [float("nan")] + [0.0] * 3),
        (5, [float("inf")] + [0.0] * 3), (6, [1e30] * 4), (7, [0.25] * 3), (8, [0.1, -0.2, 0.3, -0.4]), (8, [0.1, -0.2, 0.3, -0.4]),
        (8, [0.9, 0.9, 0.9, 0.9]), (9, [0.1, -0.2, 0.3, -0.4]), (10, [-1.0, -1.0, -1.0, -1.0]), (11, [0.0] * 4),
    ]
    return spark.createDataFrame([(*r, "x", "y", 1, None) for r in rows], columns)


def plain_clusters(rows, k, rounds, scale, seed=1):
    """Clusters by comparing every vector with every centroid."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    points = [v for _, v in sorted(kept, key=key)[:k]]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, p)), j) for j, p in enumerate(points))
    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for j in range(len(points)):
            own = [v for (_, v), c in zip(kept, of) if c == j]
            if own:
                points[j] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = {j: sum(d for _, d, c in found if c == j) for j in range(len(points))}
    digest = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points]
    return [(i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, d, c in found]


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, *r[:3]) if r[0] is not None else (False, 0, *r[1:3]))


@pytest.mark.parametrize("k,size,spread", [(1, 3, 4), (2, 3, 4), (7, 2, 3), (16, 8, 40), (40, 5, 6)])
def test_search_equals_comparing_with_every_centroid(k, size, spread):
    """Small grids are full of ties, equal centroids included."""
    rng = np.random.default_rng(k)
    x = rng.integers(-spread, spread + 1, (400, size))
    points = rng.integers(-spread, spread + 1, (k, size))
    near, second = np.zeros(400, np.int64), np.full(400, min(1, k - 1))
    upper, lower = np.full(400, np.inf), np.zeros(400)
    centroids = shallot.Centroids.of(points)
    looked = []
    for _ in range(6):
        near, second, upper, lower, n = shallot.assign(x, near, second, upper, lower, centroids)
        looked.append(n)
        every = ((x[:, None] - centroids.points[None]) ** 2).sum(axis=2)
        assert (near == every.argmin(axis=1)).all()  # argmin takes the first of equal ones
        best = np.sqrt(every.min(axis=1))
        assert (upper >= best - 1e-6).all()
        if k > 1:
            others = np.where(np.arange(k) == near[:, None], np.iinfo(np.int64).max, every).min(axis=1)
            assert (lower <= np.sqrt(others) + 1e-6).all()
        moved = np.array([x[near == j].sum(axis=0) // max((near == j).sum(), 1) if (near == j).any() else p for j, p in enumerate(centroids.points)])
        centroids = shallot.Centroids.of(moved, centroids.points)
    assert looked[-1] < 400 * k or k == 1


def test_bounds_save_distances():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (16, 8))
    x = np.concatenate([c + rng.integers(-20, 21, (100, 8)) for c in centres])
    state = np.zeros(1600, np.int64), np.ones(1600, np.int64), np.full(1600, np.inf), np.zeros(1600)
    *state, first = shallot.assign(x, *state, shallot.Centroids.of(centres))
    *state, again = shallot.assign(x, *state, shallot.Centroids.of(centres + 1, centres))
    assert first < 1600 * 16 and again == 0  # the centroids moved less than the gap between the bounds


def test_odd_rows_and_ties(spark, odd_vectors):
    kept = [(None, [0.5] * 4), *[(i, [np.float32(x) for x in v]) for i, v in [
        (8, [0.1, -0.2, 0.3, -0.4]), (8, [0.1, -0.2, 0.3, -0.4]), (8, [0.9] * 4), (9, [0.1, -0.2, 0.3, -0.4]), (10, [-1.0] * 4), (11, [0.0] * 4)]]]
    for k in (3, 16):
        got = shallot.cluster(odd_vectors, k=k, rounds=3, scale=64, size=4)
        assert in_order(got.collect()) == in_order(plain_clusters(kept, k, 3, 64))
    empty = shallot.cluster(odd_vectors.limit(0), size=4)
    assert empty.collect() == [] and empty.columns == got.columns


def test_integer_vectors_keep_what_fits(odd_vectors):
    kept = vectors.integer_vectors(odd_vectors, 256)
    assert {r["vec_id"] for r in kept.collect()} == {None, 2, 7, 8, 9, 10, 11}
    assert kept.filter("vec_id = 2").first()["q"] == [] and kept.filter("vec_id = 7").first()["q"] == [64, 64, 64]
    assert {r["vec_id"] for r in vectors.integer_vectors(odd_vectors, 256, 4).collect()} == {None, 8, 9, 10, 11}


def test_query_against_plain_clusters(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = queries.op11_centroid_clusters(spark, folder).collect()
    assert in_order(got) == in_order(plain_clusters(rows, 16, 3, 64))
