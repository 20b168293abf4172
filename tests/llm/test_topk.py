import math

import numpy as np
from pyspark.sql import functions as F
from test_shallot import odd_vectors  # noqa: F401

from opsmart.llm import queries, topk


def plain_top(rows, is_query, k, scale):
    """The best of all scores, sorted."""
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows]
    out = []
    for query, q in sorted({r for r in kept if r[0] is not None and is_query(r[0])}):
        scored = [(-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for i, v in kept if i != query]
        out += [(query, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ties_blocks_and_ranges(spark, many_ranges):
    """Many equal scores, vectors of different lengths and several blocks of queries."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, rng.choice([3, 3, 3, 2]))]) for i in range(300)] + [(300 + i, [1.0, 1.0, 1.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for scale in (1, 1000):
        for at_once in (3, 1000):
            found = topk.top_k(df, F.col("vec_id") % 20 == 0, 5, scale, queries_at_once=at_once)
            assert got(found) == plain_top(rows, lambda i: i % 20 == 0, 5, scale)


def test_selection_narrows_to_the_exact_score():
    rng = np.random.default_rng(2)
    for big in (False, True):
        x = rng.integers(-1 << 27, 1 << 27, (500, 4)) if big else rng.integers(-90, 90, (500, 4))
        lengths = (x[:9] ** 2).sum(axis=1)
        block = topk.Block(np.arange(9), x[:9], lengths, float((x**2).sum(axis=1).max()), 5)
        assert block.exact_doubles is not big
        import pyarrow as pa
        batch = pa.record_batch({"vec_id": pa.array(np.arange(500)), "q": pa.array(x.tolist(), pa.list_(pa.int32()))})
        while True:
            exact = (block.width == 1).all()
            block.refine(*block.histogram(iter([batch])))
            if exact:
                break
        every = x[:9] @ x.T
        every[np.arange(9), np.arange(9)] = topk.NO_SCORE
        assert (block.low == np.sort(every, axis=1)[:, -5]).all()


def test_odd_rows(spark, odd_vectors):  # noqa: F811
    kept = [(None, [0.5] * 4), (2, []), (7, [0.25] * 3), *[(i, [np.float32(x) for x in v]) for i, v in [
        (8, [0.1, -0.2, 0.3, -0.4]), (8, [0.1, -0.2, 0.3, -0.4]), (8, [0.9] * 4), (9, [0.1, -0.2, 0.3, -0.4]), (10, [-1.0] * 4), (11, [0.0] * 4)]]]
    for k in (2, 5, 50):
        found = topk.top_k(odd_vectors, F.col("vec_id") > 0, k, 256)
        assert got(found) == plain_top(kept, lambda i: i > 0, k, 256)
    assert topk.top_k(odd_vectors.limit(0), F.col("vec_id") > 0).collect() == []
    assert topk.top_k(odd_vectors, F.col("vec_id") < 0).collect() == []


def test_query_against_sorting_all_scores(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert got(queries.op12_exact_top_k(spark, folder)) == plain_top(rows, lambda i: i % 50 == 0, 5, 256)
