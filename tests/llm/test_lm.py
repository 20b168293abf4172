import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from made_texts import prose

from opsmart.llm import lm, queries


def test_filter_holds_every_count_level():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    levels = lm.level_of(rng.integers(1, 200, 4000))
    size = int(levels.sum()) * 12 // 8 * 8
    bits = np.zeros(size // 8, np.uint8)
    for level in range(1, levels.max() + 1):
        own = keys[levels >= level]
        for place in lm._places(own, level, np.full(len(own), size), 6):
            np.bitwise_or.at(bits, place >> 3, np.uint8(1) << (place & 7).astype(np.uint8))
    filters = lm.Filters(0, np.array([size]), np.array([0]), bits, 6)
    got = filters.levels(keys, 1)
    assert (got >= levels).all() and (got == levels).mean() > 0.98
    assert (filters.levels(rng.integers(0, 1 << 64, 4000, dtype=np.uint64), 1) == 0).mean() > 0.98


def test_query_against_plain_counts(spark):
    folder = "/root/testdata/sf0.001"
    tokens = {
        r["doc_id"]: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")) + [None]
        for r in spark.read.parquet(f"{folder}/documents.parquet").collect()
    }
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(t for i, own in tokens.items() if not held[i] for t in own)
    total, distinct = sum(counts.values()), len(counts)
    rows = queries.op7_lm_score(spark, folder).collect()
    assert len(rows) == len(tokens)
    gain = 0
    for r in rows:
        own = tokens[r["doc_id"]]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["held_out"] == held[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(t in counts for t in own), total)
        gain += (r["score"] - base) * r["held_out"]
    assert gain > 0  # the model is better than the base on what it has not seen


def test_bounds_do_not_change_the_scores(spark):
    df = spark.createDataFrame([(i, prose(i % 7, 150)) for i in range(40)], "doc_id long, text string")
    wide = lm.score_texts(df, lm.fit_ngrams(df))
    narrow = lm.Settings(head_words=20, block_bytes=400, shard_tokens=300, flush_tokens=500)
    model = lm.fit_ngrams(df, narrow)
    assert len(model.blocks) > 3
    a = {r["doc_id"]: r for r in wide.collect()}
    for r in lm.score_texts(df, model).collect():
        assert math.isclose(r["base_score"], a[r["doc_id"]]["base_score"], rel_tol=1e-9) and r["n_known"] == a[r["doc_id"]]["n_known"]
        assert abs(r["score"] - a[r["doc_id"]]["score"]) < 0.2 * abs(a[r["doc_id"]]["score"])


def test_followers_of_a_context_add_up_to_one_at_most(spark):
    """A context with a hundred followers, some of them frequent, with exact counts and with levels."""
    words = [f"w{i}" for i in range(100) for _ in range(1 + i % 7)]
    df = spark.createDataFrame([(i, f"ctx {w}") for i, w in enumerate(words)], "doc_id long, text string")
    for settings in (lm.Settings(head_words=0), lm.Settings()):
        model = lm.fit_ngrams(df, settings)
        different = pa.array([f"ctx w{i}" for i in range(100)])
        found = lm._scored(model, different, model.shards, model.head.value, [b.value for b in model.blocks])
        each = found["each"].reshape(100, 3)  # the context, its follower, the end
        assert 0.5 < each[:, 1].sum() <= 1 and (each > 0).all() and (each <= 1).all()
        assert np.allclose(np.log10(each).sum(axis=1), found["score"])


def test_a_worker_lets_go_of_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(i, prose(i % 7, 150)) for i in range(40)], "doc_id long, text string")
    model = lm.fit_ngrams(df, lm.Settings(block_bytes=400, shard_tokens=300, score_bytes=2000))

    def held(batches):
        from pyspark.core.broadcast import _broadcastRegistry

        for batch in batches:
            kept = [b for b in _broadcastRegistry.values() if isinstance(getattr(b, "_value", None), lm.Filters)]
            yield pa.record_batch({"n": pa.array([len(kept)] * batch.num_rows, pa.int64())})

    assert len(model.blocks) > 3
    assert lm.score_texts(df, model).select("score").mapInArrow(held, "n long").groupBy().max("n").first()[0] == 0


def test_odd_rows(odd_documents, no_documents):
    scored = lm.score_texts(odd_documents, lm.fit_ngrams(odd_documents))
    assert scored.count() == 12 and scored.filter("score <= 0 AND base_score < 0").count() == 12
    assert {r["n_tokens"] for r in scored.filter("doc_id in (1, 2, 3)").collect()} == {1}
    assert lm.score_texts(no_documents, lm.fit_ngrams(no_documents)).count() == 0
    untrained = lm.score_texts(odd_documents, lm.fit_ngrams(no_documents))
    assert untrained.count() == 12 and untrained.filter("n_known > 0").count() == 0
