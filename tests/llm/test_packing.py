import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from opsmart.llm import packing, queries
from opsmart.llm.words import Texts


def fewest(items, size):
    """Fewest sequences by trying all ways."""
    items = sorted(items, reverse=True)
    best = [len(items)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms)}.values():
            if rooms[k] >= items[i]:
                place(i + 1, [*rooms[:k], rooms[k] - items[i], *rooms[k + 1:]])
        place(i + 1, [*rooms, size - items[i]])

    place(0, [])
    return best[0]


def test_fixed_sets_keep_an_optimal_packing():
    rng = random.Random(3)
    for _ in range(300):
        size = rng.choice([10, 13, 20, 30])
        items = [rng.randint(max(1, size // rng.choice([3, 5, 20])), size) for _ in range(rng.randint(1, 9))]
        fixed, left = packing.reduce_by_dominance(Counter(items), size)
        rest = [k for k, n in left.items() for _ in range(n)]
        assert sum(times for _, times in fixed) + fewest(rest, size) == fewest(items, size)


def test_plan_places_every_piece_within_size():
    rng = random.Random(4)
    counts = Counter(rng.choice([5, 40, 40, 77, 100, rng.randint(1, 100)]) for _ in range(3000))
    placed = Counter()
    for holds, many in packing.plan(counts, 100):
        assert sum(k * n for k, n in holds.items()) <= 100
        for k, n in holds.items():
            placed[k] += n * many
    assert placed == counts


def test_ids_equal_the_tokenizer_on_odd_texts():
    words = packing.WordTokenizer(queries.tokenizer_path())
    texts = ["It's a TEST's, 12.5%; ÀÉß ﬁ Å̊ éx, e ́x <|endoftext|>", "", " ", "İstanbul ΣΑΣ,  a b\x1cz 'll, we'll: 日本語 👍, \x85a",
             "word. word, WORD word.. w! 1. é. É, ,", "x" * 5000]
    ids, counts = words(Texts.of(pa.array(texts)))
    ends = np.cumsum(counts)
    own = [ids[e - n:e].tolist() for e, n in zip(ends, counts)]
    assert own == [e.ids for e in words.full.encode_batch(texts, add_special_tokens=False)]


def test_odd_rows_and_gapless_sequences(odd_documents, no_documents):
    path = queries.tokenizer_path()
    pieces = packing.token_pieces(odd_documents, path, 64)
    packed = packing.pack(pieces, 64).cache()
    assert packed.filter("start = 0").count() == 12
    assert packed.filter("doc_id = 2").first()["length"] == 1  # the end token
    by_sequence = {}
    for r in packed.collect():
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    whole = packing.sequences(packed).select(F.sum(F.length("ids"))).first()[0]
    assert whole == 4 * packed.agg(F.sum("length")).first()[0]
    assert packing.pack(packing.token_pieces(no_documents, path), 64).count() == 0


def test_query_against_plain_tokenizing(spark):
    folder = "/root/testdata/sf0.001"
    full = packing.WordTokenizer(queries.tokenizer_path()).full
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = [*full.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for i, at in enumerate(range(0, len(ids), 2048)):
            cut = np.array(ids[at:at + 2048], "<u4")
            want[r["doc_id"], i] = (at, len(cut), zlib.crc32(cut.tobytes()))
    rows = queries.op2_best_fit_packing(spark, folder).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    used = len({r["sequence_id"] for r in rows})
    assert used <= 1.02 * -(-sum(r["length"] for r in rows) // 2048) + 1
