import random

import numpy as np
import pyarrow as pa
from made_texts import prose

from opsmart.llm import decontaminate, queries
from opsmart.llm.words import Texts


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def passages(items):
    return decontaminate._passages([(i, t, "") for i, t in items], decontaminate.Settings())


def hashed(text):
    return decontaminate.word_hashes(Texts.of(pa.array([text]), lower=True))[1].tolist()


def test_bitwise_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("abcdefg") for _ in range(rng.randint(1, 70))] for _ in range(2))
        own = decontaminate._passages([(1, " ".join(a), "")], decontaminate.Settings(stride=100))[0]
        assert decontaminate.lcs_length(own, hashed(" ".join(b))) == plain_lcs(a, b)


def planted(spark):
    """Documents with whole items, items with some words changed (the answer kept or not), and clean ones."""
    rng = random.Random(5)
    items = [(i, prose(1000 + i, 20 + i)) for i in range(20)] + [(20, prose(1020, 200))]
    docs, want = [], set()
    for i in range(120):
        text = prose(i, 150)
        item = items[i % 21][1].split()
        if i % 6 == 1:
            want.add((i, i % 21))
        if i % 6 == 2:  # paraphrase: a fifth to a third of the words changed, answer kept
            want.add((i, i % 21))
            item = [w if k >= len(item) - 6 or rng.random() > 0.25 else "changed" for k, w in enumerate(item)]
        if i % 6 == 3:  # half of the words is no paraphrase
            item = [w if k % 2 else "other" for k, w in enumerate(item)]
        if i % 6 in (1, 2, 3):
            text = text[:300] + " " + " ".join(item) + " " + text[300:]
        docs.append((i, text))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), want


def test_finds_planted_items_and_leaves_clean_documents(spark):
    docs, items, want = planted(spark)
    for settings in (decontaminate.Settings(), decontaminate.Settings(items=6)):  # one block of items or several
        found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items, settings).collect()}
        assert len(want - found) <= 0.1 * len(want) and not found - want
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert kept == set(range(120)) - {i for i, _ in decontaminate_pairs(docs, items)}


def decontaminate_pairs(docs, items):
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(docs, items).collect()}


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame(
        [(1, None, "a"), (2, "", "a"), (None, prose(5, 40), None), (4, prose(4, 30), ""), (4, prose(4, 30), ""), (5, "a", None)],
        "item_id long, text string, doc_id string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminations(odd_documents, items).collect()}
    assert {(4, 4), (9, 4)} <= found and (5, None) not in found and not {i for i, _ in found} & {1, 2, 3, 6}
    kept = decontaminate.drop_contaminated(odd_documents, items)
    assert kept.schema == odd_documents.schema and kept.filter("doc_id in (4, 9)").count() == 0
    assert kept.filter("doc_id in (1, 2, 3, 6)").count() == 4
    for docs, some in ((no_documents, items), (odd_documents, items.limit(0)), (no_documents, items.limit(0))):
        assert decontaminate.contaminations(docs, some).count() == 0
    assert decontaminate.drop_contaminated(odd_documents, items.limit(0)).count() == 12


def test_item_in_a_third_of_all_documents(spark):
    """Its own copies make all its words common, and the words around it are in no item."""
    items = [(i, prose(2000 + i, 30)) for i in range(6)]
    words = iter(range(10**6))
    other = lambda n: " ".join(f"q{next(words)}" for _ in range(n))
    hot = items[0][1].split()
    docs = [(i, f"{other(40 + i % 48)} {' '.join(hot) if i % 3 == 0 else ''} {other(60)}") for i in range(300)]
    # ordinary documents in which all of the hot item's words are common, never in its order
    docs += [(1000 + i, " ".join(f"{w} {other(2)}" for w in hot[::-1])) for i in range(100)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontaminate.contaminations(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, 0) for i in range(0, 300, 3)}


def test_single_parts_of_long_items(spark):
    """256 items of seven passages each: far more passages than one latent space has dimensions."""
    items = [(i, prose(5000 + i, 300)) for i in range(256)]
    docs = []
    for i in range(256):
        words, part = items[i][1].split(), i % 6 * 48
        docs.append((i, " ".join([prose(9000 + i, 30 + i % 48), *words[part:part + 48], prose(9500 + i, 60)])))
    docs, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminations(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(i, i) for i in range(256)}


def test_query_against_plain_comparison(spark):
    """All windows of all documents against all items by longest common subsequence; recall and no false ones."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = passages([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    share = {}
    for r in docs:
        words = hashed(r["text"] or "")
        for p in items:
            n = len(p.words)
            best = max(decontaminate.lcs_length(p, words[a:a + 2 * n]) / n for a in range(0, max(1, len(words) - n), max(1, n // 2)))
            share[r["doc_id"], p.item] = best
    want = {k for k, v in share.items() if v >= 0.8}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontamination(spark, folder).collect()}
    assert want and len(want & found) >= 0.9 * len(want)
    assert all(share[k] >= 0.5 for k in found) and np.isfinite(list(share.values())).all()
