import re
from collections import Counter

import numpy as np
import pyarrow as pa

from opsmart.llm import quality, queries


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_counts_equal_plain_counting():
    texts = ["a b c a b c d", "é ß\nx y\nx y\n \n\t\nx y", "", " ", "[#*] $%& |<>", "[a] [b] # *", "w " * 50, "a b a b a b", None, "a b c\x1cd"]
    got = quality.text_counts(pa.array(texts))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        assert tuple(int(got[n][i]) for n in names) == plain_counts(text or "")


def test_brackets_are_no_symbols():
    assert int(quality.text_counts(pa.array(["[a] [b] # *"]))["n_symbols"][0]) == 2


def test_query_against_plain_counting(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op3_quality_rules(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_words, *_, repeated = counts = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == counts
        assert r["base_failed"] == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert not (r["kept"] and r["base_failed"])


def test_trees_learn_and_respect_directions():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.1 * rng.standard_normal(2000) > 0.6).astype(float)
    trees = quality.fit_trees(x, y, [1, 0, -1])
    assert ((trees.score(x) > 0.5) == (y == 1)).mean() > 0.93
    for feature, direction in ((0, 1), (2, -1)):
        grid = np.repeat(rng.random((50, 3)), 40, axis=0)
        grid[:, feature] = np.tile(np.linspace(0, 1, 40), 50)
        steps = np.diff(trees.score(grid).reshape(50, 40), axis=1)
        assert (direction * steps >= -1e-12).all()


def test_no_labels_and_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (None, 1), (7, 0), (8, None)], "doc_id long, quality int")
    trees = quality.fit_quality(odd_documents, labels)
    judged = {(r["doc_id"], r["n_words"]): r for r in quality.judge(odd_documents, trees).collect()}
    assert quality.judge(odd_documents, trees).count() == 12
    assert judged[1, 0]["base_failed"] and not judged[1, 0]["kept"]
    assert quality.judge(no_documents, quality.fit_quality(no_documents, labels.limit(0))).count() == 0


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    trees = quality.fit_quality(docs, labels.filter("doc_id % 3 <> 0"))
    truth = labels.filter("doc_id % 3 = 0").select("doc_id", labels["quality"].alias("label"))
    scored = quality.judge(docs, trees).join(truth, "doc_id").toPandas()
    assert ((scored["quality"] >= 0.5) == (scored["label"] == 1)).mean() > 0.9
