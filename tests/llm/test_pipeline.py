import re
from collections import Counter

import corpus_pipeline
import pytest
import xxhash
from made_texts import prose
from pyspark.sql import functions as F

from opsmart.llm import packing, queries, simhash, toxicity


@pytest.fixture
def folder(spark, tmp_path):
    """A small corpus: clean texts, toxic ones, copies, near-copies, benchmark passages and secrets."""
    rows = []
    for i in range(160):
        text = prose(i, 160)
        if i % 4 == 0:
            words = text.split(" ")
            for k in range(5, len(words), 18):
                words[k] = ("vilegrub", "moldwretch", "scumfroth")[(i + k) % 3]
            text = " ".join(words)
        rows.append((i, text, "en", "s", len(text)))
    rows += [(200, rows[1][1], "en", "s", 1), (201, rows[1][1] + " end", "en", "s", 1), (1, rows[1][1], "en", "s", 1)]
    item = prose(900, 40)
    rows += [(210, prose(210, 90) + " " + item + " " + prose(211, 50), None, None, None)]
    rows += [(220, prose(220, 80) + " password=abcdefgh12345 " + prose(221, 30), "en", "s", 1), (230, None, "en", "s", 1)]
    rows += [(231, "", "en", "s", None), (None, None, None, None, None)]
    rows += [(240, prose(240, 90), "en", "s", 1), (240, prose(241, 90), "en", "s", 2), (240, prose(240, 90), "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept[name] = [r["doc_id"] for r in docs.collect()]
    clean = {i for i in range(160) if i % 4} | {210, 220}
    toxic = {i for i in range(160) if i % 4 == 0}
    assert len(clean - set(kept["toxicity"])) <= 3 and len(toxic & set(kept["toxicity"])) <= 4
    near = kept["simhash_near_dedup"]
    assert not {200, 201} & set(near) and near.count(1) == 1 and None in near and len({230, 231} & set(near)) == 1
    assert near.count(240) == 2  # two texts that are no near copies, one of them twice
    assert 210 in near and 210 not in kept["benchmark_decontamination"]
    assert len(set(near) - set(kept["benchmark_decontamination"])) == 1
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "abcdefgh12345" not in texts[220] and "[SECRET]" in texts[220]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    ones = Counter(b for x in shingles for b in range(64) if xxhash.xxh64_intdigest(x.encode(), 42) >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def plain_near_dedup(rows):
    """The first row of the smallest id of each group, all pairs compared."""
    prints = [plain_fingerprint(r[1] or "") for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                group[top(i)] = top(j)
    kept = [r for r in rows if r[0] is None]
    for g in {top(i) for i in range(len(rows))}:
        own = [(r[0], prints[i] if prints[i] < 1 << 63 else prints[i] - (1 << 64), r[1] is not None, r[1] or "", r) for i, r in enumerate(rows) if top(i) == g and r[0] is not None]
        kept += [min(own, key=lambda x: x[:4])[4]] if own else []
    return kept


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_run_against_brute_force(spark, folder):
    """All stages by plain code but for the learned scores of the first one and the places of pieces in the last one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    texts = docs.select("text").distinct().withColumn("doc_id", F.monotonically_increasing_id()).cache()
    score = {r["text"]: r["score"] for r in texts.join(toxicity.score_toxicity(texts, model), "doc_id").collect()}
    rows = [tuple(r) for r in docs.collect() if score[r["text"]] < 0.3]
    rows = plain_near_dedup(rows)
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"].lower().split()
    rows = [r for r in rows if longest_common(item, (r[1] or "").lower().split()) < 0.8 * len(item)]
    secret = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]{8,}")
    full = packing.WordTokenizer(queries.tokenizer_path()).full
    tokens = lambda text: len(full.encode(secret.sub("[SECRET]", text or ""), add_special_tokens=False).ids) + 1
    want = Counter((r[0], tokens(r[1])) for r in rows)
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = Counter((r["doc_id"], r["length"]) for r in pieces)  # no document here is longer than a sequence
    assert whole == want
    room = Counter()
    for r in pieces:
        room[r["sequence_id"]] += r["length"]
    assert max(room.values()) <= corpus_pipeline.SEQUENCE_TOKENS
    assert len(room) <= -(-sum(room.values()) // corpus_pipeline.SEQUENCE_TOKENS) + 1


def test_empty_corpus(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder) if docs.columns[0] == "doc_id" and "text" in docs.columns else docs
    assert docs.count() == 0


def test_stage_names_follow_the_order():
    assert [re.sub("_.*", "", n) for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "benchmark", "secret", "best"]
    assert simhash.BITS == 64
