import numpy as np
import pyarrow as pa
from made_texts import prose

from opsmart.llm import chunks, queries
from opsmart.llm.words import Texts


def test_gear_hash_equals_the_rolling_one():
    data = np.frombuffer(prose(1, 60).encode(), np.uint8)
    h, rolled = 0, []
    for b in data:
        h = (h * 2 + int(chunks.GEAR[b])) % (1 << 32)
        rolled.append(h)
    assert chunks.gear_hashes(data).tolist() == rolled


def digests(text):
    c = chunks.chunk_arrays(Texts.of(pa.array([text])))
    return list(zip(c["digest"].tolist(), c["check"].tolist()))


def test_chunks_cover_the_text_and_resist_insertions():
    text = prose(2, 400)
    c = chunks.chunk_arrays(Texts.of(pa.array(["é one", None, text, "", text])))
    own = c["owner"] == 2
    assert c["words"][own].sum() == 400 and c["number"][own].tolist() == list(range(own.sum()))
    assert c["words"][own][:-1].min() >= 3
    assert c["digest"][own].tolist() == c["digest"][c["owner"] == 4].tolist() == [d for d, _ in digests(text)]
    assert text[c["start"][own][0]:c["end"][own][-1]] == text
    moved = set(digests("some new words " + text[:900] + " more new ones " + text[900:]))
    assert sum(d not in moved for d in digests(text)) <= 6
    assert max(chunks.chunk_arrays(Texts.of(pa.array(["same " * 500])))["words"]) <= 24


def test_passages_of_several_documents(spark):
    passage = prose(99, 60).replace("\n", " ")
    rows = [(i, prose(i, 80) + " " + passage + " " + prose(100 + i, 70)) for i in range(10)]
    rows += [(50, prose(50, 300)), (51, prose(51, 50) + "\n" + prose(51, 50)), (52, passage[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = chunks.repeated_passages(df)
    assert {r["doc_id"] for r in found.collect()} == set(range(10))
    texts = dict(rows)
    for r in found.collect():
        assert r["first_doc_id"] == 0 and r["later"] == (r["doc_id"] > 0)
        assert texts[r["doc_id"]][r["start"]:r["end"]] in passage
    cut = dict(chunks.without_repeats(df, found).collect())
    assert cut[0] == texts[0] and cut[50] == texts[50] and len(cut[3]) < len(texts[3]) - 150


def test_every_chunk_stays_in_a_document(spark):
    """A text, its extended form twice, and one whose new part is short and in the middle."""
    a, b, short, c = prose(31, 90), prose(32, 90), "six new words stand here now", prose(33, 90)
    rows = [(1, a), (5, f"{a} {b}"), (9, f"{a} {b}"), (12, f"{a} {short} {b} {c}"), (14, f"{a} {short} {b} {c}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = chunks.repeated_passages(df)
    cut = dict(chunks.without_repeats(df, found).collect())
    left = " ".join(cut[i] for i in sorted(cut)).split()
    assert cut[1] == a and cut[5].split()[-80:] == b.split()[-80:] and len(cut[9]) < 40
    assert not set(f"{a} {short} {b} {c}".split()) - set(left)
    kept = {d for i, t in rows for d in digests(t)}
    stays, passages = set(), found.filter("later").collect()
    for r in chunks.chunks(df).collect():
        gone = any(p["doc_id"] == r["doc_id"] and p["start"] <= r["start"] and r["end"] <= p["end"] for p in passages)
        if not gone:
            stays.add((r["digest"], r["check"]))
    assert stays == kept


def test_odd_rows(odd_documents, no_documents):
    found = {(r["doc_id"], r["later"]) for r in chunks.repeated_passages(odd_documents).collect()}
    assert found == {(4, False), (9, True)}  # copies of row 4 are the same document
    assert chunks.repeated_passages(no_documents).count() == 0


def test_query_against_plain_search(spark):
    folder = "/root/testdata/sf0.01"
    seen, shared, texts = {}, set(), {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = texts[r["doc_id"]] = (r["text"] or "").split()
        for i in range(len(words) - 19):
            if seen.setdefault(tuple(words[i:i + 20]), r["doc_id"]) != r["doc_id"]:
                shared.add(tuple(words[i:i + 20]))
    run_of = lambda words: max((sum(1 for _ in g) for g in _runs(words, shared)), default=0)
    long_runs = {i for i, words in texts.items() if run_of(words) + 19 >= 60}
    found = {r["doc_id"] for r in queries.op6_substring_dedup(spark, folder).collect()}
    assert len(long_runs - found) <= 0.01 * len(long_runs)
    some = {i for i, words in texts.items() if any(tuple(words[k:k + 20]) in shared for k in range(len(words) - 19))}
    assert len(found - some) <= 0.05 * len(found)


def _runs(words, shared):
    run = []
    for i in range(len(words) - 19):
        if tuple(words[i:i + 20]) in shared:
            run.append(i)
        elif run:
            yield run
            run = []
    if run:
        yield run
