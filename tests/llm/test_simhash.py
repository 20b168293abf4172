import re

import numpy as np
import pyarrow as pa
import xxhash
from made_texts import prose

from opsmart.llm import queries, simhash
from opsmart.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_groups(values):
    values = list(values)
    group = {v: v for v in values}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 4:
                group[top(a)] = top(b)
    return {v: top(v) for v in values}


def test_fingerprints_equal_plain_ones():
    texts = ["", " ", None, "A b", "a B c", "a b c d", "É é\n\na  b c d e", "x " * 30, prose(1, 200), "a\x1cb c d e f"]
    got = simhash._fingerprints(pa.array(texts), 4, 42).astype(np.uint64)
    assert [int(g) for g in got] == [plain_fingerprint(t) for t in texts]


def random_values(n, seed=1):
    rng = np.random.default_rng(seed)
    values = {int(x) for x in rng.integers(0, 1 << 64, n, dtype=np.uint64)}
    for v in sorted(values)[: n // 8]:
        for _ in range(4):  # chains: each link up to six bits away
            for b in rng.choice(64, rng.integers(1, 7), replace=False):
                v ^= 1 << int(b)
            values.add(v)
    return values


def test_every_close_pair_meets_in_a_leaf():
    values = np.array(sorted(random_values(800)), np.uint64)
    met = set()
    for i, mask in enumerate(simhash.bands(3)):
        tree = simhash.VantageTree.build(values, mask, 5, i)
        row, leaf, home = tree.route(values, 1)
        assert home.sum() == len(values)
        for k in range(32):
            own, fixed = row[leaf == k], row[(leaf == k) & home]
            met |= {(int(a), int(b)) for a in own for b in fixed}
    close = np.argwhere(np.bitwise_count(values[:, None] ^ values[None, :]) <= 4)
    assert all((a, b) in met or (b, a) in met for a, b in close.tolist() if a != b)


def test_links_connect_what_plain_comparison_connects(spark):
    values = random_values(1500)
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fingerprint long")
    for leaf in (20, 100_000):  # small leaves are also cut into blocks
        found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(simhash.near_links(df, leaf=leaf)).collect()}
        want = plain_groups(values)
        together = lambda groups: {frozenset(k for k in values if groups.get(k, k) == g) for g in {groups.get(k, k) for k in values}}
        assert together(found) == together(want)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(7, i) for i in range(1000, 1200)]
    got = dict(components(spark.createDataFrame(chain + hub + [(5, 5)], "a long, b long")).collect())
    assert {got.get(i, i) for i in range(100, 161)} == {100}
    assert {got.get(i, i) for i in range(1000, 1200)} == {7} and 5 not in got


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(odd_documents).collect()]
    assert len(rows) == 12
    groups = dict(r for r in rows if r[0] is not None)
    assert groups[1] == groups[2] == groups[3] == 1 and groups[4] == groups[9] == 4  # empty texts are one group
    kept = simhash.drop_near_duplicates(odd_documents)
    assert kept.columns == odd_documents.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").distinct().dropna().collect()) == [1, 4, 5, 6, 7, 8]
    assert simhash.near_duplicates(no_documents).count() == 0 and simhash.drop_near_duplicates(no_documents).count() == 0


def test_query_against_plain_comparison(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    top = plain_groups(set(prints.values()))
    least = {}
    for i in sorted(prints):
        least.setdefault(top[prints[i]], i)
    rows = queries.op8_simhash(spark, folder).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {
        i: (f"{p:016x}", least[top[p]]) for i, p in prints.items()}
