import re
from collections import defaultdict
from fractions import Fraction
from itertools import permutations
from math import factorial

from made_texts import prose

from opsmart.llm import audit, queries


def plain_failures(rows):
    """Set of failed filters for every (doc_id, text, part)."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield {
            f for f, fails in zip("ABCDE", (
                len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                bool(re.search(r"[#$%&*|]", text)), i is not None and i > least[text],
            )) if fails
        }


def plain_audit(rows, labels):
    """Every order, one filter after the other over all documents."""
    good, toxic = ({i for i, *v in labels if i is not None and v[at] == 1} for at in (0, 1))
    parts = defaultdict(list)
    for row, fails in zip(rows, plain_failures(rows)):
        parts[row[2] or ""].append((row[0], fails))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                lost = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                gone = sum(f in d[1] for d in docs) - len(lost)
                shapley[f] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), gone, sum(d[1] == {f} for d in docs), sum(d[0] in good for d in lost), sum(d[0] in toxic for d in lost), f]
        for key, values in out.items():
            if key[0] == part:
                values[-1] = shapley[values[-1]]
    return out


def as_dict(df):
    return {tuple(r)[:3]: list(r)[3:] for r in df.collect()}


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(4, 1, 0, 1), (4, 0, 1, 1), (5, 1, 1, 1), (9, 1, None, 1), (None, 1, 1, 1), (7, None, None, 1)],
        "doc_id long, quality int, toxic int, part int",
    )
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_documents.collect()]
    found = audit.audit(odd_documents, labels)
    assert as_dict(found) == plain_audit(rows, [tuple(r)[:3] for r in labels.collect()])
    assert found.count() == 2 * 600
    assert audit.audit(no_documents, labels).count() == 0
    assert audit.audit(odd_documents, labels.limit(0)).count() == 1200


def test_bounds_of_the_filters():
    words = " ".join(f"w{i}" for i in range(199))
    assert audit.failures(words.encode()) == 1 and audit.failures((words + " x").encode()) == 0
    assert audit.failures(b"a a") == 1 and audit.failures(b"a a a") == 3  # exactly half is enough
    assert audit.failures(("A" * 3 + "é" * 97).encode()) == 1 and audit.failures(("A" * 4 + "é" * 97).encode()) == 5
    assert audit.failures("a\x1cb\x85c é|".encode()) == 9  # one word of four characters, another with a symbol


def test_copies_of_one_text_make_a_third_of_all_rows(spark, many_ranges):
    rows = [(i, prose(1, 220), "en" if i % 3 else None) for i in range(400, 0, -1)] + [(1000 + i, prose(2 + i % 200, 30), "de") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(9)
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 1400, 3)]
    found = audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert as_dict(found) == plain_audit(rows, labels)


def test_least_squares_equal_the_average_over_all_orders():
    for n in (1, 2, 3, 5):
        value = [(s * 7919) % 31 + 5 * s.bit_count() for s in range(1 << n)]
        orders = list(permutations(range(n)))
        plain = [Fraction(0)] * n
        for order in orders:
            before = 0
            for i in order:
                plain[i] += value[before | 1 << i] - value[before]
                before |= 1 << i
        assert audit.shapley_values(value) == [p / factorial(n) for p in plain]


def test_query_against_all_orders(spark):
    folder = "/root/testdata/sf0.001"
    read = lambda name, *c: [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*c).collect()]
    found = as_dict(queries.op13_filter_audit(spark, folder))
    assert found == plain_audit(read("documents", "doc_id", "text", "lang"), read("labels", "doc_id", "quality", "toxic"))
