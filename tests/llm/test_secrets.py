import hashlib
import math
import random
import re
import string
from collections import Counter

from pyspark.sql import functions as F

from opsmart.llm import queries, secrets


def plain_windows(text, size, bits):
    """Windows over the bound, counted anew each."""
    out = []
    for i in range(len(text) - size + 1):
        counts = Counter(text[i:i + size])
        if -sum(c / size * math.log2(c / size) for c in counts.values()) >= bits - 1e-12:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + size)
            else:
                out.append((i, i + size))
    return out


def test_incremental_entropy_equals_counting_anew():
    text = "a3f9c1d27be04586" * 2 + "aaaaaaaabbbbbbbbaaaa" + "0123456789abcdef0f1e2d3c"
    for size, bits in ((8, 2.5), (20, 3.1), (24, 3.9)):
        assert secrets.high_entropy(text, size, bits) == plain_windows(text, size, bits)
    assert secrets.high_entropy("abc", 8, 1.0) == []


def test_patterns_are_leftmost_and_checked_after_matching():
    spans = secrets.pattern_spans
    assert spans("x PassWord = \"abcd1234\" y") == [(2, 22, "assign")]
    assert spans("token=short token: longer-than-8") == [(12, 32, "assign")]
    assert spans("secret: \"token: abcdefghij\"") == []  # the first match takes the word and fails
    long_s, kelvin = chr(0x17F), chr(0x212A)  # their lower-case forms are ASCII letters, but only A-Z have another case here
    assert spans(f"{long_s}ecret=abcdefgh1 to{kelvin}en=abcdefgh1") == []
    assert spans("AKIA" + "A" * 11) == [] and spans("AKIA" + "A" * 12) == [(0, 16, "access")]
    assert spans("0" * 31 + "g" + "f" * 32) == [(32, 64, "hex")]


def test_random_keys_of_every_alphabet_are_found():
    rng, scan = random.Random(3), secrets.Scanner()
    lower, upper, digits = string.ascii_lowercase, string.ascii_uppercase, string.digits
    for alphabet in (lower + upper + digits, lower + digits, upper + digits, upper + "234567", lower + "234567"):
        for size in (20, 22, 24, 32):
            for before in ("key ", "example_", "0123456789", "a-b/example/"):
                keys = ["".join(rng.choices(alphabet, k=size)) for _ in range(150)]
                found = sum(any(e - s >= size * 0.8 for s, e, _ in scan(f"{before}{k} end")) for k in keys)
                assert found >= 0.9 * len(keys), (alphabet, size, before, found)


def test_joined_words_and_sample_keys_are_no_secrets():
    scan = secrets.Scanner()
    for text in (
        "section_4_paragraph_12_of_the_act_of_1984", "some/path/to/a/file_2024_final_version", "iso-8859-1-and-utf-8-encodings-of-text",
        "2024-01-31T10-20-30Z_2024-02-01", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "01234567890123456789abcdefghij0123456789",
        "123e4567-e89b-12d3-a456-426614174000_example", "aaaaaaaaaaaaaaaaaaaaaaaaa1", "x" * 40 + "1",
    ):
        assert scan(f"see {text} here") == [], text


def test_spans_added_by_entropy_and_allow_list():
    scan = secrets.Scanner()
    key = "Zx9Kq2LmN8pR4tVw7YbC3dFgH6jQsT1u"
    assert [s[2] for s in scan(f"the {key} here")] == ["entropy_mixed"]
    assert scan("the 123e4567-e89b-12d3-a456-426614174000 here") == []
    assert scan("thewordsthatarejoinedwithoutdigits here") == []
    assert [s[2] for s in scan(f"token={key}")] == ["assign"]  # inside a pattern's span nothing is added
    assert scan("👍 é token=abcdefgh12")[0][:2] == (4, 20)  # code points


def test_odd_rows(odd_documents, no_documents):
    found = secrets.secret_spans(odd_documents)
    assert found.count() == 12 and found.filter(F.size("secrets") > 0).count() == 0
    assert secrets.secret_spans(no_documents).count() == 0
    clean = secrets.redact(odd_documents)
    assert clean.schema == odd_documents.schema and clean.exceptAll(odd_documents).count() == 0


def test_redaction_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, "a password=abcdefgh1 b AKIA" + "B" * 16 + " c")], "doc_id long, text string")
    assert secrets.redact(df).first()["text"] == "a [SECRET] b [SECRET] c"


def test_query_against_plain_search(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    patterns = {
        "assign": r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)",
        "access": r"(AKIA)([A-Z0-9]+)", "hex": r"()([0-9a-f]+)",
    }
    least = {"assign": lambda m: len(m[2]) >= 8, "access": lambda m: len(m[0]) >= 16, "hex": lambda m: len(m[0]) >= 32}
    rows = queries.op1_secret_scan(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        own = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p) in enumerate(patterns.items())
               for m in re.finditer(p, texts[r["doc_id"]]) if least[k](m)]
        listed = ",".join(x[2] for x in sorted(own))
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r["spans"].split(","))
