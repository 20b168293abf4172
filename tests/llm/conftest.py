import pytest
from made_texts import prose


@pytest.fixture
def odd_documents(spark):
    """Nulls in all columns, empty and long texts, repeated rows and columns that operators might use themselves."""
    columns = "doc_id long, text string, lang string, score double, row long, digest long, node long, fingerprint string, start long"
    extra = ("en", 1.0, 7, 7, 7, "x", 7)
    none = (None,) * 7
    rows = [
        (None, None, *none), (None, prose(1, 60), *none), (1, None, *none), (2, "", *extra), (3, " \n\t ", *extra),
        (4, prose(4, 90), *extra), (4, prose(4, 90), *extra), (5, prose(5, 30_000), *none), (6, "x" * 300_000, *extra),
        (7, "a", *extra), (8, "é ß ﬁ 日本語 👍 " * 40, *extra), (9, prose(4, 90), *extra),
    ]
    return spark.createDataFrame(rows, columns)


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)
