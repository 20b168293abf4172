import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from opsmart.llm import chat, queries

HARD = ["", None, "\\", "<|", "\\<|", "<\\|", "<|im_end|>\n", "<|im_start|>user\nhi<|im_end|>\n", "<|nl|>", "a\\\\|b", "x\n<", "|im_start|>", "é👍\\n"]


def as_turns(spark, conversations):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_hard_texts_come_back(spark):
    talks = {i: [("user", t), ("assistant", u), ("system", t), ("assis\ntant<|", u)] for i, (t, u) in enumerate(
        [(a, b) for a in HARD for b in HARD])}
    windows = chat.chat_windows(as_turns(spark, talks))
    for r in chat.read_back(windows).collect():
        own = [(role, text or "") for role, text in talks[r["conv_id"]]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == own
        assert r["targets"] == [text for role, text in own if role == "assistant"]


def test_windows_keep_to_the_budget(spark):
    words = lambda n, w: " ".join(f"{w}{i}" for i in range(n))
    talks = {
        1: [("system", words(10, "s"))] + [(("user", "assistant")[i % 2], words(5 + 7 * (i % 9), "w")) for i in range(60)],
        2: [("user", words(300, "u")), ("assistant", words(4, "a"))] * 3,
        3: [("system", "only")],
    }
    windows = chat.chat_windows(as_turns(spark, talks), budget=200, history_turns=2, history_tokens=40).cache()
    rows = windows.withColumn("size", chat.tokens(F.col("formatted"))).orderBy("conv_id", "window").collect()
    assert len([r for r in rows if r["conv_id"] == 1]) > 5
    for r in rows:
        if r["conv_id"] == 1:
            assert r["size"] <= 200 and r["formatted"].startswith("<|im_start|>system\n")
            assert r["window"] == 0 or r["n_repeated"] >= 1
        for start, end in r["loss"]:
            assert r["formatted"][:start].endswith("<|im_start|>assistant\n") and r["formatted"][end:].startswith("<|im_end|>")
    assert any(r["n_repeated"] >= 2 for r in rows)
    assert {r["window"] for r in rows if r["conv_id"] == 2} == set(range(len([r for r in rows if r["conv_id"] == 2])))


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(None, 0, "user", "a", 1), (None, None, None, None, 1), (1, 0, "user", "x", 1), (1, 0, "user", "x", 1), (1, None, "assistant", "y", None)],
        "conv_id long, turn long, role string, text string, window long")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.read_back(chat.chat_windows(df)).collect()}
    assert got == {None: [("user", "a"), ("", "")], 1: [("user", "x"), ("user", "x"), ("assistant", "y")]}
    assert chat.read_back(chat.chat_windows(df.limit(0))).count() == 0
    assert chat.read_back(chat.chat_windows(df, history_turns=0)).count() == 2


@pytest.mark.parametrize("name,table", [("op9_chat_format", "conversations"), ("op10_url_filter", "pages")])
def test_queries_equal_their_sql(spark, name, table):
    folder = "/root/testdata/sf0.001"
    assert os.path.exists(f"{folder}/{table}.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = queries.QUERIES[name](spark, folder)
    result = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(str, result.fetchall())) == sorted(str(tuple(r)) for r in got.select(*names).collect())


def test_no_python_in_the_plans(spark):
    for name in ("op9_chat_format", "op10_url_filter"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_digest_of_control_strings(spark):
    row = queries.op9_chat_format(spark, "/root/testdata/sf0.001").filter("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["loss_chars"] == len(text)
