from made_texts import prose

from opsmart.llm import queries, toxicity


def labelled(spark, n=240):
    rows = []
    for i in range(n):
        words = prose(i, 120).split(" ")
        if i % 4 == 0:
            for k in range(10, len(words), 25):
                words[k] = ("vilegrub", "moldwretch", "scumfroth")[(i + k) % 3]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")


def test_learns_words_of_toxic_texts(spark):
    docs, labels = labelled(spark)
    model = toxicity.fit_toxicity(docs, labels.filter("doc_id < 180"))
    scored = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter("doc_id >= 180").collect()
    right = sum((r["score"] >= 0.3) == (r["toxic"] == 1) for r in scored)
    assert right >= 0.9 * len(scored)
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, model).collect()}
    assert kept == {r["doc_id"] for r in toxicity.score_toxicity(docs, model).filter("score < 0.3").collect()}


def test_one_kind_of_label_or_none(spark):
    docs, labels = labelled(spark, 12)
    for some, share in ((labels.filter("toxic = 0"), 0.0), (labels.limit(0), 0.0), (labels.filter("toxic = 1"), 1.0)):
        model = toxicity.fit_toxicity(docs, some)
        assert {r["score"] for r in toxicity.score_toxicity(docs, model).collect()} == {share}


def test_odd_rows(spark, odd_documents, no_documents):
    docs, labels = labelled(spark, 80)
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(odd_documents, model)
    assert scored.count() == 12 and scored.filter("score between 0 and 1").count() == 12
    assert scored.filter("doc_id in (1, 2, 3)").select("score").distinct().count() == 1
    assert toxicity.score_toxicity(no_documents, model).count() == 0
    kept = toxicity.drop_toxic(odd_documents, model)
    assert kept.schema == odd_documents.schema
    odd_labels = spark.createDataFrame([(None, 1), (4, 1), (4, 1), (5, 0), (1, None)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(odd_documents, toxicity.fit_toxicity(odd_documents, odd_labels)).count() == 12


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = queries.op5_toxicity(spark, folder).filter("held_out").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("score", "toxic", "predicted").toPandas()
    ranks = rows["score"].rank()
    n = (rows["toxic"] == 1).sum()
    area = (ranks[rows["toxic"] == 1].sum() - n * (n + 1) / 2) / n / (len(rows) - n)
    assert area > 0.95
