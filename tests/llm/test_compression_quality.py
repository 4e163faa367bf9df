import random

from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import compression_quality as Q

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed):
    r = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        w = [r.choice(prose(200, seed=1).split()) for _ in range(r.randint(60, 200))]
        texts.append(" ".join(w) if good else " ".join(x.upper() + r.choice(["!!", "###", "$$$"]) for x in w))
        labels.append(int(good))
    return texts, labels


def test_held_out_accuracy(spark):
    texts, labels = corpus(400, 2)
    docs = docs_df(spark, texts)
    known = spark.createDataFrame([(i, y, 0) for i, y in enumerate(labels) if i < 300], LABELS)
    model = Q.train(docs, known, sample=100)
    out = Q.score(docs, model).where("doc_id >= 300").orderBy("doc_id").collect()
    assert sum(r["predicted"] == y for r, y in zip(out, labels[300:])) >= 98
    assert all(0 <= r["score"] <= 1 for r in out)
    assert Q.train(docs, known, sample=100) is not None and [r["score"] for r in out] == [
        r["score"] for r in Q.score(docs, Q.train(docs, known, sample=100)).where("doc_id >= 300").orderBy("doc_id").collect()
    ]


def test_odd_rows_nulls_and_conflicting_labels(spark):
    texts = odd_texts() + corpus(60, 3)[0]
    docs = docs_df(spark, texts).withColumn("score", F.lit("x")).withColumn("quality", F.lit(3))
    rows = [(i, i % 2, 0) for i in range(8, 60)] + [(None, 1, 0), (9, None, 0), (9, 0, 0), (9, 1, 1), (10**9, 1, 0)]
    labels = spark.createDataFrame(rows, LABELS)
    out = Q.score(docs, Q.train(docs, labels)).orderBy("doc_id").collect()
    assert len(out) == len(texts) and all(0 <= r["score"] <= 1 for r in out)
    assert out[0]["score"] == out[1]["score"]  # null is scored as empty
    assert out[4]["score"] == out[5]["score"]
    assert out[0]["quality"] == 3


def test_one_class_no_labels_and_no_documents(spark):
    docs = docs_df(spark, corpus(10, 1)[0])
    good = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], LABELS)
    assert {r["score"] for r in Q.score(docs, Q.train(docs, good)).collect()} == {1.0}
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in Q.score(docs, Q.train(docs, none)).collect()} == {0.5}
    empty = docs_df(spark, [])
    assert Q.score(empty, Q.train(empty, good)).count() == 0
