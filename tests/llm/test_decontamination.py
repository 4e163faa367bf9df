import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import decontamination as D
from tidemark.llm.common import arrow_batches

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))


def brute(texts, items, window, slop=0):
    """(n_words, n_hit, items) of each text."""
    out = []
    for t in texts:
        w = words(t)
        hit, found = set(), set()
        for item, text in items:
            v = words(text)
            size = min(window, len(v))
            for a in range(len(v) - size + 1 if v else 0):
                for s in range(len(w) - size + 1):
                    if w[s: s + size] == v[a: a + size]:
                        hit |= set(range(s, s + size))
                        found.add(item)
        out.append((len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def rows(df):
    return [(r["n_words"], r["n_hit"], list(r["items"])) for r in df.orderBy("id").collect()]


def test_matches_brute_force_also_in_parts(spark):
    passage = prose(40, seed=1)
    texts = [
        prose(200, seed=2), prose(50, 5) + " " + passage + " " + prose(50, 6), passage.upper().replace(" ", ", "),
        "x " + " ".join(passage.split()[:13]), "x " + " ".join(passage.split()[:12]), "few words", "", None,
        "the few words and few words",
    ]
    items = [(1, passage), (2, "few words"), (10, prose(30, seed=9)), (None, "x"), (3, None), (4, " .,"), (1, "few")]
    index = D.build_index(docs_df(spark, texts))
    df = spark.createDataFrame(items, "item_id int, text string")
    want = brute(texts, items, 13)
    assert rows(D.search(index, df)) == want
    assert rows(D.search(index, df, part_words=20)) == want  # several passes


def test_proximity(spark):
    index = D.build_index(docs_df(spark, ["a b x c", "a b c", "c b a", "a x x x b c"]))
    item = spark.createDataFrame([(1, "a b c")], "item_id int, text string")
    got = [len(r["matches"]) > 0 for r in D.search(index, item, slop=1).orderBy("id").collect()]
    assert got == [True, True, False, False]
    assert [r["matches"][0]["distance"] for r in D.search(index, item, slop=1).where("id < 2").orderBy("id").collect()] == [1, 0]


def test_odd_rows(spark):
    texts = odd_texts()
    docs = docs_df(spark, texts).withColumn("terms", F.lit(1)).withColumn("block", F.lit("x"))
    items = spark.createDataFrame([("é", " ".join(words(texts[4])[100:120])), (None, None)], "item_id string, text string")
    got = rows(D.search(D.build_index(docs), items))
    assert [g[0] for g in got] == [len(words(t)) for t in texts]
    assert [g[2] for g in got] == [["é"] if t == texts[4] else [] for t in texts]


def test_empty_tables_and_null_ids(spark):
    docs, items = docs_df(spark, ["a b"], ids=[None]), spark.createDataFrame([], "item_id int, text string")
    assert rows(D.search(D.build_index(docs), items)) == [(2, 0, [])]
    one = spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert rows(D.search(D.build_index(docs), one)) == [(2, 1, ["1"])]
    assert D.search(D.build_index(docs_df(spark, [])), one).count() == 0


def test_one_long_item_goes_over_several_parts(spark):
    passage = prose(400, seed=31)
    w = passage.split()
    texts = [prose(60, 32) + " " + " ".join(w[90:130]) + " " + prose(20, 33), " ".join(w[95:107]), passage, "", None]
    items = [(7, passage), (8, "w " + " ".join(w[100:112])), (9, None), (10, "")]
    index = D.build_index(docs_df(spark, texts))
    df = spark.createDataFrame(items, "item_id int, text string")
    want = brute(texts, items, 13)
    parts = list(D.read_phrases(df.coalesce(1), "item_id", "text", 13, 100))
    assert [p.n_words for p in parts] == [100, 100, 100, 89] and len({len(p.terms) > 0 for p in parts}) == 1
    assert rows(D.search(index, df, part_words=100)) == want == rows(D.search(index, df))
    found = {(r["block"], r["n"]): sorted((m["item_start"], m["start"]) for m in r["matches"] if m["item"] == "7")
             for r in D.search(index, df.where("item_id = 7"), part_words=100).collect()}
    assert [(i, i) for i in range(388)] == [x for x in next(v for v in found.values() if len(v) == 388)]


def test_a_block_takes_up_only_windows_of_its_anchors(spark):
    # common words in every window, none of which occurs: each has a term of its own as its anchor
    pieces = [(i, 0, np.array([0, 1, 2, 3 + i, 4], np.int32)) for i in range(10, 1000)] + [(1000, 0, np.array([0, 1, 2, 5, 4], np.int32))]
    table = D.Windows(5, pieces, 1003)
    assert len(table.anchored(np.array([0, 1, 2, 4, 5]))) == 1
    assert sorted(table.items[table.anchored(np.arange(1003))].tolist()) == sorted(i for i, _, _ in pieces)
    assert table.terms(table.anchored(np.array([20]))).tolist() == [[0, 1, 2, 20, 4]]


def test_each_block_is_a_row_group_of_its_own(spark):
    texts = [prose(30, seed=i) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "6")  # a block each
    try:
        index = D.build_index(docs_df(spark, texts).coalesce(1))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
    assert groups == [1] * 10 and index.count() == 10
    items = [(i, " ".join(words(texts[i])[5:25])) for i in range(0, 60, 7)]
    assert rows(D.search(index, spark.createDataFrame(items, "item_id int, text string"))) == brute(texts, items, 13)


def test_python_is_sent_batches_of_the_given_size_unless_the_session_sets_it(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    df = spark.range(0, 24, 1, 1).selectExpr("repeat('x', 1000000) AS text").mapInArrow(sizes, "n long")
    with arrow_batches(spark, 4 << 20):
        assert max(r["n"] for r in df.collect()) < 6 << 20
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, str(2 << 20))
    try:
        with arrow_batches(spark, 4 << 20):
            assert spark.conf.get(key) == str(2 << 20)
        assert spark.conf.get(key) == str(2 << 20)
    finally:
        spark.conf.unset(key)


def test_postings_of_a_block(spark):
    index = D.build_index(docs_df(spark, ["b a b", None, "a c"]).coalesce(1))
    got = sorted((r["ids"], r["lengths"], r["terms"], r["ends"], r["gaps"]) for r in index.collect())
    assert got == [([0, 1, 2], [3, 0, 2], ["b", "a", "c"], [2, 4, 5], [0, 2, 1, 2 * D.GAP + 2, 2 * D.GAP + 4])]
