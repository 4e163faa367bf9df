"""The pipeline stage by stage against brute-force versions of each stage."""

import os
import random

import corpus_pipeline as C
import pytest
from llm_inputs import common, docs_df
from pyspark.sql import functions as F
from test_decontamination import brute as contaminated
from test_near_duplicates import brute as duplicates
from test_pii import brute as patterns
from test_quality_rules import brute as counts
from tidemark.llm import packing

BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """A folder with small documents and benchmark tables that have a case for every stage."""
    r = random.Random(1)
    passage = common(30, seed=500)
    clean = [common(r.randint(80, 200), seed=i) for i in range(60)]
    texts = clean + [None, "", " \t\n ", "word", "é\u00a0ü 漢字 😀"]
    texts += [clean[3], clean[3] + " end", clean[5].capitalize(), "a b c d e " * 40]  # copies, near copy, repetition
    texts += [common(20, seed=600) + " " + passage + " " + common(20, seed=601)]
    texts += [clean[7][:200] + " mail bob.x@example.org or +1 (212) 555-0100 now " + common(100, seed=602)]
    path = str(tmp_path_factory.mktemp("sf"))
    docs = docs_df(spark, texts)
    docs.unionByName(docs_df(spark, [clean[9]], ids=[9])).write.parquet(f"{path}/documents.parquet")  # a repeated row
    spark.createDataFrame([(1, passage), (2, None), (3, "")], BENCH).write.parquet(f"{path}/benchmark.parquet")
    return path, passage


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_every_stage(spark, sf):
    path, passage = sf
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in C.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "personal data", "best-fit packing"]

    one = C.quality(spark, docs, path)
    assert one.columns == names
    texts, kept = rows(docs), rows(one)
    assert all(not counts(t)[5] for t in kept.values())
    assert {i for i, t in texts.items() if not counts(t)[5]} == set(kept)  # nothing here is far from the corpus

    two = C.near_duplicate(spark, one, path)
    assert two.columns == names
    ids = sorted(kept)
    want = {i for i, (_, _, k) in zip(ids, duplicates(ids, [kept[i] for i in ids], 5, 80)) if k}
    left = [r["doc_id"] for r in two.collect()]
    assert sorted(left) == sorted(want)  # the repeated row is there once

    three = C.decontaminate(spark, two, path)
    assert three.columns == names
    before, after = rows(two), rows(three)
    hit = contaminated([before[i] for i in sorted(before)], [(1, passage)], 13)
    assert set(after) == {i for i, (n, h, _) in zip(sorted(before), hit) if not (h > 0 and 20 * h >= n)}
    assert len(after) == len(before) - 1

    four = C.personal_data(spark, three, path)
    assert four.columns == names
    for r in four.collect():
        t = after[r["doc_id"]]
        spans = patterns(t)
        if not any(c.isdigit() or c == "@" for c in t):
            assert r["text"] == t
        assert not patterns(r["text"]) or not spans
        assert r["text"].count("[EMAIL]") >= sum(k == "email" for k, _, _ in spans)
        assert r["n_chars"] == len(r["text"])

    five = C.pack(spark, four, path)
    sizes = {}
    for r in five.collect():
        sizes.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sizes.values():
        end = 0
        for o, n in sorted(own):
            assert o == end
            end += n
        assert end <= 4096
    total = sum(n for own in sizes.values() for _, n in own)
    assert len(sizes) == -(-total // 4096)


def test_run_is_the_stages_in_order(spark, sf):
    path, _ = sf
    out = C.run(spark, path)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in C.STAGES[:4]:
        docs = stage(spark, docs, path)
    want = packing.tokenize(docs, C.tokenizer_file("word_bpe_49k.json")).select("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_empty_documents(spark, tmp_path):
    docs_df(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_a_copy_takes_no_other_text_of_its_id_along(spark):
    a, b = common(60, seed=1), common(60, seed=2)
    docs = docs_df(spark, [a, a, b, b + " x", a], [2, 5, 5, None, None])
    left = [tuple(r) for r in C.near_duplicate(spark, docs, "").select("doc_id", "text").collect()]
    assert sorted(left, key=str) == sorted([(2, a), (5, b), (None, b + " x"), (None, a)], key=str)


def test_extra_and_clashing_columns_pass_through(spark):
    clash = ["kept", "spans", "text_hash", "doc_key", "n_words", "id", "block", "in_1", "base_sha256"]
    docs = docs_df(spark, [common(120, seed=i) for i in range(60)])
    for c in clash:
        docs = docs.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    docs = docs.withColumn("rank", F.lit(7)).withColumn("n_email", F.lit(None).cast("string"))
    bench = "/root/testdata/sf0.001"
    if not os.path.isdir(bench):
        pytest.skip("driver tables not present")
    for _, stage in C.STAGES[:4]:
        out = stage(spark, docs, bench)
        assert out.schema.names == docs.schema.names
        got = out.collect()
        assert got
        for r in got:
            assert [r[c] for c in clash] == [f"{c}{r['doc_id']}" for c in clash] and (r["rank"], r["n_email"]) == (7, None)
