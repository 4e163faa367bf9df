import random
from heapq import heappop

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import byte_bpe as B

FILE, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def own():
    return B.Codec(B.load_ranks(FILE), PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(codec, text):
    return np.frombuffer(codec.encode([text])[0], "<u4").tolist()


def take(q):
    rank = q.first()
    position = heappop(q.buckets[rank])
    if not q.buckets[rank]:
        q.close(rank)
    return rank, position


def test_queue_gives_ranks_in_order_and_the_leftmost_first():
    r, q = random.Random(1), B.RankQueue(50_256)
    held = []
    for _ in range(4000):
        if held and r.random() < 0.45:
            held.sort()
            assert take(q) == held.pop(0)
        else:
            entry = (r.choice([r.randrange(50_256), r.randrange(70), 50_255, 4095, 4096]), r.randrange(1000))
            held.append(entry)
            q.push(*entry)
    while held:
        held.sort()
        assert take(q) == held.pop(0)
    assert not q.buckets and not any(any(level) for level in q.levels)


def test_same_ids_as_the_library(own, library):
    r = random.Random(2)
    letters = "abeths'IİẞΣ.,éü漢字😀́\n\t \x1c\x85  ١½Ⅷ1234-#|<"
    texts = [x for x in odd_texts() if x] + ["don't I'LL we've  x\n\n y", "\n \n", "<|endoftext|>", "a" * 3000]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(20_000)]
    for t in texts:
        found = ids(own, t)
        assert found == library.encode_ordinary(t), t
        assert own.decode(own.encode([t])[0]) == t.encode()


@pytest.mark.parametrize("alphabet", ["abcdefgh", "a", "ab", "éü", "漢字語"])
def test_very_long_pre_tokens(own, library, alphabet):
    r = random.Random(3)
    t = "".join(r.choice(alphabet) for _ in range(20_000))
    assert ids(own, t) == library.encode_ordinary(t)


def test_long_texts_in_pieces_and_a_full_table(own, library, monkeypatch):
    t = prose(3000, seed=5)
    monkeypatch.setattr(B, "PIECES", 100)
    monkeypatch.setattr(B, "MAX_KNOWN", 50)
    monkeypatch.setattr(B, "AT_ONCE", 60)
    codec = B.Codec(own.ranks, PATTERN)
    texts = [t, "a" * 500, "", prose(20, seed=6), t, "x y"]
    found = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [library.encode_ordinary(x) for x in texts]
    assert [codec.decode(x) for x in found] == [x.encode() for x in texts]
    assert len(codec.known) + len(codec.older) <= 75 and all(len(x) <= B.MAX_KNOWN_CHARS for x in codec.known)


def test_merges_that_make_a_lower_rank():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 400, b"ab": 300, b"abc": 256, b"abcd": 350, b"cd": 450, b"aba": 500}
    codec, library = B.Codec(ranks, PATTERN), tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    r = random.Random(4)
    for _ in range(3000):
        t = "".join(r.choice("abcd") for _ in range(r.randint(1, 30)))
        assert ids(codec, t) == library.encode_ordinary(t), t


def test_frames(spark, library):
    texts = odd_texts()
    docs = docs_df(spark, texts, [None] + list(range(len(texts) - 1))).withColumn("ids", F.lit(7)).withColumn("decoded", F.lit("x"))
    both = B.encode(docs.repartition(3), FILE, PATTERN, decoded=True)
    two = B.decode(B.encode(docs, FILE, PATTERN), FILE, PATTERN)
    assert set(both.columns) == set(docs.columns)
    for df in (both, two):
        rows = df.collect()
        assert len(rows) == len(texts)
        for row in rows:
            t = row["text"] or ""
            assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == library.encode_ordinary(t)
            assert bytes(row["decoded"]) == t.encode()
    assert B.encode(docs.limit(0), FILE, PATTERN).count() == 0
    assert bytes(B.decode(docs.select(F.lit(None).cast("binary").alias("ids")).limit(1), FILE, PATTERN).first()["decoded"]) == b""


def test_query(spark, library):
    import hashlib

    from tidemark.llm.registry import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode_ordinary(d["text"])
        assert (got[d["doc_id"]]["n_tokens"], got[d["doc_id"]]["ids_sha256"], got[d["doc_id"]]["decoded_sha256"]) == (
            len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest(), hashlib.sha256(d["text"].encode()).hexdigest())
