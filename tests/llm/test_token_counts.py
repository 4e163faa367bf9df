import math
import random

import pytest
from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import token_counts as C
from tidemark.llm.registry import tokenizer_file

SMALL = C.Vocabulary(
    {p: -math.log(r + 2) for r, p in enumerate(["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aba", "bab", "é", "▁abab"])}, -30.0
)


def brute(word, v):
    """Best cut of a pre-token by trying every one."""
    best = {0: (0.0, 0)}
    w = C.WORD_MARK + word
    for end in range(1, len(w) + 1):
        n = len(w[end - 1].encode())
        options = [(best[end - 1][0] + n * v.byte, -(best[end - 1][1] + n))]
        options += [(best[s][0] + v.scores[w[s:end]], -(best[s][1] + 1)) for s in range(end) if w[s:end] in v.scores]
        top = max(options)
        best[end] = (top[0], -top[1])
    return best[len(w)][1], best[len(w)][0]


def test_trie_matches_brute_force_and_shares_prefixes():
    r = random.Random(1)
    words = ["".join(r.choice("abcé") for _ in range(r.randint(1, 9))) for _ in range(300)]
    trie = C.TrieCounter(SMALL)
    found = trie.count(words)
    for w in words:
        n, s = brute(w, SMALL)
        assert found[w][0] == n and abs(found[w][1] - s) < 1e-9
    prefixes = {(C.WORD_MARK + w)[:i] for w in words for i in range(1, len(w) + 2)}
    assert trie.nodes == len(prefixes)  # every prefix once


def test_matches_the_unigram_model_of_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    v = C.load_vocabulary(tokenizer_file("piece_bpe_32k.model"))
    model = tokenizers.models.Unigram([("<unk>", -1000.0), *v.scores.items()], unk_id=0)
    words = [w for w in prose(500, seed=3).split()]
    found = C.TrieCounter(v).count(words)
    for w in set(words):
        assert found[w][0] == len(model.tokenize(C.WORD_MARK + w))


def test_documents_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "MAX_KNOWN", 50)
    texts = odd_texts() + [prose(300, seed=5)]
    docs = docs_df(spark, texts).withColumn("n_tokens", F.lit("x")).withColumn("known", F.lit(2))
    out = C.count_tokens(docs, SMALL).orderBy("doc_id").collect()
    for r, t in zip(out, texts):
        w = [x for x in (t or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
        each = {x: brute(x, SMALL) for x in set(w)}
        assert (r["n_words"], r["n_tokens"]) == (len(w), sum(each[x][0] for x in w))
        assert abs(r["log_score"] - sum(each[x][1] for x in w)) < 1e-6 * max(1, abs(r["log_score"]))
        assert r["known"] == 2
    assert C.count_tokens(docs_df(spark, []), SMALL).count() == 0
