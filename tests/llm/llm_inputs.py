"""Inputs shared by the operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, texts, ids=None):
    """documents with the given texts (ids from 0)."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(n, seed=0, vocabulary=400):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n))


def common(n, seed):
    """Words of one language: the same words in every text, a few of them very common."""
    words = sorted(set(prose(4000, seed=0, vocabulary=1500).split()))
    r = random.Random(seed)
    return " ".join(r.choices(words[:6], k=1)[0] if r.random() < 0.4 else r.choice(words) for _ in range(n))


def odd_texts():
    """Null, empty, blank, one word, very long, repeated, and text beyond ASCII."""
    long = prose(30_000, seed=3)
    return [None, "", " \t\n ", "word", long, long, "é\u00a0ü 漢字 😀 e\u0301", "a\x00b\x1fc\x7fd", prose(40, seed=4), prose(40, seed=4)]
