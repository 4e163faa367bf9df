import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    wins = [tuple(w[i: i + 5]) for i in range(len(w) - 4)]
    n = Counter(wins)
    rep = {p for i, x in enumerate(wins) if n[x] > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(rep) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed)


def test_counts_match_brute_force(spark):
    texts = odd_texts() + ["a b c d e " * 4, "x\ny\nx\n\n\nx y", "a b c d e a b c d e f", prose(300, 5), "# * $ | <a> &"]
    docs = docs_df(spark, texts).withColumn("n_words", F.lit("clash")).withColumn("is_class", F.lit(1))
    out = Q.judge(docs).orderBy("doc_id").collect()
    got = [tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) for r in out]
    assert got == [brute(t) for t in texts]
    assert [r["is_class"] for r in out] == [1] * len(texts)
    assert not any(r["kept"] for r in out if r["base_failed"])


def _js(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * np.log2(a / c) for a, c in zip(x, m) if a > 0)
    return np.sqrt((kl(p) + kl(q)) / 2)


def test_distances_match_brute_force(spark):
    texts = [prose(400, seed=i, vocabulary=50) for i in (1, 1, 2, 2)] + ["ABC!! " * 100 + prose(200, seed=1, vocabulary=50)]
    docs = docs_df(spark, texts).withColumn("lang", F.when(F.col("doc_id") < 2, "en").otherwise(F.lit(None)))
    refs = Q.language_references(docs)
    assert len(refs) == 2
    counts = [Counter(w.lower() for i in own for w in texts[i].split()) for own in ((2, 3, 4), (0, 1))]
    for ref, c in zip(refs, counts):  # null counts as the language ''
        n = sum(c.values())
        common = {w: k / n for w, k in c.items() if k >= Q.COMMON_SHARE * n}
        assert set(ref.words) == set(common)
        assert all(abs(ref.shares[i] - common[w]) < 1e-12 for w, i in ref.words.items())
    by_class, by_word = Q.distances(pa.array(texts), refs)
    for i, t in enumerate(texts):
        want = []
        for ref in refs:
            c = Counter(w if w in ref.words else None for w in t.lower().split())
            n = sum(c.values())
            keys = sorted(ref.words, key=ref.words.get)
            want.append(_js([c[k] / n for k in keys] + [c[None] / n], ref.shares))
        assert abs(by_word[i] - min(want)) < 1e-9
    assert Q.js_distance(np.array([[1.0, 0.0]]), np.array([0.0, 1.0]))[0] == 1


def test_unlike_text_is_rejected_and_short_text_guarded(spark):
    good = [prose(300, seed=i, vocabulary=60) for i in range(40)]
    junk = " ".join(f"{w}###$$$%%%" for w in prose(300, seed=99, vocabulary=280).split())
    docs = docs_df(spark, good + [junk, "#### $$$$ %%%% a b c d e f g h"])
    kept = [r["kept"] for r in Q.judge(docs).orderBy("doc_id").collect()]
    assert kept == [not brute(t)[5] for t in good] + [False, True]


def test_empty_table(spark):
    assert Q.judge(docs_df(spark, [])).count() == 0
    assert Q.language_references(docs_df(spark, [None, ""])) == []


def test_shares_count_all_languages_however_many(spark):
    texts = [prose(2000, seed=1), "b " * 100] + ["a " * 20] * 500
    docs = docs_df(spark, texts).withColumn(
        "lang", F.when(F.col("doc_id") == 0, "main").when(F.col("doc_id") == 1, "rare").otherwise(F.concat(F.lit("x"), "doc_id")))
    assert len(Q.language_references(docs)) == 1  # 100 of 12,100 words are less than a hundredth


def test_rare_language_in_another_script_is_kept(spark):
    main = [prose(300, seed=i, vocabulary=60) for i in range(40)]
    other = str.maketrans("abcdefghijklmnop", "абвгдежзийклмноп")
    cyrillic = prose(100, seed=1, vocabulary=60).translate(other)  # 100 of some 12,000 words, under a hundredth
    latin = prose(100, seed=77, vocabulary=60)
    docs = docs_df(spark, main + [cyrillic, latin]).withColumn(
        "lang", F.when(F.col("doc_id") == 40, "ru").when(F.col("doc_id") == 41, "xx").otherwise("en"))
    out = Q.judge(docs).orderBy("doc_id").collect()
    assert all(r["class_distance"] is not None and r["word_distance"] is not None for r in out[:40])
    assert [r["kept"] for r in out[40:]] == [not brute(t)[5] for t in (cyrillic, latin)] == [True, True]


def test_language_with_few_long_words_has_class_reference(spark):
    # no spaces inside a sentence: few words, many characters
    chinese = [" ".join(chr(0x4E00 + (i * 31 + j) % 900) * 29 + chr(0x4E00 + j) for j in range(12)) for i in range(8)]
    main = [prose(300, seed=i, vocabulary=60) for i in range(40)]
    docs = docs_df(spark, main + chinese + ["#$%&" * 90 + " a b c d e f g h i j"]).withColumn(
        "lang", F.when(F.col("doc_id") < 40, "en").otherwise("zh"))
    refs = {r.lang: r for r in Q.language_references(docs)}
    assert set(refs) == {"en", "zh"} and len(refs["en"].shares) and not len(refs["zh"].shares)
    assert [r["kept"] for r in Q.judge(docs).orderBy("doc_id").collect()][40:] == [True] * 8 + [False]
