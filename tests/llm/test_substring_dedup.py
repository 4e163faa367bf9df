import hashlib
import random
import re

from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import substring_dedup as S

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(ids, texts, window):
    first = {}
    words = [WORD.findall(t or "") for t in texts]
    for i, w in zip(ids, words):
        for s in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[s: s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in zip(ids, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if i is not None and first[tuple(w[s: s + window])] < i:
                gone |= set(range(s, s + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def got(df):
    return [(r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.orderBy("doc_id", "n_words", "n_removed").collect()]


def check(spark, texts, window=13, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    assert got(S.deduplicate(docs_df(spark, texts, ids), window=window)) == brute(ids, texts, window)


def test_automaton_matches_search():
    r = random.Random(2)
    for _ in range(50):
        own = [[r.randint(0, 3) for _ in range(r.randint(0, 30))] for _ in range(3)]
        query = [r.randint(0, 3) for _ in range(40)]
        a = S.SuffixAutomaton()
        for x in own:
            a.add(x)
        want = [
            i for i in range(3, len(query))
            if any(query[i - 3: i + 1] == x[j: j + 4] for x in own for j in range(len(x) - 3))
        ]
        assert a.ends(query, 4) == want


def test_copies_edits_and_third_documents(spark):
    r = random.Random(5)
    base = [prose(120, seed=i).split() for i in range(4)]
    texts = []
    for k in range(40):
        w = list(r.choice(base))
        for _ in range(r.randint(0, 4)):  # edits, some of them shared by later copies
            w[r.randrange(len(w))] = f"edit{r.randint(0, 5)}"
        cut = r.randint(0, 30)
        texts.append(" ".join(w[cut:] + r.choice(base)[:25]))
    check(spark, texts)
    check(spark, texts, window=7)


def test_hot_passage_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCKS_PER_PIECE", 1)
    passage = prose(30, seed=8)
    texts = [f"{prose(20, seed=100 + i)} {passage} {prose(10, seed=300 + i)}" for i in range(60)]
    docs = docs_df(spark, texts).repartition(6)
    assert got(S.deduplicate(docs)) == brute(range(60), texts, 13)


def test_odd_rows(spark):
    texts = odd_texts()
    docs = docs_df(spark, texts).withColumn("th", F.lit("x")).withColumn("owners", F.lit(1)).withColumn("id", F.lit(None))
    assert got(S.deduplicate(docs)) == brute(range(len(texts)), texts, 13)


def test_repeated_ids_null_ids_and_empty_table(spark):
    p = prose(50, seed=1)
    check(spark, [p, p], ids=[7, 7])  # neither id is smaller
    out = S.deduplicate(docs_df(spark, [p, p, p], [None, 1, 2])).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in out] == [0, 0, 50]
    assert S.deduplicate(docs_df(spark, [])).count() == 0


def test_kept_text(spark):
    p = prose(20, seed=1)
    out = S.deduplicate(docs_df(spark, [p, "a b " + p + " c"]), kept_text="left").orderBy("doc_id").collect()
    assert [r["left"] for r in out] == [p, "a b c"]
