import random
import re

import numpy as np
import pyarrow as pa
from llm_inputs import docs_df, odd_texts, prose
from pyspark.sql import functions as F
from tidemark.llm import near_duplicates as N

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(t, k):
    w = WORD.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(ids, texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(ids)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [(len(s), least[find(i)], ids[i] == least[find(i)]) for i, s in enumerate(sets)]


def got(df):
    return [(r["n_shingles"], r["component_id"], r["kept"]) for r in df.orderBy("doc_id").collect()]


def near_copies(n, seed):
    r = random.Random(seed)
    out = []
    for g in range(6):
        base = prose(r.choice([3, 12, 60, 150]), seed=seed + g).split()
        for _ in range(n):
            w = list(base)
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = f"x{r.randint(0, 9)}"
            out.append(" ".join(w).upper() if r.random() < 0.2 else "  ".join(w))
    r.shuffle(out)
    return out


def test_matches_brute_force(spark):
    texts = near_copies(10, 3) + ["same words"] * 5 + ["Same Words", "one", "one", "two"]
    for k, percent in ((2, 80), (5, 80), (2, 50)):
        assert got(N.groups(docs_df(spark, texts), shingle=k, percent=percent)) == brute(range(len(texts)), texts, k, percent)


def test_pairs_beyond_the_stars(spark, monkeypatch):
    monkeypatch.setattr(N, "STAR_ROUNDS", 1)
    texts = near_copies(12, 30)
    assert got(N.groups(docs_df(spark, texts), shingle=2)) == brute(range(len(texts)), texts, 2, 80)


def test_sketch_fills_every_bin_and_estimates_similarity():
    texts = [prose(n, seed=n) for n in (1, 2, 5, 40, 400)]
    values, offsets = N.shingle_sets(pa.array(texts), 2)
    s = N.sketches(values, offsets)
    assert s.shape == (5, N.BINS) and (s != np.iinfo(np.uint64).max).all()
    assert (s == np.concatenate([N.sketches(values[a:b], np.array([0, b - a])) for a, b in zip(offsets[:-1], offsets[1:])])).all()
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate((a[:800], r.integers(0, 2**63, 200).astype(np.uint64)))  # similarity 2/3
    two = N.sketches(np.concatenate((np.sort(a), np.sort(b))), np.array([0, 1000, 2000]), 1024)
    assert abs((two[0] == two[1]).mean() - 2 / 3) < 0.06


def test_long_sketches_keep_the_bins_of_earlier_rounds():
    r = np.random.default_rng(4)
    sets = [np.sort(r.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 9, 40)]
    own = N.sketches(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]), N.REST_BINS)
    for got, values in zip(own, sets):
        want = [None] * N.REST_BINS
        for i in range(2 * N.REST_BINS):
            if None not in want:
                break
            now = {}
            for h in N.mix(values + np.uint64((i + 1) * int(N._ODD) % (1 << 64))).tolist():
                at = h >> 52 if i < N.REST_BINS else i - N.REST_BINS
                now[at] = min(now.get(at, 1 << 55), h % (1 << 55))
            for at, v in now.items():
                want[at] = v if want[at] is None else want[at]
        assert got.tolist() == want


def test_rest_finds_pairs_of_short_texts(spark, monkeypatch):
    # without stars, each pair has only the long sketches; sets of 9 to 72 at similarity 0.8 exactly, or just below
    monkeypatch.setattr(N, "STAR_ROUNDS", 0)
    r, texts = random.Random(9), []
    for g in range(150):
        j = 1 + g % 8
        words = [f"g{g}w{i}" for i in range(10 * j + 1)]
        texts += [" ".join(r.sample(x, len(x))) for x in (words[: 9 * j], words[:8 * j] + words[9 * j: 10 * j + (g % 5 == 0)])]
    assert got(N.groups(docs_df(spark, texts), shingle=1)) == brute(range(len(texts)), texts, 1, 80)


def test_large_component_is_not_copied(spark, monkeypatch):
    monkeypatch.setattr(N, "REST_BLOCK", 100)
    # bucket 1: 20,000 members, 3 outside its largest component; bucket 2: one component; bucket 3: all on their own
    rows = [(1, i, 5, 0 if i >= 3 else i + 1) for i in range(20_000)] + [(2, i, 5, 7) for i in range(500)] + [(3, i, 5, i) for i in range(250)]
    cells = N._rest_cells(spark.createDataFrame(rows, "h long, rep long, n long, comp long"))
    got = cells.groupBy("h").agg(F.count("*").alias("n")).collect()
    assert {r["h"]: r["n"] for r in got} == {1: 20_000 + 3 * 200, 3: 250 * 3 + 249 * 3}
    # every pair across components meets, the rest need not
    left, right = cells.where("left"), cells.where("not left")
    met = left.alias("x").join(right.alias("y"), ["h", "i", "j"]).where("x.comp <> y.comp").select(
        "h", F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct().groupBy("h").count().collect()
    assert {r["h"]: r["count"] for r in met} == {1: 3 * 19_997 + 3, 3: 250 * 249 // 2}


def test_rest_over_many_small_cells(spark, monkeypatch):
    monkeypatch.setattr(N, "STAR_ROUNDS", 1)
    monkeypatch.setattr(N, "REST_BLOCK", 4)
    texts = near_copies(25, 30) + [prose(60, seed=77)] * 30 + [prose(60, seed=77) + " more"]
    assert got(N.groups(docs_df(spark, texts), shingle=2)) == brute(range(len(texts)), texts, 2, 80)


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    out = N.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, out)) == [(i, 0) for i in range(1, 41)] + [(101, 100)]


def test_odd_rows(spark):
    texts = odd_texts()
    docs = docs_df(spark, texts).withColumn("rep", F.lit(1)).withColumn("bands", F.lit("x")).withColumn("kept", F.lit(False))
    assert got(N.groups(docs, shingle=2)) == brute(range(len(texts)), texts, 2, 80)


def test_null_and_repeated_ids_and_empty_table(spark):
    p = prose(30, seed=2)
    out = N.groups(docs_df(spark, [p, p, p, p, None], [None, 4, 4, 2, 9])).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in out] == [
        (None, None, True), (2, 2, True), (4, 2, False), (4, 2, False), (9, 9, True)]
    assert N.groups(docs_df(spark, [])).count() == 0
    assert got(N.groups(docs_df(spark, [None, ""]))) == [(0, 0, True), (0, 1, True)]
