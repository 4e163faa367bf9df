import random
import re
from itertools import permutations

import numpy as np
from llm_inputs import DOCS, prose
from pyspark.sql import functions as F
from tidemark.llm import filter_audit as A

LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied to every document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _, _, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out, shapley = {}, {}
    for order in map("".join, permutations("ABCDE")):
        for i, text, _, source, _ in docs:
            t, part = text or "", source or ""
            w = re.findall("[^\x20\x09-\x0d]+", t)
            bad = {k for k, x in zip("ABCDE", (
                len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                re.search("[#$%&*|]", t), i is not None and i > first[t])) if x}
            here = True
            for step, f in enumerate(order, 1):
                n = out.setdefault((part, order, step), [0] * 6)
                if f in bad:
                    n[1] += here
                    n[2] += not here
                    n[3] += bad == {f}
                    n[4] += here and i in good
                    n[5] += here and i in toxic
                    shapley[part, f] = shapley.get((part, f), 0) + here
                    here = False
                n[0] += here
    return {k: (*n, shapley.get((k[0], k[1][k[2] - 1]), 0)) for k, n in out.items()}


def test_positional_popcounts():
    r = np.random.default_rng(0)
    for n, g in ((0, 3), (1, 1), (2, 2), (1000, 7), (5000, 300), (4096, 1)):
        words, group = r.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32), np.sort(r.integers(0, g, n))
        want = np.zeros((g, 32), int)
        for w, k in zip(words, group):
            want[k] += (int(w) >> np.arange(32)) & 1
        assert (A.positional_popcounts(words, group, g) == want).all()


def test_against_brute_force(spark):
    r, docs = random.Random(1), []
    texts = [None, "", " \n", "Word", "A B # c", prose(60, 1), prose(60, 2, 5000), prose(60, 3, 5000) + " | x", prose(3000, 4), prose(55, 5).upper(),
             "é  " + prose(70, 6, 5000)]
    for i in range(150):
        docs.append((r.choice([i, i, None, 5, 7]), r.choice(texts), "en", r.choice(["a", "b", "", None]), 0))
    labels = [(r.choice([i, None]), r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(100)] + [(5, 0, 1), (5, 1, 0), (900, 1, 1)]
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    for c in ("part", "failed", "good", "id", "digest"):
        df = df.withColumn(c, F.lit("x"))
    rows = A.audit(A.survivors(A.facts(df, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("y"))))).collect()
    got = {(x["part"], x["filter_order"], x["step"]): tuple(x)[3:] for x in rows}
    assert len(got) == len(rows) and got == brute(docs, labels)


def test_very_long_text_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "Ab " * 2_000_000, "en", "s", 0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    row = A.facts(docs, none).first()
    assert (row["failed"], row["good"], row["toxic"]) == (0b00110, False, False)
    assert A.audit(A.survivors(A.facts(docs.limit(0), none))).count() == 0
