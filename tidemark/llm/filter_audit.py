"""Audit of how filters interact: what each removes in every order of applying them.

A document fails some of the filters. Its survival word has one bit for each subset of the
filters, set when the document passes all of that subset (32 bits for five filters). How many
documents of a part survive each subset is the positional popcount of their words, taken for all
documents, those of good quality and the toxic ones. Every figure follows from these counts: after a step of an order,
the survivors of the set of filters applied so far are left; removed is what the step takes from them; what a filter
fails on its own is told by the survivors of all others.

The popcount is carry-save: three words of one weight become a sum word of that weight and a carry word of
twice the weight, until each part has at most two words of a weight left, and only those are
split into bits. All parts of a batch are reduced at once, sorted by part.

Each document is a few numbers once its text is read: the failures that it shows by itself, a SHA-256 of the text
for the failure of being a copy, its part and labels. Copies: the smallest id per text (a partial aggregate, so a text in
a third of all rows is one row per task) is joined back on text and id, which no two texts and few rows share, and
what finds no partner is a copy. The labels are reduced to one row per id before their join. Both joins are plain shuffled ones. Tasks hand on one row of counts per part, label and Arrow batch, summed with a partial
aggregate; the orders are unrolled per part at the end (120 orders of five steps).

Edge cases: a null text is empty; empty texts are copies of each other. A null id is no smaller id, and none is smaller
than it, so its row is no copy; it has no labels. Rows that repeat an id are all judged, and none of them is a copy of the
others by that alone. Several labels of one id count as good or toxic if any of them says so. A null part is the
empty string. Columns beyond those named are not read; none are carried, so names cannot clash. With no
documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: For each set of failed filters (bit i: filter i), the word with a bit for every subset that it survives.
SURVIVAL = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], np.uint32)
LABELS = ("all", "good", "toxic")


def failures(text: Column) -> list[Column]:
    """Whether a text fails the filters A to D."""
    words = F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [
        n < 50,
        100 * distinct < 65 * n,
        100 * capitals > 5 * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]


def facts(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per document: part, failed (int, bit i: filter i), good, toxic (boolean)."""
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body, 256)).alias("digest"),
        sum((F.when(x, 1 << i).otherwise(0) for i, x in enumerate(failures(body))), F.lit(0)).alias("failed"),
    )
    # a text's smallest id is joined on the text and the id, so however many copies there are, no join key is hot
    first = own.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    labelled = (
        labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
        .where("good OR toxic").withColumn("spread", F.lit(0).cast("long"))
    )
    # null ids match nothing and are spread over the tasks by their text
    spread = own.withColumn("spread", F.when(F.col("id").isNull(), F.xxhash64("digest")).otherwise(0))
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
    return (
        spread.join(first, ["digest", "id"], "left").join(labelled, ["id", "spread"], "left")
        .select("part", (F.col("failed") + copy).cast("int").alias("failed"),
                F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    )


def positional_popcounts(words: np.ndarray, group: np.ndarray, n_groups: int) -> np.ndarray:
    """How often each of the 32 bits is set in the words of each group; ``group`` ascends."""
    counts = np.zeros((n_groups, 32), np.int64)
    weight = 1
    while len(words):
        carried_words, carried_groups = [], []
        while True:
            size = np.bincount(group, minlength=n_groups)
            triples = size // 3
            if not triples.any():
                break
            start = np.cumsum(size) - size
            at = np.repeat(start, triples) + 3 * (np.arange(triples.sum()) - np.repeat(np.cumsum(triples) - triples, triples))
            a, b, c = words[at], words[at + 1], words[at + 2]
            either = a ^ b
            own = np.repeat(np.arange(n_groups), triples)
            carried_words.append(a & b | c & either)
            carried_groups.append(own)
            rest = np.ones(len(words), bool)
            rest[at] = rest[at + 1] = rest[at + 2] = False
            words = np.concatenate((either ^ c, words[rest]))
            group = np.concatenate((own, group[rest]))
            order = np.argsort(group, kind="stable")
            words, group = words[order], group[order]
        bits = words[:, None] >> np.arange(32, dtype=np.uint32) & np.uint32(1)
        np.add.at(counts, group, bits.astype(np.int64) * weight)
        words = np.concatenate(carried_words) if carried_words else np.zeros(0, np.uint32)
        group = np.concatenate(carried_groups) if carried_groups else np.zeros(0, np.int64)
        order = np.argsort(group, kind="stable")
        words, group = words[order], group[order]
        weight *= 2
    return counts


def survivors(documents: DataFrame) -> DataFrame:
    """From ``facts``: for each part and label (``LABELS``), ``s0`` to ``s31``: the documents that survive each subset."""
    ship(documents.sparkSession)
    names = [f"s{i}" for i in range(SUBSETS)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            coded = b.column(0).dictionary_encode()
            part = coded.indices.to_numpy(zero_copy_only=False)
            words = SURVIVAL[b.column(1).to_numpy(zero_copy_only=False)]
            order = np.argsort(part, kind="stable")
            for k, label in enumerate(LABELS):
                chosen = order if not k else order[b.column(1 + k).to_numpy(zero_copy_only=False)[order]]
                found = positional_popcounts(words[chosen], part[chosen], len(coded.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [coded.dictionary, pa.array([label] * len(found), pa.string()), *map(pa.array, found.T)],
                    ["part", "label", *names])

    ddl = "part string, label string, " + ", ".join(f"{n} long" for n in names)
    counted = documents.select("part", "failed", "good", "toxic").mapInArrow(count, ddl)
    return counted.groupBy("part", "label").agg(*(F.sum(n).alias(n) for n in names))


def audit(counts: DataFrame) -> DataFrame:
    """From ``survivors``: one row per part, order of the filters and step."""
    n = len(FILTERS)
    orders = list(permutations(range(n)))
    name = ["".join(FILTERS[i] for i in o) for o in orders for _ in o]
    step = np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))
    filt = np.array([i for o in orders for i in o])
    prior = np.array([sum(1 << i for i in o[:k]) for o in orders for k in range(n)])
    after = prior | 1 << filt
    rest = SUBSETS - 1 - (1 << filt)

    def unrolled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, part in enumerate(b.column(0).to_pylist()):
                s, good, toxic = (np.array(b.column(1 + k)[i].as_py(), np.int64) for k in range(3))
                removed = s[prior] - s[after]
                shapley = np.bincount(filt, removed, n).astype(np.int64)
                columns = {
                    "part": pa.array([part] * len(name), pa.string()), "filter_order": name, "step": step,
                    "kept": s[after], "removed": removed, "redundant": s[0] - s[1 << filt] - removed,
                    "unique_fails": s[rest] - s[SUBSETS - 1], "good_lost": good[prior] - good[after],
                    "toxic_lost": toxic[prior] - toxic[after], "shapley": shapley[filt],
                }
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))

    ship(counts.sparkSession)
    vector = F.array(*(F.col(f"s{i}") for i in range(SUBSETS)))
    by_part = counts.groupBy("part").agg(
        *(F.max(F.when(F.col("label") == k, vector)).alias(k) for k in LABELS))
    return by_part.mapInArrow(
        unrolled, "part string, filter_order string, step int, kept long, removed long, redundant long, "
                  "unique_fails long, good_lost long, toxic_lost long, shapley long")
