"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` tokenizes the training texts and stores, for every block of documents
(about ``STEP_BYTES`` of text), the postings of every term: the sorted positions at which
it occurs. The index is partitioned by documents, so whatever is looked up is answered
inside a block, and no term, however common, is gathered in one place. A task holds one block while it
builds, and one Arrow batch of them while it looks up, whatever its scan split.

``search`` looks up windows of ``window`` consecutive words of the test items (an item
with fewer words is one window). In each block, a window's lists are intersected from the
rarest term on: the rarest term's postings, moved back by the term's place in the
window, are the candidate starts; each further list, in order of length, keeps the candidates at whose
place (exact phrases) or within ``slop`` words of it (proximity) the term occurs. All
windows of a block advance together as sorted arrays. Each window is filed under its anchor, the term that
the fewest windows hold; a block takes up the windows of the anchors that it has, so its work
follows the terms that occur in it and not the number of windows.

Test items are read in parts of at most ``PART_WORDS`` windows; a longer item goes on in the next part. Each part is sent to the
executors (so its size is bounded) and takes one pass over the index; parts are
combined by document. Usual benchmarks are one part, and then nothing is shuffled.

Edge cases: null and empty texts have no words and no matches. Items without words match
nothing; an item with a null id marks words but is not listed. Items with the same id count
as one. Documents are told apart by their place in the index, so repeated rows are
each reported. Without items every document has no match; without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import STEP_BYTES, Words, arrow_batches, covered, ship, steps, stored, translated

WINDOW = 13
PART_WORDS = 2_000_000
#: Words left free between the documents of a block, more than any slop.
GAP = 64
#: Candidate starts that are held at once.
CANDIDATES = 2_000_000
#: Windows whose terms are held at once.
WINDOWS = 200_000

#: Every block is a row group of its own. Else the writer would keep a hundred of these long rows before it looks at
#: their size, and the reader load them together: a task would hold as many blocks as its scan split has.
ROW_GROUPS = {"parquet.block.row.count.limit": "1"}

#: A-Z to lower case; ASCII other than letters and digits to a space.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
MATCHES = "n_words long, n_hit long, items array<string>, matches array<struct<item:string,item_start:int,start:int,length:int,distance:int>>"


def build_index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index, stored in the shared folder: one row per block."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(steps(batches)):
            w = Words(translated(b.column(1), _WORD_BYTES))
            place = np.arange(len(w.ids), dtype=np.int32)
            place += np.repeat(np.arange(len(w.lengths), dtype=np.int32) * GAP, w.lengths)
            place = place[np.argsort(w.ids, kind="stable")]
            ends = np.cumsum(np.bincount(w.ids, minlength=len(w.words)))
            w.ids = w.doc = None  # let go before the lists are made
            gaps = np.diff(place, prepend=np.int32(0))
            first = np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ends)]
            gaps[first] = place[first]  # each list starts anew
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + n]), _one(b.column(0)), _one(pa.array(w.lengths.astype(np.int32))),
                 _one(w.words), _one(pa.array(ends.astype(np.int32))), _one(pa.array(gaps))],
                ["block", "ids", "lengths", "terms", "ends", "gaps"],
            )

    kind = docs.schema[id].dataType.simpleString()
    with arrow_batches(docs.sparkSession, STEP_BYTES * 15 // 16):  # one step each: the last row goes beyond the size
        return stored(docs.select(id, text).mapInArrow(
            run, f"block long, ids array<{kind}>, lengths array<int>, terms array<string>, ends array<int>, gaps array<int>"
        ), "postings", **ROW_GROUPS)


def _one(values: pa.Array) -> pa.Array:
    """All values as the list of a single row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Windows:
    """Windows of one length, ordered by their anchor: the term that the fewest windows of the part hold.

    A window can only occur where its anchor does, so a block looks at the windows of those anchors it has.
    """

    def __init__(self, size: int, pieces: list[tuple[int, int, np.ndarray]], n_terms: int):
        """``pieces``: item number, place of the first window in the item, words."""
        self.size = size
        self.words = np.concatenate([w for _, _, w in pieces])
        lengths = np.array([len(w) for _, _, w in pieces])
        n = lengths - size + 1
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(np.cumsum(lengths) - lengths, n) + inner
        held = np.zeros(n_terms, np.int64)
        for k in range(size):
            held += np.bincount(self.words[place + k], minlength=n_terms)
        anchor, least = self.words[place].copy(), held[self.words[place]]
        for k in range(1, size):
            term = self.words[place + k]
            less = held[term] < least
            anchor[less], least[less] = term[less], held[term[less]]
        order = np.argsort(anchor, kind="stable")
        self.place = place[order]
        self.items = np.repeat(np.array([i for i, _, _ in pieces]), n)[order]
        self.starts = (np.repeat(np.array([s for _, s, _ in pieces]), n) + inner)[order]
        self.first = np.searchsorted(anchor[order], np.arange(n_terms + 1))

    def anchored(self, terms: np.ndarray) -> np.ndarray:
        """The windows whose anchor is among the terms."""
        lo, n = self.first[terms], self.first[terms + 1] - self.first[terms]
        return np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())

    def terms(self, windows: np.ndarray) -> np.ndarray:
        return self.words[self.place[windows][:, None] + np.arange(self.size)]


class Phrases:
    """A part of the test items: their words as term numbers, and their windows by length."""

    def __init__(self, window: int):
        self.window = window
        self.terms: dict[str, int] = {}
        self.items: list[str | None] = []
        self.pieces: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        self.n_words = 0

    def add(self, item: str | None, words: list[str], start: int, n: int) -> None:
        """Take the ``n`` windows of an item from word ``start`` on."""
        size = min(self.window, len(words))
        ids = np.array([self.terms.setdefault(x, len(self.terms)) for x in words[start: start + n + size - 1]], np.int32)
        self.pieces.setdefault(size, []).append((len(self.items), start, ids))
        self.items.append(item)
        self.n_words += n

    def close(self) -> Phrases:
        self.tables = [Windows(size, pieces, len(self.terms)) for size, pieces in self.pieces.items()]
        self.pieces = {}
        return self


def read_phrases(items: DataFrame, id: str, text: str, window: int, part_words: int = PART_WORDS) -> Iterator[Phrases]:
    """The items in parts of at most ``part_words`` windows; the driver holds one part and one item at a time.

    An item with more windows than a part has left goes on in the next part.
    """
    part = Phrases(window)
    rows = items.select(F.col(id).cast("string").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    for r in rows.toLocalIterator():
        w = Words(translated(pa.array([r["text"]]), _WORD_BYTES))
        names = w.words.to_pylist()
        words = [names[i] for i in w.ids.tolist()]
        left, start = (max(len(words) - window, 0) + 1 if words else 0), 0
        while left:
            n = min(left, part_words - part.n_words)
            part.add(r["id"], words, start, n)
            left, start = left - n, start + n
            if part.n_words >= part_words:
                yield part.close()
                part = Phrases(window)
    yield part.close()


class Block:
    """The postings of a block for the terms of some phrases, numbered by their order in ``present``."""

    def __init__(self, terms: pa.Array, ends: np.ndarray, gaps: np.ndarray, wanted: dict[str, int], size: int):
        number = np.array([wanted.get(t, -1) for t in terms.to_pylist()], np.int64)
        rows = np.flatnonzero(number >= 0)
        rows = rows[np.argsort(number[rows])]
        self.present = number[rows]
        starts = np.concatenate(([0], ends[:-1]))[: len(ends)]
        n = ends[rows] - starts[rows]
        self.size = size
        self.counts = n
        self.first = np.concatenate(([0], np.cumsum(n)))
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        picked = np.repeat(starts[rows], n) + inner
        total = np.cumsum(gaps[picked])  # lists begin with their first position: restart the sums there
        before = self.first[:-1]
        base = total[before] - gaps[picked][before] if len(total) else np.zeros(0, np.int64)
        self.places = total - np.repeat(base, n)
        self.keys = np.repeat(np.arange(len(rows)), n) * size + self.places

    def find(self, table: Windows, slop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, start, distance) of each match, lists taken from the rarest on."""
        found = []
        anchored = table.anchored(self.present)
        for k in range(0, len(anchored), WINDOWS):
            some = anchored[k: k + WINDOWS]
            terms = table.terms(some)
            local = np.searchsorted(self.present, terms)
            local[local == len(self.present)] = 0
            whole = (self.present[local] == terms).all(axis=1)
            found += [(some[whole][at], start, distance) for at, start, distance in self._intersect(local[whole], slop)]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found))

    def _intersect(self, windows: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row, start, distance) of the matches of windows whose terms all occur in the block."""
        order = np.argsort(self.counts[windows], axis=1, kind="stable")
        rarest = windows[np.arange(len(windows)), order[:, 0]]
        n = self.counts[rarest]
        cuts = np.searchsorted(np.cumsum(n), np.arange(CANDIDATES, n.sum() + CANDIDATES, CANDIDATES), side="left") + 1
        for lo, hi in zip(np.concatenate(([0], cuts[:-1])), cuts):
            m = n[lo:hi]
            at = np.repeat(np.arange(lo, min(hi, len(n))), m)
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            start = self.places[self.first[rarest[at]] + inner] - order[at, 0]
            distance = np.zeros(len(at), np.int64)
            for k in range(1, windows.shape[1]):
                ok, d = self._near(windows[at, order[at, k]], start + order[at, k], slop)
                at, start, distance = at[ok], start[ok], distance[ok] + d[ok]
            yield at, start, distance

    def _near(self, term: np.ndarray, place: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Does the term occur within ``slop`` of the place, and how far off is the nearest?"""
        key = term * self.size + place
        at = np.searchsorted(self.keys, key)
        best = np.full(len(key), slop + 1, np.int64)
        for j in (at, at - 1) if slop else (at,):
            inside = (j >= self.first[term]) & (j < self.first[term + 1])
            off = np.abs(self.keys[np.clip(j, 0, max(len(self.keys) - 1, 0))] - key) if len(self.keys) else best
            best = np.where(inside, np.minimum(best, off), best)
        return best <= slop, best


def _matches(b: pa.RecordBatch, row: int, phrases: Phrases, slop: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of the block's documents, and columns document, item, item start, start, length, distance."""
    lengths = b.column("lengths")[row].values.to_numpy().astype(np.int64)
    first = np.cumsum(lengths) - lengths + np.arange(len(lengths)) * GAP
    size = int(lengths.sum()) + (len(lengths) + 1) * GAP
    block = Block(
        b.column("terms")[row].values, b.column("ends")[row].values.to_numpy().astype(np.int64),
        b.column("gaps")[row].values.to_numpy().astype(np.int64), phrases.terms, size,
    )
    cols = []
    for table in phrases.tables:
        length = table.size
        w, place, distance = block.find(table, slop)
        doc = np.searchsorted(first, place, side="right") - 1
        start = place - first[doc] if len(doc) else place
        ok = (doc >= 0) & (start + length <= lengths[doc] if len(doc) else True)
        w, doc, start, distance = w[ok], doc[ok], start[ok], distance[ok]
        cols.append([doc, table.items[w], table.starts[w], start, np.full(len(w), length), distance])
    return lengths, [np.concatenate(c) for c in zip(*cols)] if cols else [np.zeros(0, np.int64)] * 6


def _one_pass(index: DataFrame, phrases: Broadcast, slop: int, kind: str, all_docs: bool) -> DataFrame:
    schema = f"block long, n int, id {kind}, {MATCHES}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                p = phrases.value
                lengths, (doc, item, item_start, start, length, distance) = _matches(b, row, p, slop)
                order = np.lexsort((item_start, item, start, doc))
                doc, item, item_start, start, length, distance = (
                    x[order] for x in (doc, item, item_start, start, length, distance)
                )
                rows = np.arange(len(lengths)) if all_docs else np.unique(doc)
                lo, hi = np.searchsorted(doc, rows), np.searchsorted(doc, rows, side="right")
                n_hit, items, matches = [], [], []
                for a, z, i in zip(lo.tolist(), hi.tolist(), rows.tolist()):
                    if a == z:
                        n_hit.append(0), items.append([]), matches.append([])
                        continue
                    hit = np.zeros(lengths[i], bool)
                    for size in np.unique(length[a:z]):
                        hit |= covered(start[a:z][length[a:z] == size], int(size), int(lengths[i]))
                    n_hit.append(int(hit.sum()))
                    names = [p.items[j] for j in item[a:z].tolist()]
                    items.append(sorted({x for x in names if x is not None}))
                    matches.append([
                        dict(zip(("item", "item_start", "start", "length", "distance"), v))
                        for v in zip(names, *(x[a:z].tolist() for x in (item_start, start, length, distance)))
                    ])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), b.column("block")[row].as_py(), np.int64)), pa.array(rows.astype(np.int32)),
                     b.column("ids")[row].values.take(pa.array(rows)), pa.array(lengths[rows]), pa.array(n_hit, pa.int64()),
                     pa.array(items, pa.list_(pa.string())),
                     pa.array(matches, pa.list_(pa.struct([("item", pa.string())] + [
                         (x, pa.int32()) for x in ("item_start", "start", "length", "distance")])))],
                    ["block", "n", "id", "n_words", "n_hit", "items", "matches"],
                )

    return index.mapInArrow(run, T._parse_datatype_string(schema))


def search(index: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", window: int = WINDOW,
           slop: int = 0, part_words: int = PART_WORDS) -> DataFrame:
    """One row per indexed document: block, n (its place in the block), id, n_words, n_hit (words in a
    match), items (sorted ids of matching items) and matches (every one, with its place).

    ``slop`` 0 gives exact phrases; above, each term may stand up to ``slop`` words from its place.
    """
    if slop > GAP - 1:
        raise ValueError(f"slop must be below {GAP}")
    sc = index.sparkSession.sparkContext
    kind = index.schema["ids"].dataType.elementType.simpleString()
    passes = []
    for part in read_phrases(items, id, text, window, part_words):
        passes.append(_one_pass(index, sc.broadcast(part), slop, kind, all_docs=not passes))
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("block", "n").agg(
        F.first("id").alias("id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("matches")).alias("matches"),
    )
    # words in any match: the lengths of the matches' union, taken in order of their start
    ends = F.aggregate(
        F.array_sort(F.transform("matches", lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["length"]).alias("e")))),
        F.struct(F.lit(0).alias("e"), F.lit(0).cast("long").alias("n")),
        lambda a, m: F.struct(
            F.greatest(a["e"], m["e"]).alias("e"),
            (a["n"] + F.greatest(F.lit(0), m["e"] - F.greatest(a["e"], m["s"]))).cast("long").alias("n"),
        ),
    )
    return merged.select("block", "n", "id", "n_words", ends["n"].alias("n_hit"), "items", "matches")


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit", share: int = 20):
    """At least one hit, and at least one word in ``share`` hit."""
    return (F.col(n_hit) > 0) & (share * F.col(n_hit) >= F.col(n_words))
