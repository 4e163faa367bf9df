"""Removal of repeated passages with suffix automata of reference shards.

A window is ``window`` consecutive words of one document. Words are removed that lie in a
window whose words also occur, as a window, in a document with a smaller id. Windows are judged on
the input, not on what is left.

1. Candidates. A window's minimizer is the least hash of its runs of ``SEED`` words, so equal
   windows have equal minimizers. Blocks of documents ask which of their minimizers occur in
   several documents, and in which first (``shared_keys``). Only windows with such a minimizer
   can repeat.
2. Reference shards. The shard of a document holds the passages of its windows whose minimizer it has
   first, as one suffix automaton over words. Passages of later documents go to the shards
   of the documents that had their minimizers first; each is streamed through the automaton, and where
   its matching statistic (the longest match that ends at a word) reaches ``window``, the window
   that ends there is removed.
3. The rest. A window that the shard does not hold may still repeat one of a third document, where
   the shard did not hold it either. These few windows are looked up by their hash (``shared_keys``
   once more), which is exact for what is left.

The reference is the corpus itself, so the automata can not be broadcast: their size
grows with the input. They are dealt out by document instead and meet only the passages that may match.
A document with very many copies has its automaton in several tasks: the number of blocks
that share a minimizer says into how many pieces its later occurrences are dealt.

Memory: an automaton is bounded by one document, a task's block by ``STEP_BYTES`` of text.
Every step can be recomputed in the same order, so a lost executor changes nothing.

Edge cases: null and empty texts have no words, and texts shorter than a window lose
none. Ids are integers; a row with a null id keeps all its words and removes none elsewhere. Rows that share an
id do not remove each other's words, as neither id is smaller. An empty table gives an empty result. Only id and
text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, covered, mix, n_partitions, raw, rolling, segment_sums, ship, steps, window_starts
from .shared_keys import NONE, REQUEST, answered, request

WINDOW = 13
SEED = 5
#: Blocks that share a minimizer for each piece that its occurrences are dealt into.
BLOCKS_PER_PIECE = 16
#: Windows of the rest that a task collects before it sends them.
REST = 200_000

_PASSAGES = "owner long, pieces int, piece int, later boolean, id long, th long, start int, words array<int>"
COLUMNS = "n_words long, n_removed long, kept_sha256 string"


class SuffixAutomaton:
    """Suffix automaton of several word sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in words:
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is not None:  # the longer string is split off
                new = self._clone(last, c, q)
                last = new
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
            last = cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link = self.next, self.link
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        self.length.append(self.length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def ends(self, words: list[int], least: int) -> list[int]:
        """Places where a match of at least ``least`` words ends."""
        nxt, link, length = self.next, self.link, self.length
        state = n = 0
        out = []
        for i, c in enumerate(words):
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(c)
            if to is not None:
                state = to
                n += 1
                if n >= least:
                    out.append(i)
        return out


def minimizers(hashes: np.ndarray, offsets: np.ndarray, window: int, seed: int = SEED):
    """Starts of all windows, the number of the minimizer of each, and place and hash of the minimizers."""
    starts = np.flatnonzero(window_starts(offsets, window))
    if not len(starts):
        return starts, starts, starts, np.zeros(0, np.uint64)
    seeds = rolling(hashes, seed)
    span = window - seed + 1
    view = np.lib.stride_tricks.sliding_window_view(seeds, span)
    at = np.empty(len(starts), np.int64)
    for lo in range(0, len(starts), 1 << 18):
        own = starts[lo: lo + (1 << 18)]
        at[lo: lo + (1 << 18)] = own + view[own].argmin(axis=1)
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    places = at[new]
    return starts, np.cumsum(new) - 1, places, seeds[places]


def _short_hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and 32 bits of it."""
    h = w.hashes()[w.ids] if len(w.ids) else np.zeros(0, np.uint64)
    return h, (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _candidates(docs: DataFrame, window: int, parts: int) -> DataFrame:
    """(id, th, owners, blocks): for each text with a shared minimizer the first document of each minimizer."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(steps(batches)):
            w = Words(b.column(1))
            _, _, places, keys = minimizers(_short_hashes(w)[0], w.offsets, window)
            ids = b.column(0).to_numpy()
            doc = w.doc[places]
            counts = np.bincount(doc, minlength=len(ids))
            yield request((part << 32) + n, parts, keys, ids[doc], [ids, b.column(2).to_numpy(), counts])

    def use(payload: list[np.ndarray], owners: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
        ids, th, counts, index = payload
        own, n = owners[index], blocks[index]
        ends = np.concatenate(([0], np.cumsum(counts)))
        shared = segment_sums((own != NONE).astype(np.int64), ends) > 0
        keep = np.repeat(shared, counts)
        ends = pa.array(np.concatenate(([0], np.cumsum(counts[shared]))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[shared]), pa.array(th[shared]), pa.ListArray.from_arrays(ends, pa.array(own[keep])),
             pa.ListArray.from_arrays(ends, pa.array(n[keep].astype(np.int32)))],
            ["id", "th", "owners", "blocks"],
        )

    asked = docs.where("id IS NOT NULL").mapInArrow(ask, REQUEST)
    return answered(asked, use, "id long, th long, owners array<long>, blocks array<int>")


def _passages(docs: DataFrame, window: int) -> DataFrame:
    """The passages that each candidate text sends to shards; ``docs``: id, text, th, and owners and
    blocks, which are null for other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            b = b.filter(b.column(3).is_valid())
            if not b.num_rows:
                continue
            ids, th = b.column(0).to_numpy(), b.column(2).to_numpy()
            w = Words(b.column(1))
            h, short = _short_hashes(w)
            starts, of, _, _ = minimizers(h, w.offsets, window)
            owner = b.column(3).flatten().to_numpy(zero_copy_only=False)[of]
            blocks = b.column(4).flatten().to_numpy(zero_copy_only=False)[of]
            pieces = 1 << np.ceil(np.log2(np.maximum(blocks / BLOCKS_PER_PIECE, 1))).astype(np.int64)
            some = owner != NONE
            starts, owner, pieces = starts[some], owner[some], pieces[some]
            if not len(starts):
                continue
            doc = w.doc[starts]
            new = np.ones(len(starts), bool)  # a run: windows one word apart with the same shard
            new[1:] = (np.diff(starts) != 1) | (np.diff(doc) != 0) | (np.diff(owner) != 0) | (np.diff(pieces) != 0)
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(starts))) + window - 1
            doc, owner, pieces, start = doc[first], owner[first], pieces[first], starts[first]
            later = ids[doc] != owner
            piece = (mix((ids[doc] ^ th[doc]).view(np.uint64)) % pieces.astype(np.uint64)).astype(np.int64)
            # a passage of the first document goes to every piece of its shard
            copies = np.where(later, 1, pieces)
            row = np.repeat(np.arange(len(first)), copies)
            inner = np.arange(len(row)) - np.repeat(np.cumsum(copies) - copies, copies)
            size = n[row]
            word = np.repeat(start[row] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            ends = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner[row]), pa.array(pieces[row].astype(np.int32)),
                 pa.array(np.where(later[row], piece[row], inner).astype(np.int32)), pa.array(later[row]),
                 pa.array(ids[doc[row]]), pa.array(th[doc[row]]),
                 pa.array((start[row] - w.offsets[doc[row]]).astype(np.int32)),
                 pa.ListArray.from_arrays(ends, pa.array(short[word]))],
                ["owner", "pieces", "piece", "later", "id", "th", "start", "words"],
            )

    return docs.mapInArrow(run, _PASSAGES)


def _removed(passages: DataFrame, window: int, parts: int) -> DataFrame:
    """(id, th, starts): windows to remove, by shard and then among the rest."""
    shards = passages.repartition(n_partitions(passages.sparkSession), "owner", "pieces", "piece").sortWithinPartitions(
        "owner", "pieces", "piece", "later", "id", "th", "start"
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        shard, automaton = None, None
        ids, ths, hits, rest, keys, docs = [], [], [], [], [], []
        pending = 0

        def send() -> pa.RecordBatch:
            nonlocal n, pending
            n += 1
            flat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            out = request(
                (part << 32) + n, parts, flat(keys).astype(np.uint64), flat(docs),
                [np.array(ids), np.array(ths), np.array([len(x) for x in hits]), flat(hits), np.array([len(x) for x in rest]), flat(rest)],
            )
            for x in (ids, ths, hits, rest, keys, docs):
                x.clear()
            pending = 0
            return out

        for b in steps(batches):
            cols = [b.column(i).to_pylist() for i in range(7)]
            words = b.column(7)
            for i, (owner, pieces, piece, later, id_, th, start) in enumerate(zip(*cols)):
                if (owner, pieces, piece) != shard:
                    shard, automaton = (owner, pieces, piece), SuffixAutomaton()
                own = words[i].values.to_numpy()
                if not later:
                    automaton.add(own.tolist())
                    continue
                found = np.array(automaton.ends(own.tolist(), window), np.int64) - (window - 1)
                left = np.ones(len(own) - window + 1, bool)
                left[found] = False
                left = np.flatnonzero(left)
                ids.append(id_), ths.append(th), hits.append(found + start), rest.append(left + start)
                if len(left):
                    keys.append(rolling(mix(own.view(np.uint32).astype(np.uint64) + np.uint64(1)), window)[left])
                    docs.append(np.full(len(left), id_, np.int64))
                pending += len(found) + len(left)
                if pending >= REST:
                    yield send()
        if ids:
            yield send()

    def use(payload: list[np.ndarray], owners: np.ndarray, blocks: np.ndarray) -> pa.RecordBatch:
        ids, ths, n_hits, hits, n_rest, rest, index = payload
        doc = np.repeat(np.arange(len(ids)), n_rest)
        first = owners[index]
        again = (first != NONE) & (first < ids[doc])
        every = np.concatenate((hits, rest[again]))
        of = np.concatenate((np.repeat(np.arange(len(ids)), n_hits), doc[again]))
        order = np.lexsort((every, of))
        counts = np.bincount(of, minlength=len(ids))
        ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(ths), pa.ListArray.from_arrays(ends, pa.array(every[order].astype(np.int32)))],
            ["id", "th", "starts"],
        )

    return answered(shards.mapInArrow(stream, REQUEST), use, "id long, th long, starts array<int>")


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW,
                kept_text: str | None = None) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (of the kept words joined by a space) for each row, and the
    kept words themselves in a column named by ``kept_text``."""
    ship(docs.sparkSession)
    parts = 2 * n_partitions(docs.sparkSession)
    own = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("th"))
    candidates = _candidates(own, window, parts).groupBy("id", "th").agg(
        F.first("owners").alias("owners"), F.first("blocks").alias("blocks")
    )
    # a left join, like the last one: both read the same shuffle of the texts
    passages = _passages(own.join(candidates, ["id", "th"], "left").select("id", "text", "th", "owners", "blocks"), window)
    removed = (
        _removed(passages, window, parts).groupBy("id", "th")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            texts, starts = raw(b.column(1)), b.column(2)
            n_words, n_removed, digests, kept = [], [], [], []
            for i, t in enumerate(texts):
                words = t.split()
                n_words.append(len(words))
                gone = 0
                if starts[i].is_valid and len(starts[i]):
                    hit = covered(np.unique(starts[i].values.to_numpy()), window, len(words))
                    gone = int(hit.sum())
                    words = compress(words, (~hit).tolist())
                t = b" ".join(words)
                n_removed.append(gone)
                digests.append(hashlib.sha256(t).hexdigest())
                if kept_text:
                    kept.append(t.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
                + ([pa.array(kept, pa.string())] if kept_text else []),
                ["id", "n_words", "n_removed", "kept_sha256"] + ([kept_text] if kept_text else []),
            )

    joined = own.join(removed, ["id", "th"], "left").select("id", "text", "starts")
    out = joined.mapInArrow(finish, f"id long, {COLUMNS}" + (f", `{kept_text}` string" if kept_text else ""))
    return out.withColumnRenamed("id", id)
