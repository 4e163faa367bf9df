"""Best-fit packing of tokenized documents into sequences by bin completion.

Texts are tokenized and cut into pieces of at most ``capacity`` tokens (only longer ones are cut).
How pieces combine depends on their lengths alone, so the search runs on the histogram of
lengths: at most ``capacity`` numbers, whatever the corpus.

Best-fit decreasing is the first incumbent; a second one takes for the longest length left the filling of the least waste
found, as often as the histogram allows. Where the incumbent needs more sequences than the total length does, bin completion
follows: around the longest piece, the fillings that no piece left out could better are enumerated, least waste first, each
is tried in turn, and a branch ends when its waste passes what one sequence fewer may waste, or when the same pieces have
failed before. Up to ``EXACT_PIECES`` pieces are searched as a whole, so their packing is the best there is. Of more,
groups of sequences that together waste one are completed anew with some others, one sequence fewer,
until the bound is met or ``MAX_STEPS`` are taken, which is logged.

The result of the search is a table of slots: for each (pattern, length) a run of ranks
and where these go. Pieces get their rank within their length from a count per
write task and length (prefix sums over tasks) plus their rank in the task, so no length,
however common, is gathered in one task. Each piece looks up its slot by binary search. The slot table is
bounded by the number of patterns (about ``capacity``) times their distinct lengths (under
sqrt(2 * capacity)), so it is sent with the tasks.

The tokenized pieces are stored once in the shared folder (ids only as a checksum), so
ranks stay the same if an executor is lost.

Edge cases: a null or empty text is the end token alone. Repeated rows are each packed. With no
documents the result is empty. Ids may be null; they are only carried.
"""

from __future__ import annotations

import logging
import random
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, ship, steps, stored

CAPACITY = 4096
END_ID = 1
#: Encoded parts of words kept by a Python worker.
MAX_KNOWN = 900_000
#: Words given to the tokenizer at once; runs of ids that are put together at once.
AT_ONCE, GATHERED = 10_000, 200_000
#: Nodes that the search for one filling of the second incumbent may visit.
MAX_NODES = 20_000
#: Pieces that are packed exactly; steps of the whole search, and of one group of at most so many sequences and distinct lengths.
EXACT_PIECES, MAX_STEPS, GROUP_STEPS, MAX_GROUP, MAX_LENGTHS = 40, 2_000_000, 20_000, 60, 400

_log = logging.getLogger(__name__)

_encoders: dict[str, Encoder] = {}


#: Letters whose lower case and normal form are one letter each, whatever stands beside them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-žА-Яа-яЁё"
_PARTS = f"^(?P<body>[{_LETTERS}]*)(?P<tail>[!-/:-@\\[-`{{-~]*)$"


def _texts(col: pa.StringArray) -> list[str]:
    return col.to_numpy(zero_copy_only=False).tolist()


def _gathered(pool: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` with these starts and lengths, one behind the other."""
    out, done = np.empty(int(counts.sum()), pool.dtype), 0
    for lo in range(0, len(starts), GATHERED):
        n = counts[lo: lo + GATHERED]
        ends = np.cumsum(n)
        total = int(ends[-1])
        out[done: done + total] = pool[np.repeat(starts[lo: lo + GATHERED] - (ends - n), n) + np.arange(total)]
        done += total
    return out


class Encoder:
    """Ids of white-space separated words.

    The tokenizer never joins across white space, so a text's ids are those of its words. A word of
    letters followed by ASCII punctuation is looked up as two parts, the letters in lower case, as the tokenizer parts and lowers them
    as well; this holds for the letters listed in ``_LETTERS``. Other words (digits, other letters, combining marks, which it joins with
    a stop) are left to it whole. Parts are told apart, split and put together again by the column; only distinct ones meet Python.
    """

    def __init__(self, source: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(source)
        #: for parts, which are single pre-tokens in normal form: the same model without what looks for those
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for k, i in vocabulary.items() if k.endswith("</w>")]] = True
        self.step = 0
        # the empty part is always known
        self._keep({"": 0}, np.zeros(1, np.int64), np.full(1, np.iinfo(np.int64).max), np.zeros(0, "<u4"))

    @classmethod
    def of(cls, path: str, source) -> Encoder:
        """The worker's encoder, kept for its later tasks; ``source``: the broadcast file of ``path``."""
        if path not in _encoders:
            _encoders[path] = cls(source.value)
        return _encoders[path]

    def _keep(self, known: dict[str, int], counts: np.ndarray, used: np.ndarray, pool: np.ndarray) -> None:
        """``known``: a part's place in ``counts`` and in ``used`` (its last step); ``pool``: the ids of all, by place."""
        self.known, self.counts, self.used, self.pool = known, counts, used, pool
        self.starts = np.cumsum(counts) - counts

    def _forget(self) -> None:
        """The parts that were not used for longest go."""
        kept = np.sort(np.argsort(self.used, kind="stable")[-(MAX_KNOWN // 2):])
        names = list(self.known)
        pool = _gathered(self.pool, self.starts[kept], self.counts[kept])
        self._keep({names[i]: k for k, i in enumerate(kept.tolist())}, self.counts[kept], self.used[kept], pool)

    def _encode_any(self, keys: list[str]) -> tuple[list[int], np.ndarray]:
        """Encode any words; tokens are assigned to them by their place in the text."""
        starts = np.cumsum([0] + [len(k) + 1 for k in keys])
        e = self.tokenizer.encode(" ".join(keys), add_special_tokens=False)
        at = np.array([a for a, _ in e.offsets], np.int64)
        of = np.searchsorted(starts, at, side="right") - 1
        return e.ids, np.bincount(of, minlength=len(keys))

    def _encode_parts(self, keys: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
        """Encode parts of words, which end in one end-of-word token each; faster, as no places are kept."""
        texts = [" ".join(keys[i: i + 200]) for i in range(0, len(keys), 200)]
        for i, e in enumerate(self.plain.encode_batch_fast(texts, add_special_tokens=False)):
            own, ids = keys[200 * i: 200 * i + 200], e.ids
            ends = np.flatnonzero(self.word_end[ids])
            if len(ends) == len(own) and (not ids or ends[-1] == len(ids) - 1):
                yield ids, np.diff(ends, prepend=-1)
            else:  # some character is none to the model
                yield self._encode_any(own)

    def _learn(self, new: pa.StringArray) -> None:
        """Take up new parts of words, and new words that are left whole."""
        part = pc.match_substring_regex(new, _PARTS)
        parts, others = _texts(new.filter(part)), _texts(new.filter(pc.invert(part)))
        got = [x for lo in range(0, len(parts), AT_ONCE) for x in self._encode_parts(parts[lo: lo + AT_ONCE])]
        got += [self._encode_any(others[lo: lo + AT_ONCE]) for lo in range(0, len(others), AT_ONCE)]
        first = len(self.known)
        self.known.update(zip(parts + others, range(first, first + len(new))))
        self._keep(
            self.known, np.concatenate([self.counts, *(n for _, n in got)]),
            np.concatenate((self.used, np.full(len(new), self.step))),
            np.concatenate([self.pool, *(np.array(ids, "<u4") for ids, _ in got)]),
        )

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one word behind the other, and how many each has."""
        self.step += 1
        split = pc.extract_regex(words, pattern=_PARTS)
        body = pc.if_else(split.is_valid(), pc.utf8_lower(pc.struct_field(split, "body")), words)
        tail = pc.fill_null(pc.struct_field(split, "tail"), "")
        both = pa.concat_arrays([body, tail]).dictionary_encode()
        keys = _texts(both.dictionary)
        at = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        if (at < 0).any():
            self._learn(both.dictionary.filter(pa.array(at < 0)))
            at = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        self.used[at[at > 0]] = self.step
        places = at[both.indices.to_numpy()].reshape(2, -1)
        n = self.counts[places]
        ids = _gathered(self.pool, self.starts[places].T.ravel(), n.T.ravel())
        if len(self.known) > MAX_KNOWN:
            self._forget()
        return ids, n.sum(axis=0)

    def ids(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit bytes."""
        ids, n = self.encode(pa.array(words, pa.string()))
        cuts = (np.concatenate(([0], np.cumsum(n))) * 4).tolist()
        data = ids.tobytes()
        return [data[lo:hi] for lo, hi in zip(cuts[:-1], cuts[1:])]


def tokenize(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, and its rank among the pieces of its
    length in the task that made it (``part``, ``rank``)."""
    ship(docs.sparkSession)
    end = int(end_id).to_bytes(4, "little")
    with open(tokenizer, encoding="utf-8") as f:  # on the driver alone
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer, source)
        part, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in steps(batches):
            w = Words(b.column(1))
            ids, n = encoder.encode(w.words)
            starts, n = (np.cumsum(n) - n)[w.ids], n[w.ids]
            offsets = np.concatenate(([0], np.cumsum(n)))[w.offsets]
            joined = _gathered(ids, starts, n)
            doc, piece, start, length, crc = [], [], [], [], []
            for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = joined[lo:hi].tobytes() + end
                for k, s in enumerate(range(0, len(own), 4 * capacity)):
                    p = own[s: s + 4 * capacity]
                    doc.append(i), piece.append(k), start.append(s // 4)
                    length.append(len(p) // 4), crc.append(zlib.crc32(p))
            length = np.array(length)
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - first + ranks[length[order]]
            ranks += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                 pa.array(np.full(len(doc), part, np.int64)), pa.array(rank)],
                [id, "piece", "start", "length", "ids_crc32", "part", "rank"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(
        cut, f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long, part long, rank long"
    )


Pattern = tuple[tuple[tuple[int, int], ...], int]  # ((length, how many), ...) and how often it is used


def _greedy(left: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, int]]:
    """Best fit: again and again the longest piece that still fits."""
    out, at = [], bisect_right(lengths, room) - 1
    while at >= 0 and room > 0:
        n = min(left[lengths[at]], room // lengths[at])
        if n:
            out.append((lengths[at], n))
            room -= n * lengths[at]
        at = min(at - 1, bisect_right(lengths, room) - 1)
    return out


def _fill(left: dict[int, int], lengths: list[int], room: int, max_nodes: int) -> list[tuple[int, int]]:
    """The filling of ``room`` with the least waste among those visited."""
    best = _greedy(left, lengths, room)
    waste = room - sum(v * n for v, n in best)
    nodes = 0

    def branch(at: int, room: int, chosen: list[tuple[int, int]]) -> bool:
        """Try the lengths up to ``at``; True when nothing better can be found any more."""
        nonlocal best, waste, nodes
        while at >= 0:
            nodes += 1
            if nodes > max_nodes:
                return True
            at = min(at, bisect_right(lengths, room) - 1)
            if at < 0:
                break
            length = lengths[at]
            most = min(left[length], room // length)
            for n in range(most, 0, -1):
                rest = room - n * length
                chosen.append((length, n))
                if rest < waste:
                    best, waste = list(chosen), rest
                    if waste == 0:
                        return True
                if rest and branch(at - 1, rest, chosen):
                    return True
                chosen.pop()
            at -= 1
            # with shorter pieces only, no more than all of them can be filled
            if room - below[at + 1] >= waste:
                return False
        return False

    below = np.concatenate(([0], np.cumsum([v * left[v] for v in lengths]))).tolist() if waste else []
    if waste:
        branch(bisect_right(lengths, room) - 1, room, [])
    return best


def _sequences(patterns: list[Pattern]) -> int:
    return sum(times for _, times in patterns)


class _Budget:
    """Steps that a search may still take."""

    def __init__(self, steps: int):
        self.left = steps


def _fillings(left: Counter[int], lengths: list[int], room: int, most_waste: int, budget: _Budget) -> list[tuple[int, tuple[int, ...]]]:
    """(waste, pieces) of the undominated fillings of a room that waste at most ``most_waste``, least waste first.

    A filling is dominated if a piece that it leaves out fits in place of one or two of its own that are together no longer.
    """
    found: list[tuple[int, tuple[int, ...]]] = []
    chosen: list[int] = []

    def go(at: int, room: int, least_out: int) -> None:
        """Choose among lengths up to ``at``; ``least_out``: the shortest length of which a piece is left out."""
        budget.left -= 1
        at = min(at, bisect_right(lengths, room) - 1)
        if at < 0 or budget.left <= 0:
            if room <= most_waste and room < least_out:
                found.append((room, tuple(chosen)))
            return
        v = lengths[at]
        for n in range(min(left[v], room // v), -1, -1):
            chosen.extend([v] * n)
            go(at - 1, room - n * v, least_out if n == left[v] else min(least_out, v))
            del chosen[len(chosen) - n:]

    go(len(lengths) - 1, room, room + 1)
    out = []
    for waste, own in sorted(found, key=lambda f: (f[0], [-v for v in f[1]])):
        used = Counter(own)
        free = [v for v in lengths if left[v] > used[v]]
        sums = {v: v + 1 for v in own} | {x + y: x + y for i, x in enumerate(own) for y in own[:i]}  # what may stand in for them: from where on
        if not waste or not any((k := bisect_left(free, lo)) < len(free) and free[k] <= s + waste for s, lo in sums.items()):
            out.append((waste, own))
    return out


def _complete(histogram: dict[int, int], capacity: int, sequences: int, budget: _Budget) -> list[tuple[int, ...]] | None:
    """The pieces in at most so many sequences, or None if there is no way or the budget runs out (then it is 0).

    Branch and bound: the longest piece left is completed by each undominated filling in turn; a branch ends when its
    waste passes what so many sequences may waste, or when the same pieces have failed with no less waste to spare.
    """
    left, failed = Counter(histogram), {}

    def go(waste: int) -> list[tuple[int, ...]] | None:
        lengths = sorted(v for v in left if left[v])
        if not lengths:
            return []
        key = tuple((v, left[v]) for v in lengths)
        if budget.left <= 0 or failed.get(key, -1) >= waste:
            return None
        longest = lengths[-1]
        left[longest] -= 1
        if not left[longest]:
            lengths.pop()
        got = None
        for lost, own in _fillings(left, lengths, capacity - longest, waste, budget):
            left.subtract(own)
            rest = go(waste - lost)
            left.update(own)
            if rest is not None:
                got = [(longest, *own), *rest]
                break
        left[longest] += 1
        if got is None and budget.left > 0:
            failed[key] = waste
        return got

    waste = sequences * capacity - sum(v * n for v, n in histogram.items())
    return go(waste) if waste >= 0 else None


def _improved(patterns: list[Pattern], capacity: int, least: int, steps: int) -> list[Pattern]:
    """The packing with groups of sequences completed anew, one fewer each.

    A group has sequences that together waste a whole one, and some others; a completion of it is used as often as its patterns
    occur.
    """
    times: Counter[tuple[int, ...]] = Counter()
    for items, n in patterns:
        times[tuple(v for v, k in items for _ in range(k))] += n
    r, budget = random.Random(1), _Budget(steps)
    while sum(times.values()) > least and budget.left > 0:
        waste = {p: capacity - sum(p) for p in times}
        group: Counter[tuple[int, ...]] = Counter()
        spare = 0
        for p in sorted(times, key=lambda p: -waste[p] * r.random()):
            n = min(times[p], -(-(capacity - spare) // waste[p])) if waste[p] and spare < capacity else 0
            if n > 0:
                group[p] = n
                spare += n * waste[p]
        if spare < capacity or sum(group.values()) > MAX_GROUP:
            budget.left -= 1000  # no group to gain from; other draws may be
            continue
        others = [p for p in times if times[p] > group[p]]
        for p in r.sample(others, min(len(others), r.randint(2, 8))):
            group[p] += 1
        pieces = Counter(v for p, n in group.items() for v in p for _ in range(n))
        if len(pieces) > MAX_LENGTHS:
            budget.left -= 1000
            continue
        own = _Budget(min(GROUP_STEPS, budget.left))
        given = own.left
        better = _complete(pieces, capacity, sum(group.values()) - 1, own)
        budget.left -= given - max(own.left, 0) + 1
        if better is not None:
            often = min(times[p] // n for p, n in group.items())
            for p, n in group.items():
                times[p] -= n * often
                if not times[p]:
                    del times[p]
            for p in better:
                times[p] += often
    return [(tuple(sorted(Counter(p).items(), reverse=True)), n) for p, n in times.items()]


def complete_bins(histogram: dict[int, int], capacity: int = CAPACITY, max_nodes: int = MAX_NODES, steps: int = MAX_STEPS) -> list[Pattern]:
    """Patterns that pack all pieces of the histogram, in as few sequences as the search finds.

    A few pieces are packed exactly. Where the steps run out before the bound of the total length is met, that is logged.
    """

    def attempt(max_nodes: int, most_waste: float) -> list[Pattern] | None:
        left = {v: n for v, n in histogram.items() if n > 0}
        lengths = sorted(left)
        out, wasted = [], 0
        while lengths:
            longest = lengths[-1]
            left[longest] -= 1
            rest = _fill(left, lengths, capacity - longest, max_nodes) if max_nodes else _greedy(
                left, lengths, capacity - longest)
            left[longest] += 1
            used = dict(rest)
            used[longest] = used.get(longest, 0) + 1
            times = min(left[v] // n for v, n in used.items())
            out.append((tuple(sorted(used.items(), reverse=True)), times))
            for v, n in used.items():
                left[v] -= n * times
            lengths = [v for v in lengths if left[v]]
            if lengths:  # the last sequence may be as empty as it likes
                wasted += times * (capacity - sum(v * n for v, n in used.items()))
                if wasted > most_waste:
                    return None
        return out

    best = attempt(0, float("inf"))
    total = sum(v * n for v, n in histogram.items())
    least = -(-total // capacity)
    if _sequences(best) > least and max_nodes:
        # one sequence less may waste this much at most
        other = attempt(max_nodes, capacity * (_sequences(best) - 1) - total + capacity)
        if other is not None and _sequences(other) < _sequences(best):
            best = other
    if _sequences(best) > least and steps:
        if sum(histogram.values()) <= EXACT_PIECES:
            budget, n = _Budget(steps), least
            while n < _sequences(best) and budget.left > 0:
                found = _complete(histogram, capacity, n, budget)
                if found is not None:
                    return [(tuple(sorted(Counter(p).items(), reverse=True)), 1) for p in found]
                n += 1
            proven = budget.left > 0
        else:
            best = _improved(best, capacity, least, steps)
            proven = _sequences(best) == least
        if not proven:
            _log.warning("the search of %d steps has ended at %d sequences; at least %d are needed", steps, _sequences(best), least)
    return best


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """For each length its runs of slots: rows of (first rank, how many in one sequence, first sequence, offset)."""
    taken: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for items, times in patterns:
        offset = 0
        for length, n in items:
            lo = taken.get(length, 0)
            out.setdefault(length, []).append((lo, n, sequence, offset))
            taken[length] = lo + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in out.items()}


def pack(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(tokenize(docs, tokenizer, id, text, capacity, end_id), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(slots(complete_bins(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["part", "length"]).select(
        id, "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for v in np.unique(length):
                own = np.flatnonzero(length == v)
                s = places.value[int(v)]
                run = s[np.searchsorted(s[:, 0], rank[own], side="right") - 1]
                inside = rank[own] - run[:, 0]
                sequence[own] = run[:, 2] + inside // run[:, 1]
                offset[own] = run[:, 3] + inside % run[:, 1] * v
            yield pa.RecordBatch.from_arrays(
                b.columns[:5] + [pa.array(sequence), pa.array(offset)],
                b.schema.names[:5] + ["sequence_id", "offset"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return ranked.mapInArrow(
        place, f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
