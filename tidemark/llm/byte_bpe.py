"""Byte-level BPE encoding and decoding with a rank queue over a hierarchical bitmap.

A text is split into pre-tokens by the vocabulary's pattern. A pre-token that is itself a token
becomes that token; in any other, the adjacent pair of the lowest rank is merged, leftmost
first, until no pair is a token.

The tokens form a linked list by start position, with walls between the pre-tokens that are merged together. Each adjacent
pair that is a token lies in the bucket of its rank, and three levels of 64-bit words mark the buckets in use: the lowest rank
is found by a find-first-set in one word per level, whatever the length. A bucket holds its
positions as a heap, so equal ranks merge from the left; it is emptied in one go unless a merge makes a pair of a lower rank.
A merge leaves entries of the two pairs it has broken in their buckets; they no longer match the rank noted for their position
and are skipped when met. So n bytes take at most 2n pushes of O(log n), and a very long pre-token costs no more per byte than
short ones.

Only texts are read and nothing is shuffled. Ranks (tens of thousands, read by the driver from the
file given) are broadcast. A worker keeps the ids of at most ``MAX_KNOWN`` pre-tokens of at most
``MAX_KNOWN_CHARS`` characters, and forgets the older half when full. Texts are taken ``PIECES``
pre-tokens at a time, so beside the text and its ids only a single pre-token may grow with a text's length.

Edge cases: a null or empty text has no ids and decodes to no bytes. Any other text decodes to its UTF-8
bytes. Repeated rows are each encoded. With no rows the result is empty. Other columns, null
ids among them, pass through; those with the name of an added one are replaced.
"""

from __future__ import annotations

import base64
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import append_columns, strings

#: Pre-tokens whose ids a worker keeps, and the longest that it keeps.
MAX_KNOWN, MAX_KNOWN_CHARS = 1_000_000, 32
#: Pre-tokens that are held at once.
PIECES = 200_000
#: Characters of pre-tokens that are merged together (a single longer one by itself).
AT_ONCE = 300_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class RankQueue:
    """Positions by rank: the lowest rank first, the leftmost position of it first."""

    def __init__(self, n_ranks: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []  # levels[0]: a bit for each rank; each further one: a bit for each word below
        n = n_ranks
        while not self.levels or n > 1:
            n = -(-n // 64)
            self.levels.append([0] * n)

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket that is not in use gets its first positions, in order."""
        self.buckets[rank] = positions
        for level in self.levels:
            rank, bit = rank >> 6, rank & 63
            was, level[rank] = level[rank], level[rank] | 1 << bit
            if was:
                return

    def push(self, rank: int, position: int) -> None:
        if rank in self.buckets:
            heappush(self.buckets[rank], position)
        else:
            self.open(rank, [position])

    def first(self) -> int:
        """The lowest rank that has entries; the queue must not be empty."""
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        return rank

    def close(self, rank: int) -> None:
        """An empty bucket goes out of use."""
        del self.buckets[rank]
        for level in self.levels:
            rank, bit = rank >> 6, rank & 63
            level[rank] &= ~(1 << bit)
            if level[rank]:
                return


class Codec:
    """Encodes and decodes under one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1]))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)])
        self.of_pair = np.full(1 << 16, -1)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.of_pair[token[0] << 8 | token[1]] = rank

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each of some non-empty pre-tokens, which lie one behind the other in one list."""
        data, get = b"".join(pieces), self.ranks.get
        cuts = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
        n = len(data)
        body = np.frombuffer(data, np.uint8).astype(np.int64)
        first_pairs = np.concatenate((self.of_pair[body[:-1] << 8 | body[1:]], [-1]))
        first_pairs[cuts[1:] - 1] = -1  # no pair across pre-tokens
        queue = self.queue
        order = np.argsort(first_pairs, kind="stable")
        order = order[np.searchsorted(first_pairs[order], 0):]
        ranks, at = np.unique(first_pairs[order], return_index=True)
        for r, lo, hi in zip(ranks.tolist(), at.tolist(), [*at[1:].tolist(), len(order)]):
            queue.open(r, order[lo:hi].tolist())  # ascending, so a heap
        pair = first_pairs.tolist()  # rank of the pair that starts at a position, -1: none
        token = self.of_byte[body].tolist()  # rank of the token that starts there
        ends = list(range(1, n + 1))
        left = np.arange(-1, n - 1)  # start of the token before
        left[cuts[:-1]] = -1
        before = left.tolist()
        wall, alive = bytearray(n + 1), bytearray(b"\1") * n
        for c in cuts.tolist():
            wall[c] = 1
        buckets, push = queue.buckets, queue.push
        while buckets:
            r = queue.first()
            own = buckets[r]
            while own:
                i = heappop(own)
                if pair[i] != r:
                    continue  # stale
                gone, lower = ends[i], False
                end = ends[i] = ends[gone]
                token[i], pair[gone], alive[gone] = r, -1, 0
                if wall[end]:
                    pair[i] = -1
                else:
                    before[end] = i
                    x = pair[i] = get(data[i:ends[end]], -1)
                    if x >= 0:
                        push(x, i)
                        lower = x < r
                j = before[i]
                if j >= 0:
                    x = pair[j] = get(data[j:end], -1)
                    if x >= 0:
                        push(x, j)
                        lower = lower or x < r
                if lower:
                    break
            else:
                queue.close(r)
        kept = np.frombuffer(alive, np.uint8).astype(bool)
        ids = np.array(token, "<u4")[kept].tobytes()
        stops = (4 * np.concatenate(([0], np.cumsum(kept)))[cuts]).tolist()
        return [ids[a:b] for a, b in zip(stops[:-1], stops[1:])]

    def _learn(self, pieces: set[str]) -> None:
        """Put the ids of pre-tokens in the table."""
        known, older, get = self.known, self.older, self.ranks.get
        hard: list[str] = []
        size = 0

        def merged() -> None:
            known.update(zip(hard, self.merge([p.encode() for p in hard])))

        for p in pieces:
            if p in older:
                known[p] = older[p]
                continue
            whole = get(p.encode())
            if whole is not None:
                known[p] = whole.to_bytes(4, "little")
                continue
            hard.append(p)
            size += len(p)
            if size > AT_ONCE:
                merged()
                hard, size = [], 0
        if hard:
            merged()

    def _forget(self) -> None:
        """Keep the table within its bound: of two halves, the older one goes."""
        if len(self.known) > MAX_KNOWN // 2:
            self.older = self.known if len(self.known) <= MAX_KNOWN else {}
            self.known = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of texts as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        held: list[list[str]] = []
        n = 0

        def done() -> None:
            nonlocal n
            new = set().union(*held) - self.known.keys()
            self._learn(new)
            get = self.known.__getitem__
            out.extend(b"".join(map(get, pieces)) for pieces in held)
            for p in new:
                if len(p) > MAX_KNOWN_CHARS:
                    del self.known[p]
            self._forget()
            held.clear()
            n = 0

        for t in texts:
            if len(t) > PIECES:
                done()
                found, parts = (m.group() for m in self.pattern.finditer(t)), []
                while pieces := list(islice(found, PIECES)):
                    held.append(pieces)
                    done()
                    parts.append(out.pop())
                out.append(b"".join(parts))
                continue
            held.append(self.pattern.findall(t))
            n += len(held[-1])
            if n > PIECES:
                done()
        done()
        return out

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids; each token's bytes are copied out of the joined vocabulary."""
        out = []
        for lo in range(0, len(ids), 4 * PIECES):
            part = np.frombuffer(ids[lo: lo + 4 * PIECES], "<u4")
            if part.size and int(part.max()) >= len(self.sizes):
                raise ValueError(f"id {int(part.max())} is not in the vocabulary")
            size = self.sizes[part]
            shift = self.starts[part] - (np.cumsum(size) - size)
            out.append(self.bytes[np.repeat(shift, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(out)


_codecs: dict[str, Codec] = {}


def _codec(key: str, ranks, pattern: str) -> Codec:
    """The worker's codec, kept for its later tasks."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


def _mapped(df: DataFrame, path: str, pattern: str, of, ddl: str) -> DataFrame:
    ranks = df.sparkSession.sparkContext.broadcast(load_ranks(path))
    key = f"{path}\n{pattern}"
    return append_columns(df, lambda b: of(b, _codec(key, ranks, pattern)), ddl)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit integers) added by the rank file at ``path``;
    with ``decoded``, in the same pass the bytes that ``ids`` decodes to as well."""

    def of(b: pa.RecordBatch, codec: Codec) -> dict[str, pa.Array]:
        ids = codec.encode(strings(b.column(text)).to_pylist())
        new = {"ids": pa.array(ids, pa.binary())}
        if decoded:
            new["decoded"] = pa.array([codec.decode(i) for i in ids], pa.binary())
        return new

    return _mapped(docs, path, pattern, of, "ids binary, decoded binary" if decoded else "ids binary")


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary) added: the bytes of the column ``ids``. Null decodes to no bytes; an id beyond the
    vocabulary is an error."""

    def of(b: pa.RecordBatch, codec: Codec) -> dict[str, pa.Array]:
        return {"decoded": pa.array([codec.decode(i or b"") for i in b.column(ids).to_pylist()], pa.binary())}

    return _mapped(encoded, path, pattern, of, "decoded binary")
