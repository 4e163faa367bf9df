"""Cheapest repair of conversations by block tables in the manner of the Four Russians.

A repaired conversation is empty, or has an optional system row and then user and assistant rows in turns. Each row
is kept (0), given another role (R, 3) or deleted (D, 4; required for blank rows and for duplicates), and rows with an empty
text may be inserted anywhere (I, 3); a truncated row that stays adds 3. Of the cheapest edits
the one whose letters, in order, are least in ASCII is taken.

What a row allows is one of nine symbols. What the rows from some place on cost at least is a vector
over the four states of the grammar; less its minimum, only a few such vectors exist.
For every vector behind a block of ``BLOCK`` symbols and every block, a table holds the vector in front of it and the state
in which a least edit leaves the block, for each state that it enters in. A run of rows
is processed from its end by one lookup per block. The edits are then read off forwards:
each block is expanded backward from the vector behind it, and at each place the least letter that keeps the optimum is
taken, so ties are decided as asked.

A conversation may hold any share of the rows, so it is not gathered for this. Rows are reduced to keys and symbols
(identical rows are counted first), sorted over range partitions and cut into pieces of at most ``PIECE`` rows.
A piece that holds a whole conversation is solved where it is. Any other is reduced to what it does to every
vector and state; these reductions, a few hundred bytes for each ``PIECE`` rows, are chained per
conversation, and then each piece is solved by itself. Duplicates come from one
aggregate per conversation, role and text. Texts move once: they are dealt out by conversation, meet the
edits of their piece in sorted order, and stream through without being held.
(A digest over a whole conversation can only be taken in one task; it streams as well.)

Edge cases: a null role or text is one space. Rows are taken by turn, nulls first, then by role and by the MD5 of their text; rows
with the same of all are copies, and those after the first are duplicates. Conversations with a null id are one.
A role whose first letter is none of s, u, a (or that is empty) fits nowhere unless it is changed. An empty table gives no rows.
Only the four columns named are read, so extra ones cannot clash; the results have names of their own. Texts may have any length, as
they are only passed on.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import n_partitions, ship, stored

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (START, ASSISTANT)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after the one row that may be inserted, or put by a changed role.
FOLLOWS = [USER, USER, ASSISTANT, USER]
INITIALS = "sua"
#: 0: must be deleted; else 1 + 2 * (place in INITIALS, or 3) + (1 if truncated).
SYMBOLS = 9
BLOCK = 4
#: Rows of a conversation that are traced at a time.
PIECE = 65_536
_BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
_FAR = 1 << 20


def _kept(state: int, symbol: int) -> int | None:
    """State after keeping a row, None where that is not allowed."""
    if symbol == 0:
        return None
    initial = (symbol - 1) // 2
    if initial == 0 and state == START:
        return SYSTEM
    return FOLLOWS[state] if initial + 1 == FOLLOWS[state] else None


def _edits(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of every edit of a row, by letter."""
    out = [("D", DELETE, state)]
    if symbol:
        cut = TRUNCATED * ((symbol - 1) % 2)
        if (to := _kept(state, symbol)) is not None:
            out.append(("K", cut, to))
        out.append(("R", REROLE + cut, FOLLOWS[state]))
    return out


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[FOLLOWS[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _before(behind: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs in front of a row, by state, from those behind it."""
    return _with_inserts([min(c + behind[to] for _, c, to in _edits(q, symbol)) for q in range(4)])


def _normalised(costs: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(c - min(costs) for c in costs)


class Tables:
    """Transitions of normalised cost vectors over blocks of up to ``BLOCK`` symbols.

    ``front[k][v, code]``: the vector in front of a block of k symbols (a number in base 9, first symbol first) with vector v behind
    it. ``exits[k][v, code, q]``: the state in which a least edit from state q leaves it. Vector 0
    is that of the end.
    """

    def __init__(self, block: int = BLOCK):
        self.block = block
        end = _normalised(_with_inserts([0 if q in FINAL else _FAR for q in range(4)]))
        self.vectors, number = [end], {end: 0}
        for v in self.vectors:  # grows meanwhile
            for s in range(SYMBOLS):
                new = _normalised(_before(v, s))
                if new not in number:
                    number[new] = len(self.vectors)
                    self.vectors.append(new)
        k = len(self.vectors)
        one = np.array([[number[_normalised(_before(v, s))] for s in range(SYMBOLS)] for v in self.vectors], np.int32)
        leaves = np.array([[[self._row(v, s, q)[1] for q in range(4)] for s in range(SYMBOLS)] for v in self.vectors], np.uint8)
        self.front, self.exits = [np.arange(k, dtype=np.int32)[:, None]], [np.tile(np.arange(4, dtype=np.uint8), (k, 1, 1))]
        for _ in range(block):  # one more symbol in front
            f, e = self.front[-1], self.exits[-1]
            inner = leaves[f].transpose(0, 2, 1, 3)  # vector, first symbol, rest of the block, state
            self.front.append(one[f].transpose(0, 2, 1).reshape(k, -1))
            self.exits.append(np.take_along_axis(
                np.broadcast_to(e[:, None], inner.shape), inner.astype(np.int64), axis=3).reshape(k, -1, 4))
        self.known: dict[tuple[int, int, int, int], tuple[str, int]] = {}

    @staticmethod
    def _row(behind: tuple[int, ...], symbol: int, state: int) -> tuple[str, int]:
        """Letters (inserted rows first) and state after a row, entered in ``state``."""
        front, out = _before(behind, symbol), ""
        while True:
            letter, state = min(
                [(x, to) for x, c, to in _edits(state, symbol) if c + behind[to] == front[state]]
                + [("I", FOLLOWS[state])] * (INSERT + front[FOLLOWS[state]] == front[state]))
            out += letter
            if letter != "I":
                return out, state

    def blocks(self, symbols: bytes) -> list[tuple[int, int]]:
        """(length, code) of the blocks of a run, cut from its end."""
        s = np.frombuffer(symbols, np.uint8).astype(np.int64)
        head, b = len(s) % self.block, self.block
        codes = s[head:].reshape(-1, b) @ SYMBOLS ** np.arange(b - 1, -1, -1)
        out = [(b, c) for c in codes.tolist()]
        return [(head, int(s[:head] @ SYMBOLS ** np.arange(head - 1, -1, -1)))] + out if head else out

    def expand(self, length: int, behind: int, code: int, state: int) -> tuple[str, int]:
        """Letters of a block and the state that it is left in."""
        key = (length, behind, code, state)
        if key not in self.known:
            symbols, v = [], [self.vectors[behind]]
            for _ in range(length):  # the vectors inside, backward
                code, s = divmod(code, SYMBOLS)
                symbols.append(s)
                v.append(_normalised(_before(v[-1], s)))
            letters = ""
            for s, after in zip(reversed(symbols), reversed(v[:-1])):
                own, state = self._row(after, s, state)
                letters += own
            self.known[key] = letters, state
        return self.known[key]

    def trace(self, symbols: bytes, behind: int = 0, state: int = START, last: bool = True) -> str:
        """Letters of a run of rows that is entered in ``state`` and has vector ``behind`` behind it."""
        blocks, right = self.blocks(symbols), []
        for length, code in reversed(blocks):
            right.append(behind)
            behind = int(self.front[length][behind, code])
        out = []
        for (length, code), v in zip(blocks, reversed(right)):
            letters, state = self.expand(length, v, code, state)
            out.append(letters)
        while last and state not in FINAL:
            out.append("I")
            state = FOLLOWS[state]
        return "".join(out)

    def reduced(self, symbols: bytes) -> tuple[bytes, bytes]:
        """What a run does: the vector in front of it for each one behind it, and the state it is left in for each of
        these and each state that it is entered in."""
        front, exits = self.front[0][:, 0], self.exits[0][:, 0]
        for length, code in self.blocks(symbols):
            f = self.front[length][:, code]
            front, exits = front[f], np.take_along_axis(self.exits[length][:, code], exits[f].astype(np.int64), axis=1)
        return front.astype("<i4").tobytes(), exits.tobytes()


_tables: dict[int, Tables] = {}


def tables() -> Tables:
    """The worker's tables, made once."""
    if BLOCK not in _tables:
        _tables[BLOCK] = Tables(BLOCK)
    return _tables[BLOCK]


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with the faults that the crc32 of ``conv:turn`` modulo 20 picks: dropped (0), emptied (1), without stops (2), repeated (3), role
    user (4). Returns the four columns under the names conv_id, turn, role, text; other columns are left out."""
    fault = F.crc32(F.concat(_key(conv), F.lit(":"), _key(turn)).cast("binary")) % 20
    body, who = F.coalesce(F.col(text), F.lit(" ")), F.coalesce(F.col(role), F.lit(" "))
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.when(fault == 4, "user").otherwise(who).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(body, "[.!?]", "")).otherwise(body).alias("text"),
        F.explode(F.when(fault == 0, F.array_repeat(F.lit(0), 0)).otherwise(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1)))).alias("copy"),
    ).drop("copy")


def _symbol(role: Column, text: Column) -> Column:
    initial = sum((F.when(role.startswith(c), i - 3).otherwise(0) for i, c in enumerate(INITIALS)), F.lit(3))
    cut = (~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z")).cast("int")
    return F.when(text.rlike("[^\\x20\\x09-\\x0D]"), 1 + 2 * initial + cut).otherwise(0).cast("byte")


ORDER = ["conv_id", "turn", "role", "digest"]


def _pieces(src: DataFrame, piece: int) -> DataFrame:
    """Runs of at most ``piece`` rows of a conversation in order, with the letters of their edits: the key of the first row, ``at`` (their order),
    ``syms`` (a byte per row), ``audit``."""
    spark, kind = src.sparkSession, src.schema["conv_id"].dataType.simpleString()
    counted = src.groupBy(*ORDER, "sym").agg(F.count(F.lit(1)).alias("n"))
    # a text in several turns: the first of them, where null is the least
    again = (
        counted.groupBy("conv_id", "role", "digest")
        .agg(F.max(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("lo"), F.max("turn").alias("hi"))
        .where("lo < hi OR unplaced AND lo IS NOT NULL")
        .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                F.lit(True).alias("repeated"), F.when(~F.col("unplaced"), F.col("lo")).alias("first"))
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    marked = stored(
        counted.join(again, same, "left").select(
            *ORDER, "sym", "n", (F.col("repeated").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))).alias("copy")),
        "conversation-rows")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        at, opening, first, conv, symbols = TaskContext.get().partitionId() << 33, True, None, None, bytearray()
        done: list[tuple] = []
        size = 0

        def close(whole: bool) -> None:
            nonlocal at, size, symbols
            run = bytes(symbols)
            done.append((*first, at, run, *((t.trace(run), None, None) if whole else (None, *t.reduced(run)))))
            at, size, symbols = at + 1, size + 2 * len(run), bytearray()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), fields)], [f.name for f in fields])
            done.clear()
            return out

        fields: list[pa.Field] = []
        split = False  # whether the conversation had an earlier piece here
        for b in batches:
            fields = fields or [*(b.schema.field(i) for i in range(4)), pa.field("at", pa.int64()), pa.field("syms", pa.binary()),
                                pa.field("audit", pa.string()), pa.field("front", pa.binary()), pa.field("exits", pa.binary())]
            for *key, sym, n, copy in zip(*(c.to_pylist() for c in b.columns)):
                if first is not None and key[0] != conv:
                    close(not opening and not split)
                    first, opening, split = None, False, False
                conv = key[0]
                while n:
                    if first is not None and len(symbols) == piece:
                        close(False)
                        first, split = None, True
                        if size > 8 << 20:
                            yield flush()
                            size = 0
                    if first is None:
                        first = key
                    take = min(n, piece - len(symbols))
                    symbols.extend(bytes([0 if copy else sym]) + bytes(take - 1))
                    n, copy = n - take, True
                if len(done) >= 2000:
                    yield flush()
                    size = 0
        if first is not None:
            close(False)  # the next partition may go on with it
        if done:
            yield flush()

    n = n_partitions(spark)
    found = stored(
        marked.repartitionByRange(n, *ORDER).sortWithinPartitions(*ORDER).mapInArrow(
            cut, f"conv_id {kind}, turn long, role string, digest binary, at long, syms binary, audit string, front binary, exits binary"),
        "conversation-pieces")

    def chain(table: pa.Table) -> pa.Table:
        rows = table.sort_by("at").to_pydict()
        behind, state, right, entry = 0, START, [], []
        for f in reversed(rows["front"]):
            right.append(behind)
            behind = int(np.frombuffer(f, "<i4")[behind])
        right.reverse()
        for v, e in zip(right, rows["exits"]):
            entry.append(state)
            state = e[4 * v + state]
        last = [False] * (len(right) - 1) + [True]
        return pa.table({"at": pa.array(rows["at"], pa.int64()), "behind": pa.array(right, pa.int32()),
                         "state": pa.array(entry, pa.int32()), "last": last})

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            *_, syms, behind, state, last = (c.to_pylist() for c in b.columns)
            audit = [tables().trace(*x) for x in zip(syms, behind, state, last)]
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(audit, pa.string())], [*b.schema.names[:6], "audit"])

    ends = found.where("audit IS NULL")
    chained = ends.select("conv_id", "at", "front", "exits").groupBy("conv_id").applyInArrow(
        chain, "at long, behind int, state int, last boolean")
    columns = [*ORDER, "at", "syms"]
    rest = ends.join(chained, "at").select(*columns, "behind", "state", "last").mapInArrow(
        traced, f"conv_id {kind}, turn long, role string, digest binary, at long, syms binary, audit string")
    return found.where("audit IS NOT NULL").select(*columns, "audit").unionByName(rest)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           piece: int = PIECE) -> DataFrame:
    """Every edit, those of a conversation in order and in one partition.

    Columns: conv_id, edit (K, R, D or I), turn, role (as it was; null for I), new_role (null for D), fault (blank,
    duplicate, truncated or null) and text.
    """
    spark, kind = rows.sparkSession, rows.schema[conv].dataType.simpleString()
    ship(spark)
    who, body = F.coalesce(F.col(role), F.lit(" ")), F.coalesce(F.col(text), F.lit(" "))
    src = rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), who.alias("role"),
        F.unhex(F.md5(body.cast("binary"))).alias("digest"), _symbol(who, body).alias("sym"), body.alias("text"))
    pieces = _pieces(src.drop("text"), piece).select(*ORDER, F.lit(0).alias("kind"), "at", "syms", "audit", F.lit(None).cast("string").alias("text"))
    texts = src.select(
        *ORDER, F.lit(1).alias("kind"), F.lit(None).cast("long").alias("at"), F.lit(None).cast("binary").alias("syms"),
        F.lit(None).cast("string").alias("audit"), "text")
    merged = pieces.unionByName(texts).repartition(n_partitions(spark), "conv_id").sortWithinPartitions(*ORDER, "kind", "at")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: deque[tuple[bytes, str]] = deque()  # the pieces to come
        syms, audit, i, j, state, n_bytes = b"", "", 0, 0, START, 0
        out: list[list] = [[] for _ in range(7)]
        conv_type, conv, started = None, None, False

        def put(*row) -> None:
            for c, v in zip(out, row):
                c.append(v)

        def flush() -> pa.RecordBatch:
            kinds = [conv_type, pa.string(), pa.int64(), *[pa.string()] * 4]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["conv_id", "edit", "turn", "role", "new_role", "fault", "text"])
            for c in out:
                c.clear()
            return made

        for b in batches:
            conv_type = b.schema.field(0).type
            for own, at, who, _, kind, _, s, a, t in zip(*(c.to_pylist() for c in b.columns)):
                if kind == 0:
                    if not started or own != conv:
                        started, conv, state = True, own, START
                    runs.append((s, a))
                    continue
                if i == len(syms):
                    if j == len(audit) and not runs:
                        raise ValueError(f"conversation {own}: a row without an edit")
                    (syms, audit), i, j = runs.popleft(), 0, 0
                while audit[j] == "I":
                    state = FOLLOWS[state]
                    put(own, "I", None, None, ROLES[state], None, "")
                    j += 1
                edit, sym = audit[j], syms[i]
                i, j = i + 1, j + 1
                fault = ("duplicate" if t.strip(_BLANK) else "blank") if sym == 0 else "truncated" if sym % 2 == 0 else None
                if edit == "D":
                    new = None
                elif edit == "K":
                    state, new = _kept(state, sym), who
                else:
                    state = FOLLOWS[state]
                    new = ROLES[state]
                put(own, edit, at, who, new, fault, t)
                n_bytes += len(t)
                if i == len(syms):
                    while j < len(audit):
                        state, j = FOLLOWS[state], j + 1
                        put(own, "I", None, None, ROLES[state], None, "")
                if len(out[0]) >= 5000 or n_bytes > 8 << 20:
                    yield flush()
                    n_bytes = 0
        if out[0]:
            yield flush()

    return merged.mapInArrow(
        apply, f"conv_id {kind}, edit string, turn long, role string, new_role string, fault string, text string")


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result, which must come as it is (its partitions and order are used).

    gaps: turns missing between the least and the greatest; blank, duplicate, truncated: rows by fault; illegal: adjacent rows whose roles may
    not follow each other; cost; audit: the edits' letters; repaired_sha256: of the rows that stay, as ``role:text`` lines.
    """
    ship(repaired.sparkSession)
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv_type, started, conv = None, False, None
        letters, lines, least, turn, distinct, last, n = [], None, None, None, 0, None, dict.fromkeys(COUNTS, 0)

        def close() -> None:
            n["gaps"] = turn - least + 1 - distinct if distinct else 0
            done.append((conv, *n.values(), "".join(letters), lines.hexdigest()))

        def flush() -> pa.RecordBatch:
            kinds = [conv_type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], ["conv_id", *COUNTS, "audit", "repaired_sha256"])
            done.clear()
            return made

        for b in batches:
            conv_type = b.schema.field(0).type
            for own, edit, at, role, new, fault, text in zip(*(c.to_pylist() for c in b.columns)):
                if not started or own != conv:
                    if started:
                        close()
                    started, conv = True, own
                    letters, lines, least, turn, distinct, last = [], hashlib.sha256(), None, None, 0, None
                    n = dict.fromkeys(COUNTS, 0)
                    some = False
                letters.append(edit)
                n["cost"] += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
                if fault:
                    n[fault] += 1
                    n["cost"] += TRUNCATED * (fault == "truncated" and edit != "D")
                if new is not None:
                    lines.update(f"{chr(10) * some}{new}:{text}".encode())
                    some = True
                if edit == "I":
                    continue
                if last is not None and last + role[:1] not in ("su", "ua", "au"):
                    n["illegal"] += 1
                last = role[:1]
                if at is not None and at != turn:  # in ascending order
                    least, turn, distinct = at if least is None else least, at, distinct + 1
            if len(done) >= 2000:
                yield flush()
        if started:
            close()
            yield flush()

    return repaired.mapInArrow(
        run, f"conv_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")
