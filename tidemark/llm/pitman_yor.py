"""Language model scores with a hierarchical Pitman-Yor model.

Tokens are words (A-Z in lower case) and one end per text. The restaurants form three levels that
share their parents: a restaurant for each previous word; below it one for the class of that word's last byte,
shared by all words of the class; below these the root, shared by all; and at the bottom a uniform choice
among the V known words and one for all others. Previous words are told apart by ``CONTEXT_BITS`` bits: five of
their last byte and the others of their hash. So there are at most 1,048,576 + 32 + 1 restaurants whatever the
corpus, and words with the same bits share one, while the dishes (words) and the (context, word) counts grow with
it and are never cut.

Seating. For each dish of a restaurant the customers are seated one after the other: a new table is
opened in proportion to (strength + discount * tables of the restaurant) * parent's probability,
an old one of the dish in proportion to customers - discount * tables. Each new table
sends a customer to the parent. A Gibbs sweep reseats all dishes of all restaurants, from the
contexts to the root, given all other tables and the parents' probabilities of the last sweep. The
tables of a restaurant over all words are summed once a sweep and are constant during
it, so words can be sampled independently, in tasks dealt out by word. From the 64th customer of a
dish on, customers are seated in groups of a sixteenth of those present, which makes the work of a
dish logarithmic in its count. After ``BURN_IN`` sweeps, each sweep gives a sample; the
predictive probabilities are averaged over the samples, and scores and perplexity use the average.

After each sweep the discounts are estimated anew from the numbers of dishes with one and two customers, and the
strength of each level is drawn from its posterior given the restaurants' customers and tables, on a grid.

Data flow. Blocks of documents send their distinct (word, context) pairs with training counts, as compressed
byte planes, dealt out by word. Counts are merged per word range and stored. Each sweep is one job over the stored counts
that returns the restaurants' totals (bounded by their number), summed slice by slice; a range's tables are derived again
from the counts, the totals so far and fixed seeds, so nothing else is kept and any task can be
repeated. At last each block gets the probabilities and counts of its pairs and adds them up
per document. A word is in one range, but a block sends it once, so very common words
weigh no more than others.

Edge cases: a null or empty text is its end token. Repeated rows and ids are each scored. A very long text is a block
by itself, read as a whole in one task. Only the id, the text and the columns of ``held_out`` are read: other columns, whatever their names, do not appear in the result. Without training
documents every token has probability 1 (V is 0). Without documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, n_partitions, segment_sums, ship, steps, stored, translated

SWEEPS, BURN_IN = 5, 2
SEED = 20
#: Bits that tell a previous word; the first ``CLASS_BITS`` are those of its last byte.
CONTEXT_BITS, CLASS_BITS = 20, 5
REST_BITS = CONTEXT_BITS - CLASS_BITS
#: Strengths to choose from, and the mean of their exponential prior.
STRENGTHS, PRIOR_MEAN = 0.05 * 2 ** (np.arange(41) / 2), 1000.0
#: Text of a block, and totals summed in one row.
BLOCK_BYTES, SLICE = 16 << 20, 8192
#: Customers from which on they are seated in groups, of this fraction of those present.
SINGLY, GROUP = 64, 16
#: Context of a text's first token.
START = 0
END_WORD = np.uint64(0x5D0F3A1C9B7E2468)

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_PAIRS = "words binary, pairs binary, contexts binary, counts binary"
_BLOCK = f"p int, block long, {_PAIRS}, ids array<{{kind}}>, held array<boolean>, lengths array<int>, index binary"
_MODEL = f"p int, {_PAIRS}"
_ANSWER = pa.schema([("p", pa.int32()), ("block", pa.int64())] + [(c, pa.binary()) for c in ("scores", "pairs", "counts")])


def _squeeze(a: np.ndarray, kind: str = "<i4") -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(a.astype(kind).view(np.uint8).reshape(len(a), np.dtype(kind).itemsize).T)
    return zstandard.compress(planes.tobytes(), 1)


def _expand(b: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(b), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack(words: np.ndarray, pairs: np.ndarray, contexts: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Sorted words, and of each its number of pairs; contexts and counts of the pairs, sorted by word and context."""
    steps_up = np.diff(contexts.astype(np.int64), prepend=0) & (1 << CONTEXT_BITS) - 1
    return [_squeeze(np.diff(words, prepend=np.uint64(0)), "<u8"), _squeeze(pairs), _squeeze(steps_up), _squeeze(counts, "<i8")]


def _unpack(words: bytes, pairs: bytes, contexts: bytes, counts: bytes) -> tuple[np.ndarray, ...]:
    steps_up = np.cumsum(_expand(contexts), dtype=np.int64) & (1 << CONTEXT_BITS) - 1
    return np.cumsum(_expand(words, "<u8"), dtype=np.uint64), _expand(pairs), steps_up, _expand(counts, "<i8")


def _packed(rows: pa.Table) -> list[tuple[np.ndarray, ...]]:
    columns = [rows[c].to_pylist() for c in ("words", "pairs", "contexts", "counts")]
    return [_unpack(*row) for row in zip(*columns, strict=True)]


def _list(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False)


def _blocks(docs: DataFrame, kind: str, parts: int) -> DataFrame:
    """What each block sends: a row per word range, and one with its documents. ``docs``: id, text, held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for n, b in enumerate(steps(batches, BLOCK_BYTES)):
            w = Words(translated(b.column(1), _LOWER))
            hashes = np.append(w.hashes(), END_WORD)
            last = np.fromiter((x[-1] for x in w.words.cast(pa.binary()).to_pylist()), np.int64, len(w.words))
            low = (hashes[:-1] & np.uint64((1 << REST_BITS) - 1)).astype(np.int64)
            as_context = np.append((last & (1 << CLASS_BITS) - 1) << REST_BITS | low, START)
            # each text's words and its end, and before each the context
            lengths = w.lengths + 1
            close = np.cumsum(lengths) - 1
            word = np.full(int(lengths.sum()), len(hashes) - 1, np.int32)
            inside = np.ones(len(word), bool)
            inside[close] = False
            word[inside] = w.ids
            context = np.empty(len(word), np.int32)
            context[1:] = as_context[word[:-1]]
            context[close + 1 - lengths] = START
            del w, inside
            distinct, rank = np.unique(hashes, return_inverse=True)
            key = rank[word]
            key <<= CONTEXT_BITS
            key |= context
            del word, context
            pairs, index = np.unique(key, return_inverse=True)
            del key
            index = index.astype(np.int32)
            held = b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            trained = np.repeat(~held, lengths)
            counts = np.bincount(index[trained], minlength=len(pairs))
            of = pairs >> CONTEXT_BITS
            used, n_pairs = np.unique(of, return_counts=True)
            distinct = distinct[used]
            p = ((distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            ranges = np.unique(p)
            cut = np.concatenate(([0], np.searchsorted(p, ranges, side="right")))
            pair_cut = np.concatenate(([0], np.cumsum(n_pairs)))[cut]
            contexts = pairs & (1 << CONTEXT_BITS) - 1
            k = len(ranges)
            sent = [
                _pack(distinct[cut[i]: cut[i + 1]], n_pairs[cut[i]: cut[i + 1]], contexts[pair_cut[i]: pair_cut[i + 1]],
                      counts[pair_cut[i]: pair_cut[i + 1]]) for i in range(k)
            ]
            none = [None] * k
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(ranges, -1).astype(np.int32)), pa.array(np.full(k + 1, (part << 32) + n, np.int64)),
                 *(pa.array([row[j] for row in sent] + [None], pa.binary()) for j in range(4)),
                 pa.array(none + [b.column(0).to_pylist()], pa.list_(b.column(0).type)),
                 pa.array(none + [held.tolist()], pa.list_(pa.bool_())),
                 pa.array(none + [lengths.tolist()], pa.list_(pa.int32())),
                 pa.array(none + [_squeeze(index)], pa.binary())],
                ["p", "block", "words", "pairs", "contexts", "counts", "ids", "held", "lengths", "index"],
            )

    return docs.mapInArrow(run, _BLOCK.format(kind=kind))


def _merge(rows: pa.Table) -> pa.Table:
    """The training counts of a word range over all blocks."""
    blocks = _packed(rows)
    words = np.unique(np.concatenate([b[0] for b in blocks]))
    keys, counts = [], []
    for own, pairs, contexts, n in blocks:
        seen = n > 0
        keys.append((np.repeat(np.searchsorted(words, own), pairs) << CONTEXT_BITS | contexts)[seen])
        counts.append(n[seen])
    key, index = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, index, np.concatenate(counts))
    used, n = np.unique(key >> CONTEXT_BITS, return_counts=True)
    packed = _pack(words[used], n, key & (1 << CONTEXT_BITS) - 1, total)
    return pa.table({"p": rows["p"][:1].cast(pa.int32())} | {
        name: pa.array([x], pa.binary()) for name, x in zip(("words", "pairs", "contexts", "counts"), packed, strict=True)})


class Totals:
    """Customers and tables of every restaurant: level 2 by previous word, level 1 by its class, level 0 the root."""

    SIZES = (1, 1 << CLASS_BITS, 1 << CONTEXT_BITS)

    def __init__(self) -> None:
        self.customers = [np.zeros(n, np.int64) for n in self.SIZES]
        self.tables = [np.zeros(n, np.int64) for n in self.SIZES]

    def __getstate__(self) -> list[bytes]:
        return [_squeeze(x, "<i8") for x in self.customers + self.tables]

    def __setstate__(self, state: list[bytes]) -> None:
        x = [_expand(b, "<i8") for b in state]
        self.customers, self.tables = x[:3], x[3:]


class Settings:
    """What all tasks need: number of known words, and the totals, discounts and strengths after each sweep.

    The totals of each sweep are a broadcast of their own, so each travels once.
    """

    def __init__(self, n_words: int, n_tokens: int):
        self.n_words, self.n_tokens = n_words, n_tokens
        self.history: list[Totals | Broadcast] = []
        self.discounts: list[list[float]] = []
        self.strengths: list[list[float]] = []

    def totals(self, k: int) -> Totals:
        t = self.history[k]
        return t.value if isinstance(t, Broadcast) else t


class Range:
    """The dishes of a word range in all restaurants, with their tables.

    A dish with one customer in a previous word's restaurant has one table for good, so only the others (``many``) are
    seated anew there.
    """

    def __init__(self, p: int, words: np.ndarray, pairs: np.ndarray, contexts: np.ndarray, counts: np.ndarray):
        self.p, self.words = p, words
        word = np.repeat(np.arange(len(words)), pairs)
        self.key2 = word << CONTEXT_BITS | contexts  # sorted, and so are the keys of its parents
        key1 = self.key2 >> REST_BITS
        first = np.append(True, key1[1:] != key1[:-1]) if len(key1) else np.zeros(0, bool)
        self.key1, self.up2 = key1[first], np.cumsum(first) - 1
        self.up1 = self.key1 >> CLASS_BITS
        self.rest = [np.zeros(len(words), np.int64), self.key1 & (1 << CLASS_BITS) - 1, contexts.astype(np.int64)]
        self.total = np.zeros(len(words), np.int64)
        np.add.at(self.total, word, counts)
        # initial seating: one table for each dish of a restaurant
        self.tables = [np.ones(len(words), np.int64), np.ones(len(self.key1), np.int64), np.ones(len(contexts), np.int64)]
        self.customers = [None, None, counts.astype(np.int64)]
        self.many = np.flatnonzero(self.customers[2] > 1)
        self.single = np.bincount(self.up2[self.customers[2] == 1], minlength=len(self.key1))
        self._send_up(2)
        self._send_up(1)

    def _send_up(self, level: int) -> None:
        if level == 2:
            more = np.bincount(self.up2[self.many], weights=self.tables[2][self.many], minlength=len(self.key1))
            self.customers[1] = self.single + more.astype(np.int64)
        else:
            self.customers[0] = np.bincount(self.up1, weights=self.tables[1], minlength=len(self.words)).astype(np.int64)

    def add_to(self, totals: Totals) -> None:
        for level in range(3):
            np.add.at(totals.customers[level], self.rest[level], self.customers[level])
            np.add.at(totals.tables[level], self.rest[level], self.tables[level])

    def probabilities(self, s: Settings, k: int, levels: int = 3) -> list[np.ndarray]:
        """Predictive probability of each dish at each of the first levels, by the totals after ``k`` sweeps."""
        out, parent = [], np.full(len(self.words), 1 / (s.n_words + 1))
        for level, up in ((0, None), (1, self.up1), (2, self.up2))[:levels]:
            base = parent if up is None else out[-1][up]
            out.append(_predict(s, k, level, self.rest[level], self.customers[level], self.tables[level], base))
        return out

    def sweep(self, s: Settings, number: int) -> None:
        """Reseat every dish, from the previous words' restaurants to the root."""
        r = np.random.default_rng([SEED, self.p, number])
        p0, p1 = self.probabilities(s, number, 2)
        uniform = np.full(len(self.words), 1 / (s.n_words + 1))
        for level, of, base in ((2, self.many, p1[self.up2[self.many]]), (1, slice(None), p0[self.up1]), (0, slice(None), uniform)):
            others = s.totals(number).tables[level][self.rest[level][of]] - self.tables[level][of]
            self.tables[level][of] = seat(
                r, self.customers[level][of], others, base, s.discounts[number][level], s.strengths[number][level])
            if level:
                self._send_up(level)

    def replay(self, s: Settings, sweeps: int) -> Iterator[Range]:
        """The state after each sweep."""
        for k in range(sweeps):
            self.sweep(s, k)
            yield self


def _predict(s: Settings, k: int, level: int, rest: np.ndarray, customers, tables, base: np.ndarray) -> np.ndarray:
    t, d, strength = s.totals(k), s.discounts[k][level], s.strengths[k][level]
    return (customers - d * tables + (strength + d * t.tables[level][rest]) * base) / (strength + t.customers[level][rest])


def seat(r: np.random.Generator, customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float,
         strength: float) -> np.ndarray:
    """Tables of each dish after seating its customers; ``others``: tables of other dishes in its restaurant."""
    order = np.argsort(-customers, kind="stable")
    c, o, q = customers[order], others[order], base[order]
    tables = np.minimum(c, 1).astype(np.int64)
    n = 1
    while True:
        live = int(np.searchsorted(-c, -n, side="left"))  # dishes with more than n customers
        if not live:
            break
        group = 1 if n < SINGLY else n // GROUP
        t = tables[:live]
        new = (strength + discount * (o[:live] + t)) * q[:live]
        p = new / (new + n - discount * t)
        if group == 1:
            t += r.random(live) < p
        else:
            t += r.binomial(np.minimum(c[:live] - n, group), np.clip(p, 0, 1))
        n += group
    out = np.empty_like(tables)
    out[order] = tables
    return out


def _ranges(rows: pa.RecordBatch | pa.Table) -> Iterator[Range]:
    for i in range(rows.num_rows):
        yield Range(rows.column("p")[i].as_py(), *_packed(rows.slice(i, 1))[0])


def _totals(model: DataFrame, s: Settings) -> tuple[Totals, dict[str, int]]:
    """Totals after the next sweep (of the initial seating, if there are none yet), and counts of counts.

    Each task sums up its ranges in one vector of fixed length, which travels and is summed in slices.
    """
    names = [f"{x}{level}" for level in range(3) for x in ("one", "two")] + ["words", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, more = Totals(), np.zeros(len(names), np.int64)
        for batch in batches:
            for own in _ranges(batch):
                for _ in own.replay(s, len(s.history)):
                    pass
                own.add_to(t)
                more += [int((own.customers[level] == n).sum()) for level in range(3) for n in (1, 2)] + [
                    len(own.words), int(own.total.sum())]
        vector = np.concatenate([more, *t.customers, *t.tables])
        used = [lo for lo in range(0, len(vector), SLICE) if vector[lo: lo + SLICE].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array([_squeeze(vector[lo: lo + SLICE], "<i8") for lo in used], pa.binary())],
            ["lo", "sums"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(_expand(x.as_py(), "<i8") for x in rows["sums"])
        return pa.table({"lo": rows["lo"][:1], "sums": pa.array([_squeeze(total, "<i8")], pa.binary())})

    rows = model.mapInArrow(run, "lo long, sums binary").groupBy("lo").applyInArrow(add, "lo long, sums binary").collect()
    vector = np.zeros(len(names) + 2 * sum(Totals.SIZES), np.int64)
    for r in rows:
        x = _expand(bytes(r["sums"]), "<i8")
        vector[r["lo"]: r["lo"] + len(x)] = x
    out, at = Totals(), len(names)
    for kind in (out.customers, out.tables):
        for level, size in enumerate(Totals.SIZES):
            kind[level] = vector[at: at + size].copy()
            at += size
    return out, dict(zip(names, vector.tolist(), strict=False))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, seven steps up; accurate to 1e-7."""
    steps_up = x.copy()
    for i in range(1, 7):
        steps_up = steps_up * (x + i)
    z = x + 7
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) - np.log(steps_up)


def draw_strength(r: np.random.Generator, customers: np.ndarray, tables: np.ndarray, discount: float) -> float:
    """A strength of ``STRENGTHS`` from its posterior, given the customers and tables of a level's restaurants."""
    here = customers > 0
    if not here.any():
        return 1.0
    pairs, n = np.unique(np.stack([customers[here], tables[here]]), axis=1, return_counts=True)
    c, t = pairs.astype(np.float64)
    log_p = np.array([
        n @ (_log_gamma(x / discount + t) - _log_gamma(np.full(len(t), x / discount + 1))
             + _log_gamma(np.full(len(c), x + 1)) - _log_gamma(x + c)) - x / PRIOR_MEAN + np.log(x)
        for x in STRENGTHS
    ])
    p = np.exp(log_p - log_p.max())
    return float(STRENGTHS[r.choice(len(p), p=p / p.sum())])


def train(model: DataFrame, sweeps: int = SWEEPS) -> Settings:
    """Gibbs sweeps over the stored counts."""
    s, r = Settings(0, 0), np.random.default_rng(SEED)
    for _ in range(sweeps + 1):
        t, n = _totals(model, s)
        s.n_words, s.n_tokens = n["words"], n["tokens"]
        discounts = [float(np.clip(n[f"one{k}"] / max(n[f"one{k}"] + 2 * n[f"two{k}"], 1), 0.05, 0.95)) for k in range(3)]
        s.history.append(model.sparkSession.sparkContext.broadcast(t))
        s.discounts.append(discounts)
        s.strengths.append([draw_strength(r, t.customers[k], t.tables[k], discounts[k]) for k in range(3)])
    return s


def _answer(s: Settings, burn_in: int, own: Range | None, rows: pa.Table) -> pa.Table:
    """Mean predictive probability (log10) of each block's pairs, and training counts of its words."""
    blocks = _packed(rows)
    words, pairs, contexts = (np.concatenate([b[j] for b in blocks]) for j in range(3))
    known = own.words if own else np.zeros(0, np.uint64)
    at = np.searchsorted(known, words)
    seen = np.zeros(len(words), bool)
    inside = at < len(known)
    seen[inside] = known[at[inside]] == words[inside]
    at = np.where(seen, at, -1)
    word = np.repeat(at, pairs)
    mean = np.zeros(len(contexts))

    def look(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        i = np.searchsorted(keys, wanted)
        ok = (i < len(keys)) & (wanted >= 0)
        ok[ok] = keys[i[ok]] == wanted[ok]
        return np.where(ok, i, -1)

    if own:
        i1 = look(own.key1, np.where(word >= 0, word << CLASS_BITS | contexts >> REST_BITS, -1))
        i2 = look(own.key2, np.where(word >= 0, word << CONTEXT_BITS | contexts, -1))

    def part(values: np.ndarray, i: np.ndarray) -> np.ndarray:
        return np.where(i >= 0, values[np.maximum(i, 0)], 0) if len(values) else np.zeros(len(i))

    samples = 0
    sweeps = len(s.history) - 1
    for k, state in enumerate(own.replay(s, sweeps) if own else [None] * sweeps, 1):
        if k <= burn_in:
            continue
        p = np.full(len(contexts), 1 / (s.n_words + 1))
        zero = np.zeros(len(contexts))
        for level, rest, i in ((0, zero.astype(np.int64), word), (1, contexts >> REST_BITS, i1 if own else None), (2, contexts, i2 if own else None)):
            c = part(state.customers[level], i) if state else zero
            m = part(state.tables[level], i) if state else zero
            p = _predict(s, k, level, rest, c, m, p)
        mean += p
        samples += 1
    log_p = np.log10(mean / max(samples, 1)).astype(np.float32)
    counts = np.where(seen, own.total[np.maximum(at, 0)], 0) if own and len(known) else np.zeros(len(words), np.int64)
    cut = np.concatenate(([0], np.cumsum([len(b[0]) for b in blocks])))
    pair_cut = np.concatenate(([0], np.cumsum([len(b[2]) for b in blocks])))
    each = range(len(blocks))
    return pa.table({
        "p": rows["p"], "block": rows["block"],
        "scores": pa.array([_squeeze(log_p[pair_cut[i]: pair_cut[i + 1]], "<f4") for i in each], pa.binary()),
        "pairs": pa.array([_squeeze(b[1]) for b in blocks], pa.binary()),
        "counts": pa.array([_squeeze(counts[cut[i]: cut[i + 1]], "<i8") for i in each], pa.binary()),
    })


def score(docs: DataFrame, held_out: Column, id: str = "doc_id", text: str = "text", sweeps: int = SWEEPS,
          burn_in: int = BURN_IN) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of each row; the
    model learns from the rows that are not held out."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id].dataType.simpleString()
    own = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    sent = stored(_blocks(own, kind, 2 * n_partitions(spark)), "lm-blocks")
    asked = sent.where("p >= 0").select("p", "block", "words", "pairs", "contexts", "counts")
    model = stored(asked.groupBy("p").applyInArrow(_merge, _MODEL), "lm-counts")
    settings = train(model, sweeps)

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        own = next(_ranges(left), None)
        if not right.num_rows:
            return _ANSWER.empty_table()
        return _answer(settings, burn_in, own, right)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        s = settings
        left = left.sort_by("p")
        read = lambda c, kind: np.concatenate([_expand(x.as_py(), kind) for x in left[c]])
        scores = read("scores", "<f4").astype(np.float64)
        counts = np.repeat(read("counts", "<i8"), read("pairs", "<i4"))
        base = np.log10((counts + 1) / (s.n_tokens + s.n_words + 1))
        lengths = _list(right["lengths"]).astype(np.int64)
        index = _expand(right["index"][0].as_py())
        ends = np.concatenate(([0], np.cumsum(lengths)))
        total = segment_sums(scores[index], ends)
        return pa.table({
            "id": right["ids"].combine_chunks().flatten(), "held_out": right["held"].combine_chunks().flatten(),
            "n_tokens": pa.array(lengths), "n_known": pa.array(segment_sums((counts > 0)[index].astype(np.int64), ends)),
            "train_tokens": pa.array(np.full(len(lengths), s.n_tokens, np.int64)),
            "base_score": pa.array(segment_sums(base[index], ends)), "score": pa.array(total),
            "perplexity": pa.array(10 ** np.minimum(-total / lengths, 300)),
        })

    answers = model.groupBy("p").cogroup(asked.groupBy("p")).applyInArrow(
        answer, "p int, block long, scores binary, pairs binary, counts binary"
    )
    own_rows = sent.where("p < 0").select("block", "ids", "held", "lengths", "index")
    return answers.groupBy("block").cogroup(own_rows.groupBy("block")).applyInArrow(
        finish, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
        "score double, perplexity double"
    ).withColumnRenamed("id", id)


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity of the training and of the held-out texts."""
    return scored.groupBy("held_out").agg(
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"),
    )
