"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct ``shingle``-word shingles (its whole word sequence if it has
fewer words). Documents with intersection / union >= ``percent`` / 100 are linked; the
connected components of the links are the groups.

1. Sketch. Each of up to 2t rounds hashes every shingle to a bin and a value: in round
   i < t the bin is drawn, in round t + j it is bin j. A bin keeps the least value of the round
   that filled it; later rounds leave it alone. Rounds stop once all t bins are filled,
   after a few with many shingles (about t ln t divided by their number); after 2t they are
   certainly filled, also for a single shingle. Bins agree with probability equal to the similarity, and their number of
   agreements is concentrated like that of t independent draws.
2. Documents with equal sets (exact copies above all) become one class before anything
   else; only classes go on.
3. Banding. ``BANDS`` bands of ``ROWS`` bins: at similarity 0.8 a pair shares no band with
   probability (1 - 0.8^4)^32 < 5e-8.
4. Verification on the full sets, recomputed from the texts. Instead of all pairs of a
   bucket, each of ``STAR_ROUNDS`` rounds tests the members that are not yet in one component against one
   centre of the bucket (another one each round and bucket). Members that are
   already connected need no further comparison, so no link between components is lost.
5. The rest. Where a bucket still holds several components, the members outside its largest component are
   compared with all its members, block by block, each pair in the first bucket that it
   shares; the largest component's members are not paired with each other nor copied for it. Pairs are compared by longer sketches of ``REST_BINS`` bins of
   which one bit each is kept. By their concentration, a pair at the threshold falls more than
   ``REST_SIGMAS`` standard deviations short once in millions of pairs; whatever does not is
   verified on the full sets. So pairs of merely related texts are not written out.
6. Components by alternating large-star and small-star steps, each stored in the shared folder.

No bucket or component is gathered in one task: buckets are reduced by aggregation with a
partial step, and joins on hot buckets are left to skew splitting.

Edge cases: null and empty texts have an empty set, are linked with nothing and form their
own component. Rows that share an id count as one document with several sets: if their sets are
the least of a class, these classes are one. A null id is never linked, has a null component and is kept. An empty
table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, mix, rolling, ship, steps, stored, translated, window_starts

SHINGLE = 5
PERCENT = 80
BINS = 128
BANDS, ROWS = 32, 4
STAR_ROUNDS = 3
REST_BINS, REST_SIGMAS = 4096, 5
#: Members of a bucket that meet in one step of the rest.
REST_BLOCK = 1024

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(col: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other, and their offsets."""
    w = Words(translated(col, _LOWER))
    n = len(col)
    h = w.hashes()[w.ids] if len(w.ids) else np.zeros(0, np.uint64)
    starts = np.flatnonzero(window_starts(w.offsets, k))
    values, docs = rolling(h, k)[starts], w.doc[starts]
    short = np.flatnonzero((w.lengths > 0) & (w.lengths < k))
    if len(short):  # the whole sequence as one shingle
        whole = np.array([
            mix(np.array([sum(int(x) * pow(int(_ODD), j, 1 << 64) for j, x in enumerate(own)) % (1 << 64) ^ len(own)], np.uint64))[0]
            for own in (h[w.offsets[i]: w.offsets[i + 1]] for i in short)
        ], np.uint64)
        values, docs = np.concatenate((values, whole)), np.concatenate((docs, short))
    order = np.lexsort((values, docs))
    values, docs = values[order], docs[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
    values, docs = values[new], docs[new]
    return values, np.concatenate(([0], np.cumsum(np.bincount(docs, minlength=n)))).astype(np.int64)


def sketches(values: np.ndarray, offsets: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The sketch of each set, a row of ``bins`` values; sets must not be empty."""
    n = len(offsets) - 1
    bits = np.uint64(bins.bit_length() - 1)
    empty = np.iinfo(np.uint64).max
    out = np.full(n * bins, empty, np.uint64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    low = np.uint64((1 << 55) - 1)  # no value is that of an empty bin
    for i in range(2 * bins):
        h = mix(values + np.uint64((i + 1) * int(_ODD) % (1 << 64)))
        at = (h >> (np.uint64(64) - bits)).astype(np.int64) if i < bins else i - bins
        place = doc * bins + at
        free = out[place] == empty  # not filled in an earlier round
        np.minimum.at(out, place[free], h[free] & low)
        if i >= 4 and i % 16:  # further rounds change no filled bin, so the check may wait
            continue
        own = np.unique(doc)
        unfilled = np.zeros(n, bool)
        unfilled[own] = (out.reshape(n, bins)[own] == empty).any(axis=1)
        open_ = unfilled[doc]
        if not open_.any():
            break
        if not open_.all():
            values, doc = values[open_], doc[open_]
    return out.reshape(n, bins)


def band_keys(sketch: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One bucket key per band of each sketch; the band's number is part of the key."""
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(rows):
        key = mix(key * _ODD + parts[:, :, r])
    return key


def _prepare(docs: DataFrame, id: str, text: str, shingle: int, carry: list[str]) -> DataFrame:
    """id, n_shingles, digest of the set (two numbers; null if empty), bucket keys, and the columns to carry as carry_0, ..."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            values, offsets = shingle_sets(b.column(1), shingle)
            n = np.diff(offsets)
            some = np.flatnonzero(n)
            full = np.concatenate(([0], np.cumsum(n[some])))
            keys = band_keys(sketches(values, full)).view(np.int64)
            digests = np.zeros((2, b.num_rows), np.int64)
            if len(some):
                for j, salt in enumerate((1, 2)):
                    digests[j, some] = np.add.reduceat(mix(values ^ mix(np.array([salt], np.uint64))), full[:-1]).view(np.int64)
            none = n == 0
            width = np.zeros(b.num_rows, np.int64)
            width[some] = keys.shape[1]
            ends = np.concatenate(([0], np.cumsum(width))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n), pa.array(digests[0], mask=none), pa.array(digests[1], mask=none),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())), *b.columns[2:]],
                ["id", "n_shingles", "d1", "d2", "bands", *b.schema.names[2:]],
            )

    own = docs.select(id, text, *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)))
    kinds = "".join(f", {f.name} {f.dataType.simpleString()}" for f in own.schema.fields[2:])
    return own.mapInArrow(run, f"id {own.schema[0].dataType.simpleString()}, n_shingles long, d1 long, d2 long, bands array<long>{kinds}")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    rows = (
        pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
        .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
        .select("a", "b", "ta", "tb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            (va, oa), (vb, ob) = (shingle_sets(b.column(i), shingle) for i in (2, 3))
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = va[oa[i]: oa[i + 1]], vb[ob[i]: ob[i + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * common >= percent * (len(x) + len(y) - common)
            yield b.select([0, 1]).filter(pa.array(ok))

    return rows.mapInArrow(run, rows.select("a", "b").schema)


def _bits(texts: DataFrame, shingle: int) -> DataFrame:
    """rep, 32 bits of each of its bucket keys, and one bit of each of ``REST_BINS`` bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            for lo in range(0, b.num_rows, 500):
                own = b.slice(lo, 500)
                sets = shingle_sets(own.column(1), shingle)
                tags = (band_keys(sketches(*sets)) & np.uint64(0xFFFFFFFF)).astype("<u4")
                packed = np.packbits((sketches(*sets, REST_BINS) & np.uint64(1)).astype(np.uint8), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [own.column(0)] + [pa.array([row.tobytes() for row in x], pa.binary()) for x in (tags, packed)],
                    ["rep", "tags", "bits"])

    kind = texts.schema["rep"].dataType.simpleString()
    return texts.select("rep", "text").mapInArrow(run, f"rep {kind}, tags binary, bits binary")


def _close(bits, before, comp, rep, minor, n, left, right, least: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of ``left`` and ``right``, of different components, that may reach the similarity
    and share none of the buckets ``before`` this one. Two ``minor`` members meet on either side; one of the two counts."""
    for lo in range(0, len(left), 32):
        a = left[lo: lo + 32]
        ok = comp[a][:, None] != comp[right][None]
        ok &= ~minor[right][None] | (rep[a][:, None] > rep[right][None])
        # a similarity of p needs sizes within a factor of p
        ok &= (100 * n[a][:, None] >= percent * n[right][None]) & (100 * n[right][None] >= percent * n[a][:, None])
        i, j = np.nonzero(ok)
        i, j = a[i], right[j]
        for band in before.T:
            new = band[i] != band[j]
            i, j = i[new], j[new]
        for k in range(0, len(i), 1 << 14):
            x, y = i[k: k + (1 << 14)], j[k: k + (1 << 14)]
            equal = REST_BINS - np.bitwise_count(bits[x] ^ bits[y]).sum(axis=1, dtype=np.int64)
            yield x[equal >= least], y[equal >= least]


def _rest_cells(members: DataFrame) -> DataFrame:
    """Each bucket's members dealt out to cells (h, i, j); in one of them every pair across components meets.

    Only pairs with a member outside the bucket's largest component are of interest. So these members make up the
    left side of the cells, in blocks i, and all members the right one, in blocks j. A member is copied
    once per block of the other side: a bucket of m members with s outside the largest component gives
    about m * s / REST_BLOCK rows on either side, and m + m / REST_BLOCK * s if s fits one block.
    """
    sizes = members.groupBy("h", "comp").agg(F.count("*").alias("c"))
    blocks = lambda n: F.ceil(n / REST_BLOCK).cast("int")
    mixed = sizes.groupBy("h").agg(
        F.sum("c").alias("m"), F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps")
    ).where("comps > 1").select(
        "h", F.col("top.comp").alias("major"), blocks(F.col("m") - F.col("top.c")).alias("lefts"), blocks(F.col("m")).alias("rights")
    )
    own = members.join(mixed, "h").withColumn("minor", F.col("comp") != F.col("major"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    left = own.where("minor").withColumn("i", mine("lefts")).withColumn("j", each("rights")).withColumn("left", F.lit(True))
    right = own.withColumn("i", each("lefts")).withColumn("j", mine("rights")).withColumn("left", F.lit(False))
    cells = ["h", "i", "j", "left", "minor", "rep", "comp", "n"]
    return left.select(*cells).union(right.select(*cells))


def _rest(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs (a, b) that share a bucket across components and may reach the similarity.

    ``members``: h, rep, n, comp.
    """
    cells = stored(_rest_cells(members), "rest")
    bits = _bits(texts.join(cells.select("rep").distinct(), "rep"), shingle)
    rows = (
        cells.join(bits, "rep").select("h", "i", "j", "left", "minor", "rep", "comp", "n", "tags", "bits")
        .repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "rep")
    )
    share = (1 + percent / 100) / 2  # a bit agrees by chance every other time
    least = int(REST_BINS * share - REST_SIGMAS * (REST_BINS * share * (1 - share)) ** 0.5)

    def group(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        left, minor = (t[c].to_numpy(zero_copy_only=False) for c in ("left", "minor"))
        if not left.any() or left.all():
            return
        rep, comp, n = (t[c].to_numpy() for c in ("rep", "comp", "n"))
        bits = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint64).reshape(len(rep), -1)
        tags = np.frombuffer(b"".join(t["tags"].to_pylist()), "<u4").reshape(len(rep), -1)
        band = int((tags[0] == np.uint32(t["h"][0].as_py() & 0xFFFFFFFF)).argmax())
        for x, y in _close(bits, tags[:, :band], comp, rep, minor, n, np.flatnonzero(left), np.flatnonzero(~left), least, percent):
            yield np.maximum(rep[x], rep[y]), np.minimum(rep[x], rep[y])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
            for a, b in group(t):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in steps(batches):
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            keys = [t[c].to_numpy() for c in ("h", "i", "j")]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            lo = 0
            for hi in cuts.tolist():
                yield from pairs(t.slice(lo, hi - lo).combine_chunks())
                lo = hi
            held = t.slice(lo)  # its group may go on
        if held is not None and held.num_rows:
            yield from pairs(held.combine_chunks())

    return rows.mapInArrow(run, f"a {texts.schema['rep'].dataType.simpleString()}, b {texts.schema['rep'].dataType.simpleString()}")


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (a, b): each node that is not the least of its component, and that least one."""
    edges = stored(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).distinct()
        )
        edges = stored(small, "edges")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
           percent: int = PERCENT, carry: tuple[str, ...] = ()) -> DataFrame:
    """id, n_shingles, component_id (the least id of its group) and kept (id is that least one) for each row,
    and its columns named by ``carry``."""
    ship(docs.sparkSession)
    prepared = stored(_prepare(docs, id, text, shingle, list(carry)), "sketches")
    classes = stored(
        prepared.where("d1 IS NOT NULL AND id IS NOT NULL").groupBy("d1", "d2")
        .agg(F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    rows = classes.select(F.explode("bands").alias("h"), "rep", "n")
    full = rows.groupBy("h").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi").select("h")
    members = stored(rows.join(full, "h").distinct(), "buckets")
    texts = stored(
        docs.select(F.col(id).alias("rep"), F.col(text).alias("text")).where(F.col(id).isNotNull())
        .join(members.select("rep").distinct(), "rep"),
        "texts",
    )

    labels, links, tested = None, None, None
    for turn in range(STAR_ROUNDS + 1):
        now = members.withColumn("comp", F.col("rep"))
        if labels is not None:
            now = members.join(labels.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left").select(
                "h", "rep", "n", F.coalesce("root", "rep").alias("comp"))
        if turn < STAR_ROUNDS:
            order = F.col("rep") if turn == 0 else F.xxhash64("rep", "h", F.lit(turn))
            centres = now.groupBy("h").agg(
                F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                F.min(F.struct(order.alias("o"), "rep", "comp", "n")).alias("c"),
            ).where("lo <> hi").select("h", F.col("c.rep").alias("c_rep"), F.col("c.comp").alias("c_comp"), F.col("c.n").alias("c_n"))
            pairs = (
                now.join(centres, "h").where("comp <> c_comp")
                .where((100 * F.col("n") >= percent * F.col("c_n")) & (100 * F.col("c_n") >= percent * F.col("n")))
                .select(F.greatest("rep", "c_rep").alias("a"), F.least("rep", "c_rep").alias("b")).distinct()
            )
        else:
            pairs = _rest(now, texts, shingle, percent).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if pairs.isEmpty():
            continue
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(_verified(pairs, texts, shingle, percent), "links")
        links = found if labels is None else labels.unionByName(found)
        labels = connected_components(links)

    by_class = classes.select("d1", "d2", "rep")
    if labels is not None:
        by_class = by_class.join(labels.select(F.col("a").alias("rep"), F.col("b").alias("root")), "rep", "left").select(
            "d1", "d2", F.coalesce("root", "rep").alias("component_id"))
    else:
        by_class = by_class.withColumnRenamed("rep", "component_id")
    return (
        prepared.drop("bands").join(by_class, ["d1", "d2"], "left")
        .select(
            F.col("id").alias(id), "n_shingles",
            F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
            *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)),
        )
        .withColumn("kept", F.coalesce(F.col(id) == F.col("component_id"), F.lit(True)))
    )
