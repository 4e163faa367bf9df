"""Quality rules by distribution divergence.

A document is judged by a few counting rules and by how far its histograms of character
classes and of common words lie from those of the languages of the corpus
(Jensen-Shannon distance, base 2, between 0 and 1).

The references are counted over all documents, one per language: the share of each
character class and of each *common word* (a word that makes up at least ``COMMON_SHARE``
of the language's words, hence at most ``1 / COMMON_SHARE`` of them). Languages with less
than ``LANGUAGE_SHARE`` of all words get no words, and with less than that of all
characters as well no reference, so there are at most ``2 / LANGUAGE_SHARE``. That bounds
what is sent to the executors whatever the corpus. A document is compared with every
reference and judged by the nearest. If its own language has no reference (of words), it has no
such distance and is judged by what is left, at least the counting rules, so a rare language
in another script is not measured against the others.

Guards: the character distance counts from ``MIN_CHARS`` characters on, the word
distance from ``MIN_WORDS`` words on. Shorter texts are judged by the counting rules alone.

Edge cases: a null or empty text has no words, fails the rule on the least number of words
and is not kept. A null ``lang`` counts as a language of its own. Repeated rows are judged
each by itself. With no documents there are no references and the result is empty; with
no usable reference the distances are null and only the counting rules judge.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, append_columns, covered, raw, rolling, ship, steps, strings, translated, window_starts

COMMON_SHARE = 0.002
LANGUAGE_SHARE = 0.01
MIN_CHARS = 200
MIN_WORDS = 60
#: Distances above these reject a text.
MAX_CLASS_DISTANCE = 0.35
MAX_WORD_DISTANCE = 0.45
MIN_RULE_WORDS = 10
MAX_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"

CLASSES = ["lower", "upper", "digit", "space", "symbol", "punctuation", "control", "other"]
N_CLASSES = len(CLASSES)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "class_distance double, word_distance double, base_failed boolean, kept boolean"
)


def _class_table() -> np.ndarray:
    """Class of each byte; bytes that continue a character have the class ``N_CLASSES`` (dropped)."""
    t = np.full(256, CLASSES.index("punctuation"), np.uint8)
    t[:32] = t[127] = CLASSES.index("control")
    t[[9, 10, 11, 12, 13, 32]] = CLASSES.index("space")
    t[48:58] = CLASSES.index("digit")
    t[65:91] = CLASSES.index("upper")
    t[97:123] = CLASSES.index("lower")
    t[list(SYMBOLS)] = CLASSES.index("symbol")
    t[128:192] = N_CLASSES
    t[192:] = CLASSES.index("other")
    return t


def class_counts(col: pa.Array) -> np.ndarray:
    """Characters of each class in each text, as a matrix."""
    table = _class_table()
    out = np.zeros((len(col), N_CLASSES), np.int64)
    for i, t in enumerate(raw(col)):
        out[i] = np.bincount(table[np.frombuffer(t, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) between the rows of ``p`` and the row ``q``, all summing to 1."""
    m = (p + q) / 2

    def kl(a):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(a > 0, a * np.log2(a / m), 0).sum(axis=1)

    return np.sqrt(np.clip((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0, 1))


@dataclass
class Reference:
    """Shares of one language: of the character classes, of its common words, and of all other words
    (no shares if the language has too few words)."""

    lang: str
    classes: np.ndarray
    words: dict[str, int]
    shares: np.ndarray


def language_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> list[Reference]:
    """Histograms of each language over all documents."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            langs = pc.fill_null(b.column(1).cast(pa.string()), "").dictionary_encode()
            of = langs.indices.to_numpy(zero_copy_only=False)
            w = Words(translated(b.column(0), _LOWER))
            classes = class_counts(b.column(0))
            for i, name in enumerate(langs.dictionary.to_pylist()):
                n = np.bincount(w.ids[of[w.doc] == i], minlength=len(w.words))
                seen = np.flatnonzero(n)
                totals = classes[of == i].sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * (len(seen) + N_CLASSES)),
                        pa.array([False] * len(seen) + [True] * N_CLASSES),
                        pa.concat_arrays([w.words.take(pa.array(seen)), pa.array(CLASSES)]),
                        pa.array(np.concatenate((n[seen], totals)).astype(np.int64)),
                    ],
                    ["lang", "is_class", "item", "n"],
                )

    counts = (
        docs.select(text, lang)
        .mapInArrow(count, "lang string, is_class boolean, item string, n long")
        .groupBy("lang", "is_class", "item").agg(F.sum("n").alias("n"))
    )
    sizes = {}
    counts = counts.persist()
    try:
        of = counts.groupBy("lang", "is_class").agg(F.sum("n").alias("n"))
        totals = {r["is_class"]: r["n"] for r in of.groupBy("is_class").agg(F.sum("n").alias("n")).collect()}
        share = F.when(F.col("is_class"), LANGUAGE_SHARE * totals.get(True, 0)).otherwise(LANGUAGE_SHARE * totals.get(False, 0))
        # at most 2 / LANGUAGE_SHARE rows
        for r in of.where((F.col("n") > 0) & (F.col("n") >= share)).collect():
            sizes[r["lang"], r["is_class"]] = r["n"]
        langs = sorted({k for k, _ in sizes})
        if not langs:
            return []
        # a language without words has none this common
        least = F.create_map(*[F.lit(x) for k in langs for x in (
            k, COMMON_SHARE * sizes[k, False] if (k, False) in sizes else float("inf"))])
        rows = counts.where(
            F.col("lang").isin(langs) & (F.col("is_class") | (F.col("n") >= least[F.col("lang")]))
        ).collect()
    finally:
        counts.unpersist()
    out = []
    for k in langs:
        cls = {r["item"]: r["n"] for r in rows if r["lang"] == k and r["is_class"]}
        words = sorted((r["item"], r["n"]) for r in rows if r["lang"] == k and not r["is_class"])
        c = np.array([cls.get(x, 0) for x in CLASSES], float)
        s = np.array([n for _, n in words], float) / sizes.get((k, False), 1)
        out.append(Reference(k, c / max(c.sum(), 1), {x: i for i, (x, _) in enumerate(words)},
                             np.append(s, max(0.0, 1 - s.sum())) if (k, False) in sizes else s))
    return out


def base_counts(col: pa.Array) -> dict[str, np.ndarray]:
    """The counts behind the rules, for each text of a batch."""
    texts = raw(col)
    w = Words(col)
    n, lines = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        n[i] = len(t) - len(t.translate(None, SYMBOLS))
        own = [x for x in t.split(b"\n") if x and not x.isspace()]
        lines[i] = len(own) - len(set(own))
    chars = pc.utf8_length(w.words).to_numpy(zero_copy_only=False).astype(np.int64)
    # equal windows of one text: the text's number is mixed into the window's hash
    starts = np.flatnonzero(window_starts(w.offsets, REPEAT_WINDOW))
    h = rolling(w.hashes()[w.ids], REPEAT_WINDOW)[starts] + w.doc[starts].astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return {
        "n_words": w.lengths,
        "word_chars": w.per_doc(chars[w.ids]) if len(w.ids) else w.lengths,
        "n_symbols": n,
        "n_dup_lines": lines,
        "n_repeat_words": w.per_doc(covered(starts[twice], REPEAT_WINDOW, len(w.ids)).astype(np.int64)),
    }


def distances(col: pa.Array, references: list[Reference], langs: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each text to its nearest reference by classes and by common words; NaN where a guard holds
    or the text's language (if ``langs`` are given) has no such reference."""
    n = len(col)
    classes = class_counts(col)
    chars = classes.sum(axis=1)
    w = Words(translated(col, _LOWER))
    by_class, by_word = np.full(n, np.nan), np.full(n, np.nan)
    if not references:
        return by_class, by_word
    shares = classes / np.maximum(chars, 1)[:, None]
    vocabulary = w.words.to_pylist()
    for ref in references:
        by_class = np.fmin(by_class, js_distance(shares, ref.classes))
        size = len(ref.shares)
        if not size:
            continue
        index = np.fromiter((ref.words.get(x, size - 1) for x in vocabulary), np.int64, len(vocabulary))
        hist = np.bincount(w.doc * size + index[w.ids], minlength=n * size).reshape(n, size)
        by_word = np.fmin(by_word, js_distance(hist / np.maximum(w.lengths, 1)[:, None], ref.shares))
    by_class, by_word = np.where(chars >= MIN_CHARS, by_class, np.nan), np.where(w.lengths >= MIN_WORDS, by_word, np.nan)
    if langs is not None:
        names = pc.fill_null(langs.cast(pa.string()), "")
        for out, own in ((by_class, references), (by_word, [r for r in references if len(r.shares)])):
            known = pc.is_in(names, value_set=pa.array([r.lang for r in own], pa.string()))
            out[~known.to_numpy(zero_copy_only=False)] = np.nan
    return by_class, by_word


def judge(docs: DataFrame, text: str = "text", lang: str = "lang",
          references: list[Reference] | None = None) -> DataFrame:
    """``docs`` with the counts, the two distances and the verdict (``COLUMNS``) added."""
    refs = language_references(docs, text, lang) if references is None else references

    def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
        col = strings(b.column(text))
        base = base_counts(col)
        by_class, by_word = distances(col, refs, b.column(lang) if lang in b.schema.names else None)
        n = base["n_words"]
        failed = (n < MIN_RULE_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * n)
        far = (np.nan_to_num(by_class) > MAX_CLASS_DISTANCE) | (np.nan_to_num(by_word) > MAX_WORD_DISTANCE)
        out = {k: pa.array(v.astype(np.int64)) for k, v in base.items()}
        return out | {
            "class_distance": pa.array(by_class, from_pandas=True),
            "word_distance": pa.array(by_word, from_pandas=True),
            "base_failed": pa.array(failed),
            "kept": pa.array(~failed & ~far),
        }

    return append_columns(docs, fn, COLUMNS)
