"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on texts labelled good and one on texts
labelled bad. A text is compressed with each and with none. The compressed sizes, and
above all the normalised difference between the two, go through a logistic function fitted on other
labelled texts (weighted back to the classes' true shares, so the score is calibrated).

Training reads a bounded sample of labelled rows: for each class the ``sample`` rows
with the smallest hash of their id build the dictionary, the next ``sample`` rows
fit the score; a text longer than ``max_chars`` is passed over. That is at most ``4 * sample *
max_chars`` characters on the driver. Scoring is one pass without a shuffle over whole texts.

Edge cases: a null or empty text is scored as an empty one. Repeated label rows of a document
count once; if they disagree, the document counts as bad. Null labels and null ids are passed over. If one
class has no usable row, every text gets the same score: the share of good rows among the labels
(0.5 without labels). A class too small for the dictionary trainer (or for a second part to fit on) uses its
texts themselves as the dictionary (and fits on the same rows).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, least_hashed, raw

SAMPLE = 1500
MAX_CHARS = 20_000
DICT_BYTES = 112_640
LEVEL = 3
#: Added to a text's length when sizes are normalised, so very short texts stay in range.
SMOOTH = 64


@dataclass
class Model:
    """Dictionaries and fitted weights; ``good`` is None if every text gets ``prior``."""

    prior: float
    good: bytes | None = None
    bad: bytes | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None


def _dictionary(texts: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[-size:]


class _Sizes:
    """Compressed sizes of a text under the two dictionaries and without one, as features."""

    def __init__(self, good: bytes, bad: bytes):
        def compressor(d: bytes | None) -> zstandard.ZstdCompressor:
            extra = {} if d is None else {"dict_data": zstandard.ZstdCompressionDict(d)}
            return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, **extra)

        self.each = [compressor(d) for d in (good, bad, None)]

    def __call__(self, text: bytes) -> list[float]:
        g, b, p = (len(c.compress(text)) for c in self.each)
        n = len(text) + SMOOTH
        return [(b - g) / max(g, b), (b - g) / n, g / n, b / n, p / n]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-3 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality",
          sample: int = SAMPLE, max_chars: int = MAX_CHARS) -> Model:
    """Fit on ``labels`` (id, 0/1) joined to the texts of ``docs``."""
    labels = (
        labels.select(F.col(id).alias("id"), F.col(label).alias("y")).where(F.col("id").isNotNull() & F.col("y").isin(0, 1))
        .groupBy("id").agg(F.min("y").alias("y"))
    )
    counts = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    prior = counts.get(1, 0) / n if n else 0.5
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("t")).where(
        F.length("t").between(1, max_chars)
    )
    parts = {}
    for y in (0, 1):
        # at most 2 * sample ids: small enough to broadcast
        usable = labels.where(F.col("y") == y).join(texts.select("id"), "id", "left_semi")
        picked = least_hashed(usable, "id", counts.get(y, 0), 2 * sample)
        rows = texts.join(F.broadcast(picked), "id").groupBy("id").agg(F.min("t").alias("t")).collect()
        parts[y] = [r["t"].encode() for r in sorted(rows, key=lambda r: xxhash.xxh64_intdigest(str(r["id"])))]
    if not parts[0] or not parts[1]:
        return Model(prior)
    built, fitted = {}, {}
    for y, own in parts.items():
        half = min(sample, (len(own) + 1) // 2) if len(own) >= 20 else len(own)
        built[y], fitted[y] = own[:half], own[half:] or own
    good, bad = _dictionary(built[1], DICT_BYTES), _dictionary(built[0], DICT_BYTES)
    sizes = _Sizes(good, bad)
    x = np.array([sizes(t) for y in (0, 1) for t in fitted[y]])
    y = np.repeat([0, 1], [len(fitted[0]), len(fitted[1])])
    share = np.where(y == 1, prior / len(fitted[1]), (1 - prior) / len(fitted[0])) * len(y)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(prior, good, bad, mean, scale, _fit((x - mean) / scale, y, share))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) and ``predicted`` (score >= threshold) added."""

    def fn(b: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = raw(b.column(text))
        if model.good is None:
            s = np.full(len(texts), model.prior)
        else:
            sizes = _Sizes(model.good, model.bad)
            x = (np.array([sizes(t) for t in texts]) - model.mean) / model.scale
            z = np.c_[x, np.ones(len(x))] @ model.weights
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return {"score": pa.array(s), "predicted": pa.array((s >= threshold).astype(np.int32))}

    return append_columns(docs, fn, "score double, predicted int")
