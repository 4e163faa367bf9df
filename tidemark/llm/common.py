"""Helpers shared by the operators: shipping the package, word splitting, Arrow plumbing."""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED = "_tidemark_shipped"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The package's sources are zipped into the shared folder and added to the application,
    so executors need no installed copy.
    """
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, None):
        return
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.join("tidemark", os.path.relpath(full, _PACKAGE)))
    folder = scratch_path(spark, "package")
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{folder}/tidemark_package.zip")
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    setattr(sc, _SHIPPED, True)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: a cut in the lineage that
    survives lost executors. zstd keeps the files small. ``options`` go to the writer.
    ``session.remove_scratch`` deletes the files at the end of a job."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """Jobs that run inside send Python about ``size`` bytes at once, unless the session says how many.

    The JVM holds a batch (64 MB by default) outside its heap, in buffers that grow by doubling.
    """
    own = spark.conf.get(_BATCH_BYTES, None)
    if own is None:
        spark.conf.set(_BATCH_BYTES, str(size))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(_BATCH_BYTES)


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Text that one step of a Python task works on; an Arrow batch is cut into such pieces.
STEP_BYTES = 8 << 20


def release() -> None:
    """Give freed memory back to the system: a reused Python worker would hold on to its largest step's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def steps(batches: Iterator[pa.RecordBatch], size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Non-empty pieces of the batches of about ``size`` bytes each (a single row may be larger)."""
    for b in batches:
        rows = max(1, int(b.num_rows * size / max(b.nbytes, size)))
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
            release()


def append_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, pa.Array]], ddl: str) -> DataFrame:
    """``df`` with the columns of ``ddl`` added by ``fn``, batch by batch, without a shuffle.

    An input column with the name of an added one is replaced.
    """
    ship(df.sparkSession)
    added = T._parse_datatype_string(ddl)
    names = added.fieldNames()
    kept = [f for f in df.schema.fields if f.name not in names]
    n_kept = {f.name for f in kept}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in steps(batches):
            new = fn(b)
            cols = [b.column(i) for i, n in enumerate(b.schema.names) if n in n_kept]
            yield pa.RecordBatch.from_arrays(
                cols + [new[n] for n in names], [n for n in b.schema.names if n in n_kept] + names
            )

    return df.mapInArrow(run, T.StructType(kept + list(added.fields)))


def strings(col: pa.Array) -> pa.Array:
    """A text column as plain Arrow strings; null becomes empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.string()), "")


def raw(col: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null becomes empty."""
    return strings(col).cast(pa.binary()).to_pylist()


def translated(col: pa.Array, table: bytes) -> pa.Array:
    """Every byte mapped through a 256-byte table (texts keep their lengths)."""
    col = pa.concat_arrays([strings(col)])
    _, offsets, data = col.buffers()
    body = data.to_pybytes().translate(table) if data is not None else b""
    off = np.frombuffer(offsets, np.int32)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int32)
    return pa.StringArray.from_buffers(len(col), pa.py_buffer(off.tobytes()), pa.py_buffer(body))


class Words:
    """The words of a batch of texts, split at ASCII white space.

    ``ids``: for each word its index in ``words`` (distinct, Arrow strings); text ``i`` has
    the words ``offsets[i]`` up to ``offsets[i + 1]``.
    """

    def __init__(self, col: pa.Array):
        col = strings(col)
        lists = pc.ascii_split_whitespace(col)
        enc = lists.flatten().dictionary_encode()
        self.words = enc.dictionary
        ids = enc.indices.to_numpy(zero_copy_only=False)
        off = lists.offsets.to_numpy().astype(np.int64)
        off = off - off[0] if len(off) else np.zeros(1, np.int64)
        empty = pc.index(self.words, "").as_py() if len(self.words) else -1
        if empty >= 0:  # leading, trailing and doubled white space leave empty pieces
            ok = ids != empty
            off = np.concatenate(([0], np.cumsum(ok)))[off]
            ids = ids[ok]
            ids = ids - (ids > empty)
            self.words = pa.concat_arrays([self.words[:empty], self.words[empty + 1:]])
        self.ids, self.offsets = ids, off
        self.lengths = np.diff(off)
        self.doc = np.repeat(np.arange(len(col)), self.lengths)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each distinct word."""
        h = xxhash.xxh3_64_intdigest
        return np.fromiter((h(w) for w in self.words.cast(pa.binary()).to_pylist()), np.uint64, len(self.words))

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over each text."""
        return segment_sums(values, self.offsets)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that any bits of the result may pick a partition."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out *= _BASE
        out += h[i: i + n]
    return mix(out)


def window_starts(offsets: np.ndarray, k: int) -> np.ndarray:
    """True at each word that begins a run of ``k`` words of one text."""
    n = int(offsets[-1])
    ok = np.zeros(n, bool)
    room = np.maximum(np.diff(offsets) - k + 1, 0)
    starts = np.repeat(offsets[:-1], room)
    inner = np.arange(len(starts)) - np.repeat(np.cumsum(room) - room, room)
    ok[starts + inner] = True
    return ok


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """True at each of ``n`` words that lies in a run of ``k`` beginning at one of ``starts``."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, np.minimum(starts + k, n), -1)
    return np.cumsum(d[:n]) > 0


def least_hashed(df: DataFrame, id: str, n_rows: int, size: int) -> DataFrame:
    """The ``size`` rows of ``df`` (of ``n_rows``) with the least hash of their id.

    Rows that can hardly be among them are dropped first, so each task has only a few to offer
    and what meets in the driver does not grow with the number of tasks.
    """
    share = min(1.0, (2 * size + 50) / max(n_rows, 1))
    at = F.pmod(F.xxhash64(id), F.lit(1 << 30))
    return df.where(at < int(share * (1 << 30))).orderBy(at, F.xxhash64(id), id).limit(size) if share < 1 else (
        df.orderBy(at, F.xxhash64(id), id).limit(size))


def crc32_mod(col, m: int):
    """Spark column: crc32 of an id written as text, modulo ``m`` (null id: null)."""
    return F.crc32(col.cast("string").cast("binary")) % m
