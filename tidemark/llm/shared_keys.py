"""Which keys occur in more than one document, answered block by block.

A task works on blocks of documents. For each block it sends the distinct 64-bit keys
found there, each once with the least and largest document id that has it in the block, dealt
out by key range. The receiver of a range merges the blocks and answers each block, in the
order of its request, with the least document id overall (or none if only one document has
the key) and the number of blocks that have the key. Since a block sends a key once, a key
in a third of all documents is a small matter for its receiver.

What a block needs to use the answers travels beside the requests as a payload of number arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

REQUEST = "p int, block long, keys array<long>, lo array<long>, hi array<long>, payload array<array<long>>"
_ANSWER = "p int, block long, owners array<long>, blocks array<int>, payload array<array<long>>"
#: Stands for "no other document".
NONE = np.iinfo(np.int64).min


def request(block: int, parts: int, keys: np.ndarray, docs: np.ndarray, payload: list[np.ndarray]) -> pa.RecordBatch:
    """The rows that a block sends for ``keys`` of ``docs``.

    ``payload`` gets the place of each key's answer as its last array.
    """
    unique, index = np.unique(keys, return_inverse=True)
    lo = np.full(len(unique), np.iinfo(np.int64).max)
    hi = np.full(len(unique), np.iinfo(np.int64).min)
    np.minimum.at(lo, index, docs)
    np.maximum.at(hi, index, docs)
    part = ((unique >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    used = np.unique(part)
    ends = np.searchsorted(part, used, side="right").astype(np.int32)
    cuts = pa.array(np.concatenate(([0], ends, ends[-1:] if len(ends) else [0])).astype(np.int32))
    data = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (unique.view(np.int64), lo, hi)]
    n = len(used)
    arrays = [np.asarray(a, np.int64) for a in (*payload, index)]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, block % parts).astype(np.int32)), pa.array(np.full(n + 1, block, np.int64)), *data,
         pa.array([None] * n + [arrays], pa.list_(pa.list_(pa.int64())))],
        ["p", "block", "keys", "lo", "hi", "payload"],
    )


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def _serve(rows: pa.Table) -> pa.Table:
    keys, lo, hi = (_numbers(rows[c]) for c in ("keys", "lo", "hi"))
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    at = np.flatnonzero(new)
    owner, blocks = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int32)
    if len(keys):
        least, most = np.minimum.reduceat(lo[order], at), np.maximum.reduceat(hi[order], at)
        group = np.cumsum(new) - 1
        owner[order] = np.where(least != most, least, NONE)[group]
        blocks[order] = np.diff(np.append(at, len(keys)))[group]
    lists = rows["keys"].combine_chunks()
    ends = pa.array(np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int32))
    return pa.table({
        "p": rows["p"], "block": rows["block"], "owners": pa.ListArray.from_arrays(ends, pa.array(owner)),
        "blocks": pa.ListArray.from_arrays(ends, pa.array(blocks)), "payload": rows["payload"],
    })


def answered(requests: DataFrame, use: Callable[[list[np.ndarray], np.ndarray, np.ndarray], pa.RecordBatch],
             ddl: str) -> DataFrame:
    """``use(payload, owners, blocks)`` of every block, its answers in the order of its sent keys."""

    def collect(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("p")  # ranges in order: the order of the sorted keys
        given = [x for x in rows["payload"].combine_chunks() if x.is_valid]
        payload = [x.values.to_numpy(zero_copy_only=False) for x in given[0]]
        return pa.Table.from_batches([use(payload, _numbers(rows["owners"]), _numbers(rows["blocks"]))])

    return requests.groupBy("p").applyInArrow(_serve, _ANSWER).groupBy("block").applyInArrow(collect, ddl)
