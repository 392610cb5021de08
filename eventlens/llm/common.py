"""Helpers shared by the operators: table reads, shared-folder tables, batch slicing."""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from eventlens.session import stage_table  # noqa: F401

#: Bytes of text that one step inside a task works on.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _libc() -> ctypes.CDLL | None:
    name = ctypes.util.find_library("c")
    return ctypes.CDLL(name) if name else None


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task and works for other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim is not None:
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], column: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` (text or lists) holds about ``budget`` bytes a piece.

    After the last piece, freed memory goes back to the system.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        size = pc.list_value_length(col) if pa.types.is_list(col.type) else pc.binary_length(col)
        upto = np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            done = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, done + budget, side="right")))
            yield batch.slice(at, end - at)
            at = end
    give_back()


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def union_pairs(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the sets of ``a[i]`` and ``b[i]``; ``parent[i]`` is the least index of i's set, before and after."""
    while a.size:
        pa_, pb = parent[a], parent[b]
        apart = pa_ != pb
        if not apart.any():
            break
        a, b, pa_, pb = a[apart], b[apart], pa_[apart], pb[apart]
        np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent
