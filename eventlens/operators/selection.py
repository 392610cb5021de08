"""Exact order statistics of number columns by histogram refinement.

A double's bits, with the sign folded, order like the numbers.  Each pass counts
the next 16 bits of the values that share the bits fixed so far, for all
columns and ranks at once; after four passes a value is known to the last bit.
A task holds 65,536 counters per open value, whatever the number of rows, and the
driver receives sums of those counters.  Nothing is sorted or shuffled but counters.

Nulls are left out; NaN is greater than all numbers, as in Spark's order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS, _LEVELS = 16, 4


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.uint64)  # one zero, one NaN
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _number(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([raw], np.uint64).view(np.float64)[0])


def _counted(values: DataFrame, level: int, open_: Sequence[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """For each (column place, bits fixed so far): how many values have each next 16 bits."""
    shift, above = np.uint64(64 - _BITS * (level + 1)), np.uint64(64 - _BITS * level) if level else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(open_), 1 << _BITS), np.int64)
        for batch in batches:
            bits = {}
            for i, (place, prefix) in enumerate(open_):
                if place not in bits:
                    bits[place] = _ordered_bits(batch.column(place).drop_null().to_numpy(zero_copy_only=False).astype(np.float64))
                x = bits[place]
                x = x if above is None else x[x >> above == np.uint64(prefix)]
                total[i] += np.bincount(((x >> shift) & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << _BITS)
        i, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[i, b])], ["i", "b", "n"])

    sums = values.mapInArrow(run, "i int, b int, n long").groupBy("i", "b").agg(F.sum("n").alias("n"))
    out = {o: np.zeros(1 << _BITS, np.int64) for o in open_}
    for r in sums.toLocalIterator():  # at most 65,536 rows per open value
        out[open_[r["i"]]][r["b"]] = r["n"]
    return out


def order_statistics(df: DataFrame, fractions: Mapping[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Quantiles per column, interpolated between neighbouring values like ``percentile``; None without values.

    ``df`` is read four times: persist it or read it from a table."""
    columns = list(fractions)
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    first = _counted(values, 0, [(i, 0) for i in range(len(columns))])
    sizes = [int(first[i, 0].sum()) for i in range(len(columns))]
    spots = [[f * (n - 1) for f in fractions[c]] if n else [] for c, n in zip(columns, sizes, strict=True)]
    # rank → (bits fixed so far, rank among the values that share them)
    state = {(i, r): (0, r) for i, s in enumerate(spots) for at in s for r in (math.floor(at), math.ceil(at))}
    for level in range(_LEVELS):
        counts = first if level == 0 else _counted(values, level, sorted({(i, p) for (i, _), (p, _) in state.items()}))
        for (i, rank), (prefix, left) in state.items():
            upto = np.cumsum(counts[i, prefix])
            b = int(np.searchsorted(upto, left, side="right"))
            state[i, rank] = (prefix << _BITS | b, left - int(upto[b - 1] if b else 0))
    at_rank = {k: _number(bits) for k, (bits, _) in state.items()}

    def between(i: int, at: float) -> float:
        low, high = at_rank[i, math.floor(at)], at_rank[i, math.ceil(at)]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    return {c: [between(i, at) for at in spots[i]] or [None] * len(fractions[c]) for i, c in enumerate(columns)}


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: v[0] for c, v in order_statistics(df, {c: (0.5,) for c in columns}).items()} if columns else {}
