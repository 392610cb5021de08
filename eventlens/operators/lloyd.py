"""KMeans for many models at once: one pass over the points moves the centres of all of them.

A grid of ``k`` values and restarts is fitted together.  In each pass a task
assigns its rows to every moving model's centres in one matrix step and emits
one partial (count, cost, vector sum) per centre; a keyed aggregate adds them,
so the table is read as often as the slowest model needs, not once per model
and iteration.  Models that have converged drop out.

Centres are seeded by distance-weighted draws without a pass per candidate:
each row gets the key ``-log(u) / D^2`` per model, with ``u`` hashed from the row's
key, and the least key of all rows is the draw (a reservoir of one, so every
task sends one row per model).  A centre that loses all its rows moves to the
row that is farthest from its model's centres, found the same way.

The driver holds the centres only: ``sum(ks) x n_init`` vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Rows whose distances to all centres a task works out at a time.
PIECE = 512


@dataclass
class Fit:
    """One fitted model: its centres, the summed squared distances to them and the passes it took."""

    centers: np.ndarray
    cost: float = float("inf")
    passes: int = 0

    @property
    def k(self) -> int:
        return len(self.centers)


def squared_distance(columns: Sequence[str | Column], center: Sequence[float]) -> Column:
    parts = [(F.col(c) if isinstance(c, str) else c) - F.lit(float(x)) for c, x in zip(columns, center, strict=True)]
    return sum((p * p for p in parts[1:]), parts[0] * parts[0])


def nearest(columns: Sequence[str | Column], centers: np.ndarray) -> Column:
    """Index of the nearest centre (the lowest of equals), as an expression over the coordinates' columns."""
    options = [F.struct(squared_distance(columns, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]
    return (F.least(*options) if len(options) > 1 else options[0])["i"]


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The rows in pieces whose distances to all centres stay in a core's cache."""
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            yield from (x[at : at + PIECE] for at in range(0, len(x), PIECE))


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ centers.T) + (centers * centers).sum(axis=1)
    return np.maximum(d, 0.0)


def _uniform(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes: one round of a 64-bit finalizer per salt."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & int(_MASK))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _least_rows(points: DataFrame, models: Sequence[int], key: Callable[[np.ndarray, np.ndarray, int], np.ndarray]) -> dict[int, np.ndarray]:
    """Per model, the row of least finite ``key(row hashes, rows, place of the model)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[float, list[float]]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            h, x = batch.column(0).to_numpy(), _matrix(batch)
            for place, m in enumerate(models):
                keys = key(h, x, place)
                i = int(np.argmin(keys))
                if np.isfinite(keys[i]) and (m not in best or keys[i] < best[m][0]):
                    best[m] = (float(keys[i]), x[i].tolist())
        rows = [(m, *v) for m, v in best.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
            ["model", "key", "x"],
        )

    found = points.select("h", "x").mapInArrow(run, "model int, key double, x array<double>")
    least = found.groupBy("model").agg(F.min(F.struct("key", "x")).alias("b")).collect()  # one row per model
    return {r["model"]: np.array(r["b"]["x"]) for r in least}


def seeds(points: DataFrame, ks: Sequence[int], seed: int) -> list[np.ndarray]:
    """Starting centres for models of the given sizes; one pass per centre, for all models together."""
    chosen: list[list[np.ndarray]] = [[] for _ in ks]
    for step in range(max(ks, default=0)):
        want = [m for m, k in enumerate(ks) if k > step]

        def draw(h: np.ndarray, x: np.ndarray, place: int, step: int = step, want: list[int] = want) -> np.ndarray:
            m = want[place]
            far = _distances(x, np.array(chosen[m])).min(axis=1) if step else np.ones(len(x))
            with np.errstate(divide="ignore"):
                # Distances within rounding of zero are copies of a centre.
                return np.where(far > 1e-12, -np.log(_uniform(h, (seed * 1_000_003 + m) * 1_009 + step)) / far, np.inf)

        drawn = _least_rows(points, want, draw)
        for m in want:  # without a row off the centres, fewer distinct rows than centres: repeat one
            if m in drawn or chosen[m]:
                chosen[m].append(drawn[m] if m in drawn else chosen[m][0])
    return [np.array(c) for c in chosen]


def fit_all(
    points: DataFrame, starts: Sequence[np.ndarray], *, max_iter: int = 300, tol: float = 1e-4
) -> list[Fit]:
    """Lloyd's iteration from each of ``starts``.

    ``points`` has a row hash ``h long`` and ``x array<double>`` (no nulls, one length);
    persist it or read it from a table.  A model stops when its centres' summed squared shift is at most ``tol``.
    """
    fits = [Fit(np.array(s, dtype=np.float64)) for s in starts]
    moving, final = list(range(len(fits))), []
    points = points.select("h", "x")
    while moving or final:
        at = moving + final
        sizes = [fits[m].k for m in at]
        stacked, first = np.concatenate([fits[m].centers for m in at]), np.cumsum([0, *sizes])
        width = stacked.shape[1]

        def run(batches: Iterator[pa.RecordBatch], stacked=stacked, first=first) -> Iterator[pa.RecordBatch]:
            n, cost, sums = np.zeros(len(stacked), np.int64), np.zeros(len(stacked)), np.zeros(stacked.shape)
            for x in _pieces(batches):
                d = _distances(x, stacked)
                for a, b in zip(first[:-1], first[1:]):
                    own = d[:, a:b].argmin(axis=1)
                    member = own == np.arange(b - a)[:, None]
                    n[a:b] += np.bincount(own, minlength=b - a)
                    cost[a:b] += np.bincount(own, weights=d[np.arange(len(x)), a + own], minlength=b - a)
                    sums[a:b] += member.astype(np.float64) @ x
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(n[some]), pa.array(cost[some]), pa.array(sums[some].tolist(), pa.list_(pa.float64()))],
                ["c", "n", "cost", "sums"],
            )

        parts = points.mapInArrow(run, "c int, n long, cost double, sums array<double>").groupBy("c")
        totals = parts.agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
        n, cost, sums = np.zeros(len(stacked), np.int64), np.zeros(len(stacked)), np.zeros(stacked.shape)
        for r in totals.collect():  # one row per centre
            n[r["c"]], cost[r["c"]] = r["n"], r["cost"]
            sums[r["c"]] = [r[f"s{i}"] for i in range(width)]
        lost: dict[int, int] = {}  # model: its first centre without rows
        still, done = [], []
        for m, a, b in zip(at, first[:-1], first[1:]):
            fit = fits[m]
            fit.cost, fit.passes = float(cost[a:b].sum()), fit.passes + 1
            if m in final:
                continue
            empty = n[a:b] == 0
            new = np.where(empty[:, None], fit.centers, sums[a:b] / np.maximum(n[a:b], 1)[:, None])
            shift = float(((new - fit.centers) ** 2).sum())
            fit.centers = new
            if empty.any():
                lost[m] = int(np.argmax(empty))
            (done if (shift <= tol and not empty.any()) or fit.passes >= max_iter else still).append(m)
        if lost:
            homes = [fits[m].centers for m in lost]
            far = _least_rows(points, list(lost), lambda h, x, place, homes=homes: _off(x, homes[place]))
            for m, c in lost.items():
                if m in far:
                    fits[m].centers[c] = far[m]
                elif m in still:  # every row lies on a centre: nothing to move to
                    still.remove(m)
                    done.append(m)
        moving, final = still, done  # a converged model is read once more, for its cost at the final centres
    return fits


def _off(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Keys that are least for the row farthest from its nearest centre."""
    far = _distances(x, centers).min(axis=1)
    return np.where(far > 1e-12, -far, np.inf)


def fit_grid(
    points: DataFrame, ks: Sequence[int], *, n_init: int = 10, seed: int = 42, max_iter: int = 300, tol: float = 1e-4
) -> dict[int, Fit]:
    """For each k, the restart of least cost (the earlier of equals)."""
    sizes = [k for k in ks for _ in range(n_init)]
    fits = fit_all(points, seeds(points, sizes, seed), max_iter=max_iter, tol=tol)
    best: dict[int, Fit] = {}
    for k, fit in zip(sizes, fits, strict=True):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    return best
