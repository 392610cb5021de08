"""Token-id output: best-fit-decreasing packing into fixed rows.

A document's ids are cut into pieces of ``width`` ids, so nothing is lost; full
pieces are rows of their own, and the last pieces are packed longest first, each
into the fullest row that still has room.  A segment tree over free capacities finds
that row.  A row comes with its padded id vector, the cumulative segment
lengths (0 first) and position numbers that start anew with each segment, as
little-endian arrays; ``matrices`` stacks rows into ``.npy`` matrices.

Packing is per input partition, in shards of ``SHARD_IDS`` ids: no shuffle, and
a task that is run again makes the same rows.  Defined cases: documents
without ids (null, empty) have no segment; repeated rows give repeated segments;
only the id column and the ids are read; an empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import gather_ranges, sliced

WIDTH = 2_048
SHARD_IDS = 2_000_000


class FreeRows:
    """Rows by free capacity; the tree counts rows below each node."""

    def __init__(self, width: int):
        self.size = 1 << max(width, 1).bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.tree[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the least capacity that is at least ``need``; the row leaves the tree."""
        tree, node = self.tree, need + self.size
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not tree[node]:
                    node += 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: np.ndarray, width: int) -> np.ndarray:
    """Row of every piece; rows are numbered as they are opened."""
    out = np.empty(len(sizes), np.int64)
    free, opened = FreeRows(width), 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[k])
        found = free.take(need)
        if found is None:
            found = (width, opened)
            opened += 1
        out[k] = found[1]
        if found[0] > need:
            free.add(found[0] - need, found[1])
    return out


def pack_shard(doc: list, ids: np.ndarray, counts: np.ndarray, width: int, pad: int, dtype: str) -> dict[str, list]:
    """Columns of the packed rows of one shard; ``ids`` of the documents lie one after the other."""
    counts = counts.astype(np.int64)
    pieces = -(-counts // width)
    owner = np.repeat(np.arange(len(counts)), pieces)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (np.cumsum(counts) - counts)[owner] + part * width
    size = np.minimum(width, counts[owner] - part * width)
    row = np.empty(len(owner), np.int64)
    whole = size == width
    row[whole] = np.arange(whole.sum())
    row[~whole] = whole.sum() + best_fit_decreasing(size[~whole], width)
    order = np.argsort(row, kind="stable")
    owner, part, first, size, row = owner[order], part[order], first[order], size[order], row[order]
    n = int(row[-1]) + 1 if len(row) else 0
    cut = np.searchsorted(row, np.arange(n + 1))
    inside = np.cumsum(size) - size
    place = inside - inside[cut[row]] if n else inside
    matrix, positions = np.full((n, width), pad, dtype), np.zeros((n, width), "<u4")
    at = gather_ranges(row * width + place, size)
    matrix.reshape(-1)[at] = ids[gather_ranges(first, size)]
    positions.reshape(-1)[at] = gather_ranges(np.zeros(len(size), np.int64), size)
    out: dict[str, list] = {c: [] for c in ("docs", "pieces", "cu_seqlens", "ids", "positions")}
    for r in range(n):
        a, b = cut[r], cut[r + 1]
        out["docs"].append([doc[k] for k in owner[a:b]])
        out["pieces"].append(part[a:b].tolist())
        out["cu_seqlens"].append([0, *np.cumsum(size[a:b]).tolist()])
        out["ids"].append(matrix[r].tobytes())
        out["positions"].append(positions[r].tobytes())
    return out


def pack(tokens: DataFrame, width: int = WIDTH, pad: int = 0, dtype: str = "<u4", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Packed rows of ``tokens (id_col, ids_col array<int>)``.

    Columns: ``row_id`` (partition and number in it), ``doc_ids, pieces,
    cu_seqlens`` arrays, ``ids`` and ``positions`` binary of ``width`` values
    (``dtype`` and ``<u4``).
    """
    rows = tokens.select(id_col, F.col(ids_col).alias("__ids"))
    id_kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        for part in sliced(batches, "__ids", SHARD_IDS):
            lists = part.column(1)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            out = pack_shard(part.column(0).to_pylist(), lists.flatten().to_numpy(zero_copy_only=False), counts, width, pad, dtype)
            n = len(out["ids"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(at, at + n), pa.int64()),
                    pa.array(out["docs"], pa.list_(part.schema.field(0).type)),
                    pa.array(out["pieces"], pa.list_(pa.int32())),
                    pa.array(out["cu_seqlens"], pa.list_(pa.int32())),
                    pa.array(out["ids"], pa.binary()),
                    pa.array(out["positions"], pa.binary()),
                ],
                ["row_id", "doc_ids", "pieces", "cu_seqlens", "ids", "positions"],
            )
            at += n

    return rows.mapInArrow(
        run, f"row_id long, doc_ids array<{id_kind}>, pieces array<int>, cu_seqlens array<int>, ids binary, positions binary"
    )


def token_ids(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids`` with the tiktoken library (this operator packs ids, whoever made them)."""
    from eventlens.llm.bpe import load_ranks

    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    rows = docs.select(id_col, F.col(text_col).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for part in sliced(batches, "__text"):
            ids = [encoder.encode_to_numpy(t, disallowed_special=()) if t else np.empty(0, np.uint32) for t in part.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], [id_col, "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {rows.schema[0].dataType.simpleString()}, ids array<int>")


def matrices(packed: DataFrame, width: int = WIDTH, dtype: str = "<u4", rows: int = 512) -> DataFrame:
    """Up to ``rows`` packed rows as one record: ``first_row, n_rows`` and ``.npy`` files ``ids, positions, cu_seqlens`` (-1 fills)."""

    def npy(a: np.ndarray) -> bytes:
        f = io.BytesIO()
        np.save(f, a, allow_pickle=False)
        return f.getvalue()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids, positions = (
                    np.frombuffer(b"".join(part.column(k).to_pylist()), t).reshape(-1, width) for k, t in ((1, dtype), (2, "<u4"))
                )
                lengths = part.column(3).to_pylist()
                cu = np.full((len(lengths), max(map(len, lengths))), -1, np.int32)
                for k, x in enumerate(lengths):
                    cu[k, : len(x)] = x
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(0, 1), pa.array([len(lengths)]), *(pa.array([npy(x)], pa.binary()) for x in (ids, positions, cu))],
                    ["first_row", "n_rows", "ids", "positions", "cu_seqlens"],
                )

    return packed.select("row_id", "ids", "positions", "cu_seqlens").mapInArrow(
        run, "first_row long, n_rows long, ids binary, positions binary, cu_seqlens binary"
    )
