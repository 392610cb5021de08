"""Byte-level BPE: encode texts to token ids and ids back to bytes with DuckDB inside each partition.

Encoding cuts a text into the matches of a pre-token pattern.  In a partition
the pre-tokens not met before become token-position rows (one per byte); a
recursive query joins neighbouring rows to the merge table and contracts the
leftmost pair of least rank in every word until no pair is left.  Decoding
joins position rows to the vocabulary and puts the bytes together in order.

Nothing is shuffled: the work is per partition, what a task holds is bounded by
``TEXT_BYTES`` of text and two generations of ``CACHE_WORDS`` known words: when the
younger is full it becomes the older, from which words met again are taken over.  The vocabulary is a fixed file, read on the driver and sent to the
tasks.

Defined cases: a null text is the empty text and gives an empty id list; rows
that repeat give repeated results; only the key columns and the text are read,
so other columns, whatever their names, do not matter.  An id that is not in
the vocabulary raises an error in ``decode``.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import gather_ranges, sliced

CACHE_WORDS = 300_000
#: Rows that one recursive query may pile up; longer words go through the keyed form.
PILE_ROWS = 500_000
LONG_WORD = 1_000
TEXT_BYTES = 1 << 20
DECODE_TOKENS = 500_000

# A word's rows form a chain: nxt and npos are the token and the position that follow.
_RECURSION = """
WITH RECURSIVE t(step, w, pos, id, nxt, npos) AS (
  SELECT 0, w, pos, id, lead(id) OVER o, lead(pos) OVER o FROM init WINDOW o AS (PARTITION BY w ORDER BY pos)
  UNION ALL
  (WITH best AS MATERIALIZED (
     SELECT t.w, min(m.merged::BIGINT * 1048576 + t.pos) AS best
     FROM t JOIN merges m ON m.l = t.id AND m.r = t.nxt GROUP BY t.w),
   pair AS MATERIALIZED (
     SELECT b.w, (b.best // 1048576)::INT AS merged, (b.best % 1048576)::INT AS at, t.npos AS gone
     FROM best b JOIN t ON t.w = b.w AND t.pos = b.best % 1048576),
   step AS MATERIALIZED (
     SELECT p.*, t.nxt AS after, t.npos AS after_pos FROM pair p JOIN t ON t.w = p.w AND t.pos = p.gone)
   SELECT t.step + 1, t.w, t.pos,
          CASE WHEN t.pos = s.at THEN s.merged ELSE t.id END,
          CASE WHEN t.pos = s.at THEN s.after WHEN t.npos = s.at THEN s.merged ELSE t.nxt END,
          CASE WHEN t.pos = s.at THEN s.after_pos ELSE t.npos END
   FROM t JOIN step s ON t.w = s.w WHERE t.pos <> s.gone)
)
SELECT w, list(id ORDER BY pos) AS ids
FROM t JOIN (SELECT w, max(step) AS step FROM t GROUP BY w) USING (w, step) GROUP BY w ORDER BY w
"""

# The same contraction, keeping one row per position (id -1: contracted away) in place of every step's rows.  Where the
# merged token is part of no pair of lower rank (``settled``), its other places would come next, from left to right, so
# one step contracts them all: every second place of a run of neighbouring ones.
_RECURSION_KEYED = """
WITH RECURSIVE t(w, pos, id) USING KEY (w, pos) AS (
  SELECT w, pos, id FROM init
  UNION
  SELECT w, pos, CASE WHEN taken THEN merged ELSE -1 END
  FROM (
    SELECT *, lag(taken, 1, false) OVER (PARTITION BY w ORDER BY pos) AS gone
    FROM (
      SELECT *, least_place AND CASE WHEN settled THEN (n - coalesce(max(n) FILTER (NOT least_place) OVER o, 0)) % 2 = 1
                                     ELSE pos = min(pos) FILTER (least_place) OVER (PARTITION BY w) END AS taken
      FROM (
        SELECT *, coalesce(merged = min(merged) OVER (PARTITION BY w), false) AS least_place
        FROM (SELECT *, lead(id) OVER o AS nxt, row_number() OVER o AS n FROM recurring.t WHERE id >= 0
              WINDOW o AS (PARTITION BY w ORDER BY pos)) p
        LEFT JOIN merges m ON m.l = p.id AND m.r = p.nxt) q
      WINDOW o AS (PARTITION BY w ORDER BY pos)) r) s
  WHERE taken OR gone
)
SELECT w, list(id ORDER BY pos) AS ids FROM t WHERE id >= 0 GROUP BY w ORDER BY w
"""

# One thread reads the ordered rows, so each document's bytes are put together in that order.
_DECODE = """
SELECT d, unhex(string_agg(h, '')) AS bytes
FROM (SELECT p.d, p.pos, coalesce(v.h, error('unknown token id ' || p.id)) AS h
      FROM toks p LEFT JOIN vocab v USING (id) ORDER BY p.pos)
GROUP BY d ORDER BY d
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → id of a rank file (one ``base64 id`` pair a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank) for tok, rank in (line.split() for line in f if line.strip())}


class Codec:
    """DuckDB tables of one vocabulary and the words encoded so far; one per Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "allocator_flush_threshold": "8MB", "temp_directory": ""})
        pairs = [
            (ranks[tok[:i]], ranks[tok[i:]], rank)
            for tok, rank in ranks.items()
            for i in range(1, len(tok))
            if tok[:i] in ranks and tok[i:] in ranks
        ]
        first_use: dict[int, int] = {}
        for left, right, merged in pairs:
            for part in (left, right):
                first_use[part] = min(merged, first_use.get(part, merged))
        columns = [pa.array(c, pa.int32()) for c in zip(*pairs, strict=True)]
        settled = pa.array([first_use.get(merged, merged) >= merged for _, _, merged in pairs])
        merges = pa.table([*columns, settled], ["l", "r", "merged", "settled"])
        vocab = pa.table({"id": pa.array(ranks.values(), pa.int32()), "h": [t.hex() for t in ranks]})
        for name, rows in (("merges", merges), ("vocab", vocab)):
            self.con.register("rows_in", rows)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM rows_in")
            self.con.unregister("rows_in")
        self._start()
        self.older = (self.known, self.tokens, self.starts, self.counts)

    def _start(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens, self.starts, self.counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        self.filled = 0

    def _settle(self) -> None:
        """The lists of arrays as one array each."""
        if len(self.tokens) > 1:
            self.tokens, self.starts, self.counts = ([np.concatenate(x)] for x in (self.tokens, self.starts, self.counts))

    def _take_over(self, words: set[str]) -> set[str]:
        """Learn what the older generation knows of ``words``; the rest."""
        known, tokens, starts, counts = self.older
        if not known:
            return words
        again = [w for w in words if w in known]
        if again:
            at = np.fromiter(map(known.__getitem__, again), np.int64, len(again))
            size = counts[0][at]
            self._learn(tokens[0][gather_ranges(starts[0][at], size)], size, again)
        return words.difference(again)

    def _learn(self, ids: np.ndarray, counts: np.ndarray, words: list[str]) -> None:
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words)), strict=True))
        self.tokens.append(ids)
        self.starts.append(self.filled + np.cumsum(counts) - counts)
        self.counts.append(counts)
        self.filled += len(ids)

    def _contract(self, words: list[bytes], sql: str) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        pos = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        init = pa.table(
            {"w": np.repeat(np.arange(len(words), dtype=np.int32), sizes), "pos": pos.astype(np.int32), "id": self.byte_id[data]}
        )
        self.con.register("init", init)
        out = self.con.sql(sql).to_arrow_table()["ids"].combine_chunks()
        self.con.unregister("init")
        return out.flatten().to_numpy(zero_copy_only=False).astype(np.int32), out.value_lengths().to_numpy().astype(np.int64)

    def learn(self, words: Iterable[str]) -> None:
        """Encode words that are not known yet."""
        whole, parts, long = [], [], []
        for w in words:
            b = w.encode()
            (whole if b in self.ranks else long if len(b) > LONG_WORD else parts).append((w, b))
        if whole:
            self._learn(np.array([self.ranks[b] for _, b in whole], np.int32), np.ones(len(whole), np.int64), [w for w, _ in whole])
        pile = np.cumsum([len(b) * len(b) // 2 for _, b in parts])
        at = 0
        while at < len(parts):
            end = max(at + 1, int(np.searchsorted(pile, (pile[at - 1] if at else 0) + PILE_ROWS, side="right")))
            self._learn(*self._contract([b for _, b in parts[at:end]], _RECURSION), [w for w, _ in parts[at:end]])
            at = end
        for w, b in long:
            self._learn(*self._contract([b], _RECURSION_KEYED), [w])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        pieces = [self.find(t) if t else [] for t in texts]
        flat = list(itertools.chain.from_iterable(pieces))
        fresh = set(flat)
        fresh.difference_update(self.known)
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self._settle()
            self.older = (self.known, self.tokens, self.starts, self.counts)
            self._start()
            fresh = set(flat)
        self.learn(self._take_over(fresh))
        self._settle()
        word = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        counts = self.counts[0][word]
        ids = self.tokens[0][gather_ranges(self.starts[0][word], counts)]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ends = upto[np.cumsum([len(p) for p in pieces])] if pieces else np.empty(0, np.int64)
        return ids, np.diff(ends, prepend=0)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        out = [b""] * len(counts)
        toks = pa.table({"d": np.repeat(np.arange(len(counts), dtype=np.int32), counts), "pos": np.arange(len(ids)), "id": ids})
        self.con.register("toks", toks)
        rows = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("toks")
        for d, b in zip(rows["d"].to_pylist(), rows["bytes"].to_pylist(), strict=True):
            out[d] = b
        return out


_CODECS: dict[tuple, Codec] = {}


def _codec(ranks: dict[bytes, int], pattern: str, key: tuple) -> Codec:
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def _vocabulary(docs: DataFrame, ranks_path: str, pattern: str):
    import os

    ranks = load_ranks(ranks_path)
    return docs.sparkSession.sparkContext.broadcast(ranks), (ranks_path, os.path.getsize(ranks_path), pattern)


def _encoded(codec: Codec, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray]:
    ids, counts = codec.encode(texts.to_pylist())
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())), ids, counts


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
_DECODED = T.StructField("decoded", T.BinaryType())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids array<int>``, one row per row of ``docs``."""
    ranks, key = _vocabulary(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern, key)
        for part in sliced(batches, "__text", TEXT_BYTES):
            lists = _encoded(codec, part.column(part.num_columns - 1))[0]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists], [*part.schema.names[:-1], "ids"])

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], _IDS]))


def decode(tokens: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded binary``, one row per row of ``tokens`` (null ids: no bytes)."""
    ranks, key = _vocabulary(tokens, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern, key)
        for part in sliced(batches, "__ids", DECODE_TOKENS):
            lists = part.column(part.num_columns - 1)
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            out = codec.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), counts)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.binary())], [*part.schema.names[:-1], "decoded"])

    rows = tokens.select(*keep, F.col(ids_col).alias("__ids"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], _DECODED]))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``ids`` and ``decoded``: the texts encoded and the ids decoded in the same task, with one set of tables."""
    ranks, key = _vocabulary(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern, key)
        for part in sliced(batches, "__text", TEXT_BYTES):
            lists, ids, counts = _encoded(codec, part.column(part.num_columns - 1))
            decoded = pa.array(codec.decode(ids, counts), pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, decoded], [*part.schema.names[:-1], "ids", "decoded"])

    rows = docs.select(*keep, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], _IDS, _DECODED]))
