"""Importance resampling toward a target distribution, with bit-sliced aggregation.

A text's features are its runs of 1 to 3 words, hashed to ``BUCKETS`` buckets.
Each document's bucket counts become 10000-bit planes: bit b of plane j is bit
j of the count of bucket b.  The planes are written once; bucket totals of a
corpus are sums over its planes.  A bucket's gain is a signed integer, kept as
bit planes of its size, one set for each sign.  A document's weight is then
exact integer arithmetic: AND a count plane with a gain plane, count the bits,
and add them times the power of two that both planes stand for.  A seeded
Gumbel score draws documents without replacement.

Only 10,000 totals per corpus come to the driver, and only the gain planes go
to the tasks.  Ranks are running counts over range partitions, so no task sorts
the whole table.  A task holds ``TEXT_BYTES`` of text (or one text) and the
hashes of ``WORDS_AT_ONCE`` words.

Defined cases: null and empty texts have no words, no features and weight 0;
rows that repeat are drawn by themselves, each with its own rank (ties of score
and key fall in any order); a null key is hashed as the empty string; only the
key and the text are read, so other columns, whatever their names, do not
matter; an empty table gives an empty table, and an empty target corpus gives
gains from the smoothing alone.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import sliced, stage_table
from eventlens.operators.ordered import running_sums

BUCKETS = 10_000
MAX_WORDS = 3
TEXT_BYTES = 1 << 20
WORDS_AT_ONCE = 200_000
#: Bytes of a longer word than this go through zlib, one word at a time.
_LOCKSTEP = 48
_PLANE_BYTES = BUCKETS // 8

_byte = np.arange(256, dtype=np.uint8)
_LOWER = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)
_IN_WORD = ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
_CRC = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)


class _Words:
    """Words of many texts in one buffer of lower-cased UTF-8 bytes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        inside = np.concatenate([[False], _IN_WORD[self.data], [False]])
        starts = inside[1:] & ~inside[:-1]
        starts[offsets[:-1][offsets[:-1] < len(data)]] = True  # a word never runs on into the next text
        self.first = np.flatnonzero(starts[:-1] & inside[1:-1])
        gap = np.flatnonzero(~inside[1:])  # places after which no word runs on
        ends = gap[np.searchsorted(gap, self.first)]
        ends[:-1] = np.minimum(ends[:-1], self.first[1:])
        self.size = ends - self.first
        self.text = np.searchsorted(offsets, self.first, side="right") - 1

    def feed(self, state: np.ndarray, lo: int) -> np.ndarray:
        """CRC states after the bytes of words ``lo, lo + 1, ..``, one word for each state."""
        at, size = self.first[lo : lo + len(state)], self.size[lo : lo + len(state)]
        order = np.argsort(-size, kind="stable")
        state, at, size = state[order], at[order], size[order]
        active = np.searchsorted(-size, -np.arange(1, _LOCKSTEP + 1), side="right")
        for p, n in enumerate(active):
            if not n:
                break
            now = state[:n]
            state[:n] = _CRC[(now ^ self.data[at[:n] + p]) & 255] ^ (now >> 8)
        for i in range(int(np.searchsorted(-size, -_LOCKSTEP, side="left"))):
            rest = self.data[at[i] + _LOCKSTEP : at[i] + size[i]].tobytes()
            state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        out = np.empty_like(state)
        out[order] = state
        return out

    def bucket_counts(self, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """``(text * buckets + bucket, count)``, sorted, over all runs of 1 to ``runs`` words."""
        keys, counts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo in range(0, len(self.first), WORDS_AT_ONCE):
            text = self.text[lo : lo + WORDS_AT_ONCE]
            state = np.full(len(text), 0xFFFFFFFF, np.uint32)
            found = []
            for k in range(runs):
                here = min(len(text), len(self.first) - lo - k)
                text, state = text[:here], state[:here]
                if k:
                    state = _CRC[(state ^ np.uint32(32)) & 255] ^ (state >> 8)
                state = self.feed(state, lo + k)
                whole = text == self.text[lo + k : lo + k + here]
                found.append(text[whole] * buckets + (~state[whole]) % np.uint32(buckets))
            k, n = np.unique(np.concatenate(found), return_counts=True)
            keys.append(k)
            counts.append(n)
        key, of = np.unique(np.concatenate(keys), return_inverse=True)
        return key, np.bincount(of, np.concatenate(counts), len(key)).astype(np.int64)


def _planes(key: np.ndarray, count: np.ndarray, n_texts: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes of the texts' counts, one after the other, and how many each text has."""
    text, bucket = np.divmod(key, buckets)
    top = np.zeros(n_texts, np.int64)
    np.maximum.at(top, text, count)
    depth = np.ceil(np.log2(top + 1)).astype(np.int64)
    row0 = np.cumsum(depth) - depth
    bits = np.zeros((int(depth.sum()), buckets), bool)
    for j in range(int(depth.max(initial=0))):
        on = (count >> j) & 1 == 1
        bits[row0[text[on]] + j, bucket[on]] = True
    return np.packbits(bits, axis=1, bitorder="little"), depth


_FEATURES = [T.StructField(n, t) for n, t in (("n_words", T.LongType()), ("n_features", T.LongType()), ("planes", T.ArrayType(T.BinaryType())))]


def count_planes(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``key, n_words, n_features, planes array<binary>``: the bit planes of each text's bucket counts, lowest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text", TEXT_BYTES):
            text = part.column(1).fill_null("").cast(pa.large_binary())
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
            body = text.buffers()[2]
            data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
            words = _Words(data, offsets - offsets[0])
            n = np.bincount(words.text, minlength=len(part)).astype(np.int64)
            n_features = sum(np.maximum(n - k, 0) for k in range(MAX_WORDS))
            planes, depth = _planes(*words.bucket_counts(MAX_WORDS, BUCKETS), len(part), BUCKETS)
            flat = pa.Array.from_buffers(pa.binary(_PLANE_BYTES), len(planes), [None, pa.py_buffer(planes)]).cast(pa.binary())
            upto = pa.array(np.concatenate([[0], np.cumsum(depth)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n), pa.array(n_features), pa.ListArray.from_arrays(upto, flat)],
                [key, "n_words", "n_features", "planes"],
            )

    rows = texts.select(F.col(key), F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], *_FEATURES]))


def _plane_rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A batch's planes as a matrix of bytes, the list that each is of, and its place in it."""
    n = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().cast(pa.binary(_PLANE_BYTES))
    matrix = np.frombuffer(flat.buffers()[1], np.uint8)[flat.offset * _PLANE_BYTES :][: len(flat) * _PLANE_BYTES] if len(flat) else np.empty(0, np.uint8)
    owner = np.repeat(np.arange(len(n)), n)
    return matrix.reshape(-1, _PLANE_BYTES), owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def bucket_totals(planes: DataFrame) -> np.ndarray:
    """Sum of all documents' counts for each bucket, from their planes; ``BUCKETS`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in sliced(batches, "planes", 2_000):
            matrix, _, level = _plane_rows(batch.column(0))
            for j in np.unique(level):
                bits = np.unpackbits(matrix[level == j], axis=1, bitorder="little")
                total += bits.sum(axis=0, dtype=np.int64) << int(j)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    sums = planes.select("planes").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in sums:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of target to source, smoothed by one, in thousandths rounded down."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = [((t + 1) * (s_all + buckets)) / ((s + 1) * (t_all + buckets)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """``(signed power of two, plane)`` for each bit of the gains' sizes, positive and negative ones apart."""
    out = []
    for sign in (1, -1):
        size = np.maximum(gain * sign, 0)
        for j in range(int(size.max(initial=0)).bit_length()):
            out.append((sign << j, np.packbits((size >> j) & 1 == 1, bitorder="little")))
    return out


def _words64(matrix: np.ndarray) -> np.ndarray:
    pad = -matrix.shape[-1] % 8
    return np.pad(matrix, [(0, 0)] * (matrix.ndim - 1) + [(0, pad)]).view(np.uint64)


def weigh(planes: DataFrame, gain: np.ndarray) -> DataFrame:
    """The planes' other columns and ``weight long``: the sum over a document's features of their buckets' gains."""
    shipped = [(power, _words64(plane)) for power, plane in gain_planes(gain)]  # at most 2 x 64 planes of 1,256 bytes
    kept = [c for c in planes.columns if c != "planes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "planes", 10_000):
            matrix, owner, level = _plane_rows(batch.column(len(kept)))
            matrix = _words64(matrix)
            total = np.zeros(len(matrix), np.int64)
            for power, plane in shipped:
                total += power * np.bitwise_count(matrix & plane).sum(axis=1, dtype=np.int64)
            weight = np.zeros(len(batch), np.int64)
            np.add.at(weight, owner, total << level)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(weight)], [*kept, "weight"])

    rows = planes.select(*kept, "planes")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("weight", T.LongType())]))


def resample(
    docs: DataFrame, target: DataFrame, *, key: str = "doc_id", text_col: str = "text", percent: int = 5, min_words: int = 20, seed: int = 42
) -> DataFrame:
    """``key, n_words, n_features, weight, score, rank`` for each row of ``docs``.

    ``target`` has a column ``text_col``.  Of the N rows with at least
    ``min_words`` words, the ``floor(percent * N / 100)`` highest scores have a
    rank from 1 on (ties to the smaller key); the others' rank is null.
    """
    spark = docs.sparkSession
    planes = stage_table(spark, count_planes(docs, key, text_col), "planes")
    wanted = bucket_totals(count_planes(target.select(F.lit(0).alias("__none"), text_col), "__none", text_col))
    weighed = weigh(planes, gains(bucket_totals(planes), wanted))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + gumbel).withColumn("__may", (F.col("n_words") >= min_words).cast("long"))
    # Rows that may be drawn come first, so their running count is their rank.
    ranked = running_sums(scored, [F.desc("__may"), F.desc("score"), F.asc(key)], ["__may"], prefix="__upto")
    n = planes.where(F.col("n_words") >= min_words).count()
    drawn = (F.col("__may") == 1) & (F.col("__upto__may") <= percent * n // 100)
    return ranked.select(key, "n_words", "n_features", "weight", "score", F.when(drawn, F.col("__upto__may")).alias("rank"))
