"""Verbatim repeats of ``length`` bytes or more across a corpus, with two-stage suffix sorting.

A byte goes if it lies in a ``length``-byte window that also starts earlier
(smaller doc_id, or same document and earlier start); all windows are judged on
the input.

1. Every window is given to an anchor: the leftmost of the least hashes of its
   ``GRAM``-byte grams.  The anchor depends on the window's bytes alone, so equal
   windows have equal anchors; windows in a row that share an anchor make a
   segment.  Segments are dealt by the anchor's hash.
2. Segments that are equal as a whole (anchor hash and XXH3 of the bytes) need no
   sorting: the earliest stays, the others go.  Each task does that for its own
   documents before the shuffle, so a group of copies sends one row per slice.
3. Anchors with different segments are sorted: their strings are put together
   and a suffix array is built in two stages.  Only suffixes smaller than
   their successor are sorted directly; the others are induced by scanning the
   buckets in order.  Neighbours with a common prefix of ``length`` are equal
   windows; all but the earliest go.
4. Anchors with more than ``CROWD`` different segments (a short common phrase in very
   many contexts) would make one task long.  Their segments are parted again by
   anchors of longer grams and go through 2 and 3, until none is crowded or the
   gram is a byte shorter than a window: few strings can have that in common.
5. Removed ranges meet their documents by a join on doc_id.

Tasks hold slices of ``SLICE`` bytes or chunks of ``CHUNK`` bytes of strings of anchors
(at most ``CROWD`` segments beyond, or those around one gram of all but one byte).  Defined cases: a null text has no bytes;
texts shorter than ``length`` keep all; a null doc_id is the smallest; rows that
share a doc_id count as one document, and equal places in them as one place,
so repeated rows give equal results; other columns do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.llm.common import sliced, stage_table

GRAM = 40
SLICE = 1 << 20
CHUNK = 2 << 20
CROWD = 4_000
_POS_BITS = 24
_PIECE = 1 << 23
_NO_ID = -(1 << 63)
_PLACE = 10  # bits of a place that hold the bytes beyond one window
_BASE = np.uint64(0x9E3779B97F4A7C15)


# --- segments ----------------------------------------------------------------

def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size``-byte gram, put together from grams of powers of two."""
    with np.errstate(over="ignore"):
        power, part, done, out = _BASE, data.astype(np.uint64) + np.uint64(1), 1, None
        widths = size
        while widths:
            if widths & 1:
                if out is None:
                    out, have = part, done
                else:  # the gram so far stands to the right of this part
                    n = len(data) - have - done + 1
                    out = part[:n] * _power(have) + out[done : done + n]
                    have += done
            widths >>= 1
            if widths:
                n = len(part) - done
                part = part[:n] * power + part[done : done + n]
                done, power = done * 2, power * power
        out = (out ^ (out >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return out ^ (out >> np.uint64(29))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def least_of(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    return np.minimum(keys[: len(keys) - (width - done)], keys[width - done :])


def segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash) of all segments of texts that lie one after the other and end at ``ends``."""
    none = np.empty(0, np.int64)
    if len(data) < length:
        return none, none, none
    grams = gram_hashes(data, gram)
    mask = np.uint64((1 << _POS_BITS) - 1)
    keys = (grams & ~mask) | np.arange(len(grams), dtype=np.uint64)
    anchor = (least_of(keys, length - gram + 1) & mask).astype(np.int64)
    own_end = ends[np.searchsorted(ends, np.arange(len(anchor)), side="right")]
    inside = np.arange(len(anchor)) + length <= own_end
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | ~inside[:-1]]) & inside
    first = np.flatnonzero(fresh)
    if not len(first):
        return none, none, none
    stop = np.flatnonzero(inside & ~np.concatenate([inside[1:] & ~fresh[1:], [False]]))
    return first, stop - first + 1, grams[anchor[first]].view(np.int64)


def _pieces(part: pa.RecordBatch, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(doc, offset, bytes); very long texts come in pieces that overlap by one window less a byte."""
    for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
        raw = text.encode() if text else b""
        for at in range(0, max(len(raw) - length + 1, 0), _PIECE):
            yield doc, at, raw[at : at + _PIECE + length - 1]


def _groups(pieces: Iterable[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, bytes]]]:
    held, size = [], 0
    for p in pieces:
        if held and size + len(p[2]) > _PIECE:
            yield held
            held, size = [], 0
        held.append(p)
        size += len(p[2])
    if held:
        yield held


_ROWS = "key long, h long, doc long, place long"


def _row_batch(key, h, doc, place) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (key, h, doc, place)], ["key", "h", "doc", "place"])


def _segment_rows(docs: DataFrame, length: int) -> DataFrame:
    """A row per segment, without those that equal an earlier one of the same slice.

    ``place`` packs the start and the bytes beyond one window.  What is gone
    already comes as rows whose place is negative (-1 - start; ``h`` is the end).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for part in sliced(batches, "text", SLICE):
            for group in _groups(_pieces(part, length)):
                raw = b"".join(p[2] for p in group)
                ends = np.cumsum([len(p[2]) for p in group])
                first, count, key = segments(np.frombuffer(raw, np.uint8), ends, length)
                if not len(first):
                    continue
                size = count + length - 1
                h = np.array([digest(raw[a : a + n]) for a, n in zip(first.tolist(), size.tolist(), strict=True)], np.uint64).view(np.int64)
                of = np.searchsorted(ends, first, side="right")
                doc = np.array([p[0] for p in group], np.int64)[of]
                start = first - np.concatenate([[0], ends[:-1]])[of] + np.array([p[1] for p in group], np.int64)[of]
                place = (start << _PLACE) | (size - length)
                order = np.lexsort((place, doc, h, key))
                key, h, doc, place = key[order], h[order], doc[order], place[order]
                again = np.concatenate([[False], (key[1:] == key[:-1]) & (h[1:] == h[:-1])])
                yield _row_batch(key[~again], h[~again], doc[~again], place[~again])
                gone = _gone(key, h, doc, place, length)
                if len(gone[0]):
                    yield _row_batch(gone[0] * 0x9E3779B1 + gone[1], gone[2], gone[0], -1 - gone[1])

    return docs.mapInArrow(run, _ROWS)


def _gone(key, h, doc, place, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of all but the first of each run of equal (key, h), in merged ranges; rows are sorted."""
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    drop = (doc != doc[lead]) | (place != place[lead])
    start = place[drop] >> _PLACE
    return merged(doc[drop], start, start + length + (place[drop] & ((1 << _PLACE) - 1)))


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges with those of one document that touch or overlap put together, sorted."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    shift = number * (int(end.max()) + 2)  # documents apart, so that one running maximum serves all
    reach = np.maximum.accumulate(end + shift)
    head = np.concatenate([[True], start[1:] + shift[1:] > reach[:-1]])
    at = np.flatnonzero(head)
    return doc[at], start[at], np.maximum.reduceat(end, at)


# --- equal segments ------------------------------------------------------------

_FOUND = "key long, doc long, first long, last long"


def _found_batch(key, doc, first, last) -> pa.RecordBatch:
    keys = pa.nulls(len(doc), pa.int64()) if key is None else pa.array(key, pa.int64())
    return pa.RecordBatch.from_arrays([keys, *(pa.array(x, pa.int64()) for x in (doc, first, last))], ["key", "doc", "first", "last"])


def _settle(rows: DataFrame, length: int) -> DataFrame:
    """Ranges that go (``key`` null) and the earliest of each distinct segment of anchors that have several.

    Tasks stream rows sorted by (key, h, doc, place) and hold one row of state, so a
    group may be of any size.
    """
    low = (1 << _PLACE) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last run's first row, and whether its anchor had another segment before it
        for batch in batches:
            if not batch.num_rows:
                continue
            key, h, doc, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            ready = place < 0
            if ready.any():
                yield _found_batch(None, *merged(doc[ready], -1 - place[ready], h[ready]))
                key, h, doc, place = key[~ready], h[~ready], doc[~ready], place[~ready]
            if not len(key):
                continue
            if held is not None:
                key, h, doc, place = (np.concatenate([[x], y]) for x, y in zip(held[:4], (key, h, doc, place), strict=True))
            gone = _gone(key, h, doc, place, length)
            if len(gone[0]):
                yield _found_batch(None, *gone)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (h[1:] != h[:-1])])
            lead = np.flatnonzero(new)
            k = key[lead]
            before = np.concatenate([[False if held is None else held[4]], k[1:] == k[:-1]])
            mixed = before.copy()
            mixed[:-1] |= before[1:]
            done = held is not None and held[4]  # the held row has gone out already
            out = lead[:-1][mixed[:-1]]
            if done and len(out) and out[0] == 0:
                out = out[1:]
            last = lead[-1]
            if len(lead) == 1 and done:
                held = (key[last], h[last], doc[last], place[last], True)
            elif before[-1]:  # known to be mixed: send it now
                out = np.append(out, last)
                held = (key[last], h[last], doc[last], place[last], True)
            else:
                held = (key[last], h[last], doc[last], place[last], False)
            if len(out):
                start = place[out] >> _PLACE
                yield _found_batch(key[out], doc[out], start, start + length + (place[out] & low))

    dealt = rows.repartition("key").sortWithinPartitions("key", "h", "doc", "place")
    return dealt.mapInArrow(run, _FOUND)


# --- two-stage suffix sorting ----------------------------------------------------

def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number (zeros beyond the end)."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out |= padded[k : k + len(text)].astype(np.uint64) << np.uint64(56 - 8 * k)
    return out


def _sort_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by their first ``depth`` bytes, eight bytes a round, only ties going on."""
    order = places[np.argsort(words[places], kind="stable")]
    w = words[order]
    group = np.cumsum(np.concatenate([[0], w[1:] != w[:-1]]))
    for at in range(8, depth, 8):
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not tied.size:
            break
        sub = order[tied]
        more = words[np.minimum(sub + at, len(words) - 1)]
        resort = np.lexsort((more, group[tied]))
        order[tied] = sub[resort]
        g, m = group[tied], more[resort]  # groups keep their places, so g is sorted
        split = np.zeros(len(order), bool)
        split[tied[1:]] = (g[1:] == g[:-1]) & (m[1:] != m[:-1])
        group = group + np.cumsum(split)
    return order


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes sorted by their first ``depth`` bytes; ``text`` ends with its only kind of zero byte.

    Stage one sorts the suffixes smaller than their successors.  Stage two goes
    through the buckets of first bytes in order; a suffix that is larger than
    its successor is entered, when that successor is met, at the front part
    of its own bucket.
    """
    n = len(text)
    if n < 2:
        return np.arange(n)
    step = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    turn = np.where(step != 0, np.arange(n - 1), n)
    next_turn = np.minimum.accumulate(turn[::-1])[::-1]
    smaller = np.ones(n, bool)
    known = next_turn < n
    smaller[:-1][known] = step[next_turn[known]] > 0
    direct = _sort_directly(np.flatnonzero(smaller), words, depth)
    cuts = np.searchsorted(text[direct], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        scan = []
        wave = np.concatenate(fronts[c]) if fronts[c] else np.empty(0, np.int64)
        while wave.size:  # a run of one byte enters its own bucket
            scan.append(wave)
            back = wave[wave > 0] - 1
            wave = back[text[back] == c]
        scan.append(direct[cuts[c] : cuts[c + 1]])
        bucket = np.concatenate(scan)
        out.append(bucket)
        back = bucket[bucket > 0] - 1
        back = back[text[back] > c]
        if back.size:
            first = text[back]
            back = back[np.argsort(first, kind="stable")]
            values, starts = np.unique(text[back], return_index=True)
            for value, rows in zip(values.tolist(), np.split(back, starts[1:]), strict=True):
                fronts[value].append(rows)
    return np.concatenate(out)


def common_prefixes(words: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix in ``order`` shares with the one before it, up to ``most``."""
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for at in range(0, most, 8):
        a, b = np.minimum(order[live] + at, len(words) - 1), np.minimum(order[live - 1] + at, len(words) - 1)
        differ = words[a] ^ words[b]
        equal = differ == 0
        rest = ~equal
        out[live[equal]] += 8
        for k in range(1, 8):
            out[live[rest]] += differ[rest] < (1 << (64 - 8 * k))
        live = live[equal]
    return np.minimum(out, most)


def repeats(strings: list[bytes], doc: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of windows in ``strings`` that start earlier in another string or place."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    text = np.frombuffer(b"\0".join([s.translate(_UP) for s in strings]) + b"\0", np.uint8)
    words = words_at(text)
    order = suffix_array(text, words, length)
    begins = np.cumsum(sizes + 1) - sizes - 1
    of = np.searchsorted(begins, order, side="right") - 1
    whole = order + length <= begins[of] + sizes[of]
    order, of = order[whole], of[whole]
    new = common_prefixes(words, order, length) < length
    where = first[of] + order - begins[of]
    run = np.cumsum(new)
    rank = np.lexsort((where, doc[of], run))
    of, where, run = of[rank], where[rank], run[rank]
    lead = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))[run - 1] if len(run) else run
    drop = (doc[of] != doc[of[lead]]) | (where != where[lead]) if len(run) else np.zeros(0, bool)
    return merged(doc[of][drop], where[drop], where[drop] + length)


#: Text bytes one higher, so that zero is free for string ends (UTF-8 has no byte 0xFF).
_UP = bytes(min(b + 1, 255) for b in range(256))


def _sorted_repeats(strings: DataFrame, length: int) -> DataFrame:
    """Ranges that go, from strings dealt and sorted by anchor."""

    def work(held: list) -> pa.RecordBatch | None:
        gone = repeats([x[3] for x in held], np.array([x[1] for x in held]), np.array([x[2] for x in held]), length)
        return _found_batch(None, *gone) if len(gone[0]) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= CHUNK and held[-1][0] != row[0]:
                    if (out := work(held)) is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held and (out := work(held)) is not None:
            yield out

    return strings.repartition("key").sortWithinPartitions("key").mapInArrow(run, _FOUND)


# --- the whole ---------------------------------------------------------------

_CUT = "key long, crowded boolean, doc long, first long, data binary"


def _cut_batch(cut: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    columns = zip(*cut, strict=True) if cut else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["key", "crowded", "doc", "first", "data"])


def _spans(wanted: DataFrame) -> DataFrame:
    return wanted.groupBy("doc").agg(F.collect_list(F.struct("key", "first", "last", "crowded")).alias("spans"))


def _cut_out(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted segments of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", SLICE):
            cut = []
            for doc, text, spans in zip(*(c.to_pylist() for c in part.columns), strict=True):
                raw = text.encode()
                cut += [(s["key"], s["crowded"], doc, s["first"], raw[s["first"] : s["last"]]) for s in spans if s["last"] <= len(raw)]
            yield _cut_batch(cut)

    return docs.join(_spans(wanted), "doc").select("doc", "text", "spans").mapInArrow(run, _CUT)


def _cut_again(strings: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted segments of ``strings``, from the strings that hold them whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, own, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = sorted((o["first"], o["data"]) for o in own)
                begins = [first for first, _ in held]
                longest = max(len(data) for _, data in held)
                cut = []
                for s in spans:
                    near = held[bisect_left(begins, s["last"] - longest) : bisect_right(begins, s["first"])]
                    cut += [
                        (s["key"], s["crowded"], doc, s["first"], data[s["first"] - begin : s["last"] - begin])
                        for begin, data in near
                        if s["last"] <= begin + len(data)
                    ]
                yield _cut_batch(cut)

    own = strings.groupBy("doc").agg(F.collect_list(F.struct("first", "data")).alias("own"))
    return own.join(_spans(wanted), "doc").select("doc", "own", "spans").mapInArrow(run, _CUT)


def _part_again(strings: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per segment of ``strings`` by anchors of ``gram`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, begin = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2))
            strings = batch.column(2).to_pylist()
            raw = b"".join(strings)
            ends = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)))
            first, count, key = segments(np.frombuffer(raw, np.uint8), ends, length, gram)
            if not len(first):
                continue
            size = count + length - 1
            h = [xxhash.xxh3_64_intdigest(raw[a : a + n]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
            of = np.searchsorted(ends, first, side="right")
            start = first - np.concatenate([[0], ends[:-1]])[of] + begin[of]
            yield _row_batch(key, np.array(h, np.uint64).view(np.int64), doc[of], (start << _PLACE) | (size - length))

    return strings.select("doc", "first", "data").mapInArrow(run, _ROWS)


def removed_ranges(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc, first, last``: ranges of bytes that go (they may overlap)."""
    if not GRAM < length < GRAM + (1 << _PLACE):
        raise ValueError(f"length must be over {GRAM}")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    rows = rows.where(F.octet_length("text") >= length)
    found = stage_table(spark, _settle(_segment_rows(rows, length), length), "segments")
    gone, gram, strings = found.where(F.col("key").isNull()), GRAM, None
    while True:
        mixed = found.where(F.col("key").isNotNull())
        crowded = mixed.groupBy("key").count().where((F.col("count") > CROWD) & F.lit(gram < length - 1))
        wanted = mixed.join(crowded.select("key", F.lit(True).alias("crowded")), "key", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
        cut = stage_table(spark, _cut_out(rows, wanted) if strings is None else _cut_again(strings, wanted), "strings")
        gone = gone.union(_sorted_repeats(cut.where(~F.col("crowded")).select("key", "doc", "first", "data"), length))
        strings = cut.where(F.col("crowded"))
        if strings.isEmpty():
            return gone.select("doc", "first", "last")
        gram += (length - gram) // 2
        found = stage_table(spark, _settle(_part_again(strings, length, gram), length), "segments")
        gone = gone.union(found.where(F.col("key").isNull()))


def without_repeats(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep`` columns, ``n_bytes``, ``removed`` (ranges, merged) and ``kept`` (the bytes that remain) per row of ``docs``."""
    ranges = removed_ranges(docs, length, id_col, text_col)
    ranges = ranges.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))
    rows = docs.select(*keep, F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("__doc"), F.col(text_col).alias("__text"))
    rows = rows.join(ranges, F.col("__doc") == F.col("doc"), "left").select(*keep, "__text", "ranges")
    n = len(keep)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text"):
            sizes, removed, kept = [], [], []
            for text, spans in zip(part.column(n).to_pylist(), part.column(n + 1).to_pylist(), strict=True):
                raw = text.encode() if text else b""
                a = np.array([(s["first"], min(s["last"], len(raw))) for s in spans or []], np.int64).reshape(-1, 2)
                _, first, last = merged(np.zeros(len(a), np.int64), a[:, 0], a[:, 1])
                cuts = [0, *np.stack([first, last], axis=1).reshape(-1).tolist(), len(raw)]
                sizes.append(len(raw))
                removed.append([{"first": x, "last": y} for x, y in zip(first.tolist(), last.tolist(), strict=True)])
                kept.append(b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:n], pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                [*part.schema.names[:n], "n_bytes", "removed", "kept"],
            )

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:n])
    tail = "n_bytes long, removed array<struct<first: long, last: long>>, kept binary"
    return rows.mapInArrow(run, f"{head}, {tail}" if head else tail)
