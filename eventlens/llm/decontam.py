"""Benchmark decontamination with suffix arrays over the training texts.

Every slice of documents inside a partition is a shard: its words become ids
(0: a word that no benchmark item has), and the suffixes that start with a known
word are sorted by prefix doubling to ``DEPTH`` words.  All benchmark suffixes are
then binary-searched in the shard at once; the range found for a window gives
its locations, and each match is followed word by word to the longest verbatim
match.  Documents are never shuffled.

The benchmark is the stated query set.  It is worked off in blocks of about
``BLOCK_BYTES`` text: each block is sent to the tasks, and a pass over the
documents adds what it finds to the rows and writes them for the next block, so a
larger benchmark means more passes, not more memory in tasks; the driver holds one block at a time.

Defined cases: a null text or item has no words; an item of fewer words than
the window, but not none, is one window; items with equal texts all count; equal
rows give equal results; other columns do not matter.  Without documents or
items the result has no rows or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import gather_ranges, sliced, stage_table
from eventlens.session import drop_stage

#: Words to which suffixes are sorted; a power of two no less than the window.
DEPTH = 16
BLOCK_BYTES = 4 << 20
#: Text of one shard, that is of one suffix array.
SHARD_BYTES = 2 << 20

# Word bytes after A-Z are lower-cased: digits, a-z and everything beyond ASCII.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


class Windows:
    """The windows of a block of items, and the distinct ones among them with the items that hold each."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        if window > DEPTH:
            raise ValueError(f"window must be at most {DEPTH}")
        vocab: dict[bytes, int] = {}
        flat: list[int] = []
        first, size, owner = [], [], []
        for k, (_, text) in enumerate(items):
            ids = [vocab.setdefault(w, len(vocab) + 1) for w in words_of(text)]
            at = len(flat)
            flat.extend(ids)
            flat.append(0)
            n = max(len(ids) - window + 1, min(len(ids), 1))
            first.extend(range(at, at + n))
            size.extend([min(window, len(ids))] * n)
            owner.extend([k] * n)
        self.items = [i for i, _ in items]
        self.vocab = vocab
        self.ids = np.array([*flat, *[0] * (DEPTH + 1)], np.int32)
        self.first, self.size, self.owner = (np.array(x, np.int64) for x in (first, size, owner))
        self.window = window
        rows = self.ids[self.first[:, None] + np.arange(window)]
        rows[np.arange(window) >= self.size[:, None]] = -1  # beyond the window's length
        self.keys, which = np.unique(rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.lengths = (self.keys >= 0).sum(axis=1)
        # The windows of each distinct one, by the word before them (-1: an item's start).
        before = np.where(np.diff(self.owner, prepend=-1) != 0, -1, self.ids[self.first - 1]) if len(first) else np.empty(0, np.int64)
        self.by_key = np.lexsort((self.owner, before, which))
        self.wide = len(vocab) + 2
        self.order = which[self.by_key] * self.wide + before[self.by_key] + 1
        pairs = np.unique(np.stack([which, self.owner], axis=1), axis=0) if len(first) else np.empty((0, 2), np.int64)
        self.holders, self.held = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.keys) + 1))


def suffix_array(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Starts of the suffixes that begin with a known word, sorted by their first ``depth`` words."""
    starts = np.flatnonzero(ids)
    rank = ids.astype(np.int64)
    done = 1
    while done < depth:
        ahead = np.zeros(len(ids), np.int64)
        ahead[: len(ids) - done] = rank[done:]
        ahead[ids == 0] = 0
        key = rank * (int(rank.max(initial=0)) + 1) + ahead
        order = starts[np.argsort(key[starts])]
        own = key[order]
        fresh = np.zeros(len(ids), np.int64)
        if len(order):
            fresh[order] = np.cumsum(np.concatenate([[1], own[1:] != own[:-1]]))
        rank = fresh
        done *= 2
    return starts[np.argsort(rank[starts])]


def _before(ids: np.ndarray, at: np.ndarray, keys: np.ndarray, upper: bool) -> np.ndarray:
    """Is the suffix at ``at`` less than the key (``upper``: or does it begin with it)?"""
    mine = ids[at[:, None] + np.arange(keys.shape[1])]
    differ = (mine != keys) & (keys >= 0)
    k = differ.argmax(axis=1)
    rows = np.arange(len(at))
    return np.where(differ.any(axis=1), mine[rows, k] < keys[rows, k], upper)


def _bound(ids: np.ndarray, order: np.ndarray, keys: np.ndarray, upper: bool) -> np.ndarray:
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(order), np.int64)
    while True:
        live = np.flatnonzero(low < high)
        if not live.size:
            return low
        mid = (low[live] + high[live]) >> 1
        less = _before(ids, order[mid], keys[live], upper)
        low[live[less]] = mid[less] + 1
        high[live[~less]] = mid[~less]


def search(ids: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``ids``, distinct window) of every occurrence; ``ids`` must end with ``DEPTH`` zeros."""
    order = suffix_array(ids)
    if not len(w.keys) or not len(order):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    low = _bound(ids, order, w.keys, False)
    n = _bound(ids, order, w.keys, True) - low
    return order[gather_ranges(low, n)], np.repeat(np.arange(len(n)), n)


def longest(ids: np.ndarray, w: Windows, place: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(place, window, words)`` of the matches that cannot begin earlier, followed up to the item's end.

    A match whose words before it are equal too is part of a longer one on the same diagonal, so of the windows equal to
    a place's only those with another word before them are looked at: a run of equal words costs its length.
    """
    before = np.where(place > 0, ids[place - 1], 0).astype(np.int64)
    here = key * w.wide
    low, high = np.searchsorted(w.order, here), np.searchsorted(w.order, here + w.wide)
    # Unknown words (0) before a place differ from every known word.
    a = np.where(before > 0, np.searchsorted(w.order, here + before + 1), high)
    b = np.where(before > 0, np.searchsorted(w.order, here + before + 1, side="right"), high)
    window = w.by_key[np.concatenate([gather_ranges(low, a - low), gather_ranges(b, high - b)])]
    place = np.concatenate([np.repeat(place, a - low), np.repeat(place, high - b)])
    length = w.size[window].copy()
    live = np.arange(len(place))
    while live.size:
        theirs = w.ids[np.minimum(w.first[window[live]] + length[live], len(w.ids) - 1)]
        mine = ids[np.minimum(place[live] + length[live], len(ids) - 1)]
        live = live[(theirs == mine) & (mine > 0)]
        length[live] += 1
    return place, window, length


_MATCH = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("first_word", "n_words")] + [T.StructField("item_id", T.StringType())]
)
_RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", _MATCH),
    ]
)


def _pass(rows: DataFrame, w: Windows, keep: list[T.StructField]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text", SHARD_BYTES):
            data = part.to_pydict()
            found = _scan(data["__text"], shared.value, data["__found"])
            columns = [part.column(k) for k in range(len(keep) + 1)]
            kind = pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("hits", pa.list_(pa.int32())),
                    ("items", pa.list_(pa.string())),
                    ("longest", pa.struct([("first_word", pa.int32()), ("n_words", pa.int32()), ("item_id", pa.string())])),
                ]
            )
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], part.schema.names)

    fields = [*keep, T.StructField("__text", T.StringType()), T.StructField("__found", _RESULT)]
    return rows.mapInArrow(run, T.StructType(fields))


def _scan(texts: list[str | None], w: Windows, before: list[dict | None]) -> list[dict]:
    """What earlier blocks found, with the hits of this one: ``hits`` are first, end, first, end, ... of hit words."""
    get = w.vocab.get
    ids: list[int] = []
    sizes = []
    for text in texts:
        words = words_of(text)
        ids.extend([get(x, 0) for x in words])
        ids.append(0)
        sizes.append(len(words))
    line = np.array([*ids, *[0] * DEPTH], np.int32)
    starts = np.cumsum([0, *sizes[:-1]]) + np.arange(len(sizes))
    place, key = search(line, w)
    change = np.zeros(len(line) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + w.lengths[key], -1)
    met = np.unique((np.searchsorted(starts, place, side="right") - 1) * max(len(w.keys), 1) + key)
    met_doc, met_key = np.divmod(met, max(len(w.keys), 1))
    place, window, length = longest(line, w, place, key)
    doc = np.searchsorted(starts, place, side="right") - 1
    out = []
    for k, old in enumerate(before):
        out.append({"n_words": sizes[k]} | ({x: old[x] for x in ("hits", "items", "longest")} if old else {"hits": [], "items": [], "longest": None}))
    if not len(place):
        return out
    # Each document's longest match: the first place of equals, then the first window.
    ranked = np.lexsort((window, place, -length, doc))
    tops = ranked[np.flatnonzero(np.diff(doc[ranked], prepend=-1))]
    edges_met = np.searchsorted(met_doc, doc[tops]), np.searchsorted(met_doc, doc[tops], side="right")
    for best, lo, hi in zip(tops, *edges_met, strict=True):
        k = int(doc[best])
        a = starts[k]
        keys = met_key[lo:hi]
        holders = w.holders[gather_ranges(w.held[keys], w.held[keys + 1] - w.held[keys])]
        hit = np.cumsum(change[a : a + sizes[k] + 1]) > 0
        edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
        spans = [*zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        old = out[k]
        spans = _merged([*zip(old["hits"][::2], old["hits"][1::2], strict=True), *spans])
        top = {"first_word": int(place[best] - a), "n_words": int(length[best]), "item_id": w.items[int(w.owner[window[best]])]}
        out[k] = {
            "n_words": sizes[k],
            "hits": [x for s in spans for x in s],
            "items": sorted({*old["items"], *(w.items[i] for i in np.unique(holders))}),
            "longest": top if old["longest"] is None or old["longest"]["n_words"] < top["n_words"] else old["longest"],
        }
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``hits`` (word ranges as first, end, ...), ``items`` and ``longest`` verbatim match per document."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    rows = docs.select(*keep, F.col(text_col).alias("__text"), F.lit(None).cast(_RESULT).alias("__found"))
    fields = rows.schema.fields[: len(keep)]
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items
        w = Windows(sorted((r.item_id or "", r.text) for r in block.collect()), window)
        done, rows = rows, _pass(rows, w, fields)
        if k + 1 < blocks:  # one worker and one block in memory at a time
            rows = stage_table(docs.sparkSession, rows, "block")
            if k:
                drop_stage(done)
    return rows.select(*keep, "__found.*")



def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their columns as they are."""
    names = [f"__c{k}" for k in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    found = matches(renamed, benchmark, window, names[docs.columns.index(text_col)], tuple(names))
    return found.where(F.size("hits") == 0).select(*names).toDF(*docs.columns)
