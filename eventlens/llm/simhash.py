"""SimHash near-duplicates: anchor-point covering of Hamming space.

Fingerprints: 64 bits, each set where more than half of the shingle hashes have
it (XXH64, seed 42, shingles of lower-cased words with repeats).

Links at ``max_bits`` differing bits or fewer: the 64 bits are cut into
``max_bits // 2 + 1`` blocks, so that two linked fingerprints differ by at most
``t = max_bits // blocks`` bits in some block.  The anchors of a block are the
words of a covering code: a [15, 11] Hamming code on its first 15 bits (radius
1), every value on the rest.  A fingerprint has one home anchor (distance at
most 1) and goes as well to every anchor within 1 + t.  If x and y are linked,
the home of x is within 1 + t of y, so each anchor compares its homes with all
that reached it and no link is missed.  Fingerprints are compared once per
distinct value; an anchor that too many reach is cut into cells (homes by
reached), each home and each reached row meeting in exactly one cell.

Tasks stream cells in order and send out a spanning forest of the links they
find (fewer rows than fingerprints), never pairs.  Components follow by Spark
joins.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; repeated rows share a fingerprint, so a component; a null doc_id never
becomes a component_id unless the component has no other; only doc_id and text
are read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import sliced, stage_table, union_pairs
from eventlens.llm.components import smallest_reachable

CODE_BITS = 15
#: Homes and reached rows of one cell at most (on average, as rows are dealt by hash).
CELL_HOMES, CELL_REACHED = 4_096, 16_384
#: Rows gathered before comparing, and pairs compared in one numpy step.
GROUP_ROWS, STEP_PAIRS = 100_000, 1 << 18


def text_fingerprint(text: str | None, words: int = 4) -> int:
    """The fingerprint of one text."""
    return int(_fingerprints([text], words)[0])


def _fingerprints(texts: list[str | None], words: int) -> np.ndarray:
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        tokens = text.encode().lower().split() if text else []
        if len(tokens) <= words:
            own = [digest(b" ".join(tokens), 42)] if tokens else []
        else:
            line = b" ".join(tokens)
            ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
            firsts = [0, *(ends[: len(tokens) - words] + 1).tolist()]
            own = [digest(line[a:b], 42) for a, b in zip(firsts, ends[words - 1 :].tolist(), strict=True)]
        hashes.extend(own)
        counts.append(len(own))
    counts = np.array(counts, np.int64)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(counts)
    if full.size:
        # little-endian bytes and bit order: column k is bit k
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = (np.cumsum(counts) - counts)[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(ones * 2 > counts[full, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as a signed long), one row per row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "__text"):
            fps = _fingerprints(part.column(1).to_pylist(), words).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps)], [id_col, "fp"])

    rows = docs.select(id_col, F.col(text_col).alias("__text"))
    return rows.mapInArrow(run, T.StructType([rows.schema[0], T.StructField("fp", T.LongType())]))


def blocks_of(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of every block."""
    n = max_bits // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _anchors(fp: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, row, anchor, home?) for all anchors within 1 + t of each row's block value."""
    spans = blocks_of(max_bits)
    far = max_bits // len(spans)  # 0 or 1
    for block, (first, width) in enumerate(spans):
        value = (fp >> np.uint64(first)) & np.uint64((1 << width) - 1 if width < 64 else 0xFFFFFFFFFFFFFFFF)
        code = min(CODE_BITS, width)
        if code < CODE_BITS:
            raise ValueError("max_bits cuts the fingerprint into blocks of fewer bits than the code has")
        syndrome = np.zeros(len(fp), np.int64)
        for place in range(1, code + 1):
            syndrome ^= place * ((value >> np.uint64(place - 1)) & np.uint64(1)).astype(np.int64)
        flip = lambda place: np.where(place > 0, np.uint64(1) << (np.maximum(place, 1) - 1).astype(np.uint64), np.uint64(0))
        home = value ^ flip(syndrome)  # the nearest code word: distance 0 or 1
        rows = np.arange(len(fp))
        yield block, rows, home, np.ones(len(fp), bool)
        free = [np.uint64(1 << k) for k in range(code, width)]
        if far == 0:  # within 1: beside the home, code words with one free bit turned
            exact = rows[syndrome == 0]
            for bit in free:
                yield block, exact, home[exact] ^ bit, np.zeros(len(exact), bool)
            continue
        for bit in free:  # within 2: the home at distance 1 or 0, and one free bit
            yield block, rows, home ^ bit, np.zeros(len(fp), bool)
        exact = rows[syndrome == 0]
        for i, bit in enumerate(free):  # the text's own word at distance 0, and two free bits
            for other in free[i + 1 :]:
                yield block, exact, home[exact] ^ bit ^ other, np.zeros(len(exact), bool)
        for place in range(1, code + 1):  # code words two bits away: places i, j with i ^ j the syndrome
            other = syndrome ^ place
            pick = rows[(syndrome > 0) & (other > place)]
            yield block, pick, value[pick] ^ np.uint64(1 << (place - 1)) ^ flip(other[pick]), np.zeros(len(pick), bool)


def _spread(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``anchor, home, fp``: each fingerprint at its home and at every anchor that it reaches."""
    bits = max(width for _, width in blocks_of(max_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for block, rows, anchor, home in _anchors(fp, max_bits):
                key = anchor.astype(np.int64) if bits >= 62 else (anchor | np.uint64(block << bits)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(home), pa.array(fp[rows].view(np.int64))], ["anchor", "home", "fp"]
                )

    return distinct.select("fp").mapInArrow(run, "anchor long, home boolean, fp long")


def _linked(cell: np.ndarray, home: np.ndarray, fp: np.ndarray, max_bits: int) -> pa.RecordBatch | None:
    """A spanning forest of the links inside the cells; rows of a cell lie together."""
    nodes, node = np.unique(fp, return_inverse=True)
    parent = np.arange(len(nodes))
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    sizes = np.diff(np.append(starts, len(cell)))
    of = np.repeat(np.arange(len(starts)), sizes)
    homes = np.flatnonzero(home)
    width = sizes[of[homes]]
    upto = np.cumsum(width)
    at = 0
    while at < len(homes):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + STEP_PAIRS, side="right")))
        own, n = homes[at:end], width[at:end]
        b = np.arange(int(n.sum())) + np.repeat(starts[of[own]] - (np.cumsum(n) - n), n)
        x, y = np.repeat(node[own], n), node[b]
        close = (parent[x] != parent[y]) & (np.bitwise_count(nodes[x] ^ nodes[y]) <= max_bits)
        parent = union_pairs(parent, x[close], y[close])
        at = end
    moved = np.flatnonzero(parent != np.arange(len(nodes)))
    if not moved.size:
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[moved].view(np.int64)), pa.array(nodes[parent[moved]].view(np.int64))], ["a", "b"]
    )


def _compare(cells: DataFrame, max_bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            held.append((new[0], new[1], new[2], new[3].view(np.uint64)))
            n += batch.num_rows
            if n < GROUP_ROWS:
                continue
            anchor, slot, home, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            last = (anchor == anchor[-1]) & (slot == slot[-1])  # this cell may go on in the next batch
            cut = int(np.argmax(last))
            if cut:
                out = _linked(_cell_ids(anchor[:cut], slot[:cut]), home[:cut], fp[:cut], max_bits)
                if out is not None:
                    yield out
            held, n = [(anchor[cut:], slot[cut:], home[cut:], fp[cut:])], len(anchor) - cut
        if n:
            anchor, slot, home, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            out = _linked(_cell_ids(anchor, slot), home, fp, max_bits)
            if out is not None:
                yield out

    return cells.mapInArrow(run, "a long, b long")


def _cell_ids(anchor: np.ndarray, slot: np.ndarray) -> np.ndarray:
    new = np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1])])
    return np.cumsum(new)


def _cells(spread: DataFrame) -> DataFrame:
    """``anchor, slot, home, fp``; anchors that many reach are cut into slots."""
    crowded = (
        spread.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.count_if("home").alias("n_home"))
        .where((F.col("n") > CELL_REACHED) | (F.col("n_home") > CELL_HOMES))
        .select(
            "anchor",
            F.ceil(F.col("n_home") / CELL_HOMES).cast("int").alias("rows"),
            F.ceil(F.col("n") / CELL_REACHED).cast("int").alias("cols"),
        )
    )
    one = F.lit(1)
    rows, cols = F.greatest(F.coalesce("rows", one), one), F.greatest(F.coalesce("cols", one), one)
    deal = F.xxhash64("fp", F.lit(7))
    wide = spread.join(crowded, "anchor", "left").select("anchor", "home", "fp", rows.alias("rows"), cols.alias("cols"))

    def slots(own: Column, other: Column, of_home: bool) -> Column:
        mine = F.pmod(deal, own).cast("int")
        every = F.sequence(F.lit(0), other - 1)
        return F.transform(every, lambda k: mine * F.col("cols") + k if of_home else k * F.col("cols") + mine)

    # A home row stands in one row of slots; every row, homes too, is reached in one column of slots.
    both = F.when(F.col("home"), slots(F.col("rows"), F.col("cols"), True)).otherwise(F.array().cast("array<int>"))
    met = slots(F.col("cols"), F.col("rows"), False)
    as_home = wide.where("home").select("anchor", F.explode(both).alias("slot"), F.lit(True).alias("home"), "fp")
    reached = wide.select("anchor", F.explode(met).alias("slot"), F.lit(False).alias("home"), "fp")
    return as_home.union(reached)


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """``a, b``: links whose components are those of all pairs within ``max_bits``; ``distinct`` has each ``fp`` once."""
    cells = _cells(_spread(distinct, max_bits))
    dealt = cells.repartition("anchor", "slot").sortWithinPartitions("anchor", "slot")
    return _compare(dealt, max_bits)


def near_duplicates(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp, component_id``: the least id that links reach, itself included."""
    spark = docs.sparkSession
    prints = stage_table(spark, fingerprints(docs, words, id_col, text_col), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("label"))
    distinct = stage_table(spark, distinct, "distinct")
    classes = smallest_reachable(links(distinct, max_bits), distinct.select(F.col("fp").alias("node"), "label"))
    named = distinct.join(classes.select(F.col("node").alias("fp"), F.col("label").alias("least")), "fp", "left")
    named = named.select("fp", F.coalesce("least", "label").alias("component_id"))
    return prints.join(named, "fp").select(id_col, "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row of each component whose id is the component's; repeats of that id fall to one row, rows without id stay."""
    classes = near_duplicates(docs, words, max_bits, id_col, text_col)
    keep = classes.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__keep")).distinct()
    named = docs.join(keep, F.col(id_col) == F.col("__keep"), "left_semi").dropDuplicates([id_col])
    return named.unionByName(docs.where(F.col(id_col).isNull()))
