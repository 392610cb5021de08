"""Mixing sources to target weights by subset sums over document lengths.

Each source gets a share of all words by its weight, at most ``max_repeats``
times its own words; what is over goes to the other sources by weight.  A
source's target is then fitted with whole documents: every document is taken
``target // size`` times, and the remaining budget is met by a subset.  For that,
documents are counted by exact length.  Each length gives the same fraction of
its documents, rounded down, longer lengths fill up, and a bounded knapsack
(dynamic programming over the sums that the shortest lengths can reach) closes
what is left.  Which documents of a length are taken is a seeded hash order.

Nothing gathers a group of documents: lengths are counted with a map-side
combine per (source, length, hash bin), the bin that holds the last document
taken is found from the counts, and only that bin's rows are ranked.  Plans of
hot (source, length) groups, at most ``HOT_GROUPS`` by construction, are
broadcast; the rest are joined by a shuffle in which no key has more than
1 / ``HOT_GROUPS`` of the rows.  A source's fit holds one row per distinct length,
at most sqrt(2 x its words); the knapsack holds ``SPACE`` sums.

Defined cases: a null text has size 0; documents of size 0 are taken as often
as their source's whole repeats, which adds no words; a null source is a
source of its own, last in order; rows that repeat are mixed by themselves
(identical rows are interchangeable); extra columns do not matter; an empty
table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlens.llm.common import stage_table
from eventlens.operators.ordered import running_sums

WORD = r"[^\x20\x09-\x0D]+"
#: Sums that one knapsack spans.  A source of fewer words is fitted best possible, a larger one with its shortest documents.
SPACE = 1 << 18
HOT_GROUPS = 1_000
_BIN_BITS = 12


def reach(sizes: Sequence[int], counts: Sequence[int], goal: int) -> np.ndarray:
    """How many of each size to take so that the sum is nearest to ``goal`` (the lower one of two as near)."""
    taken = np.zeros(len(sizes), np.int64)
    total = int(np.dot(sizes, counts)) if len(sizes) else 0
    if goal >= total:
        return np.asarray(counts, np.int64).copy()
    if goal <= 0:
        return taken
    step = math.gcd(*(int(s) for s, c in zip(sizes, counts, strict=True) if c))
    span = min(total, 2 * goal)  # a sum beyond is further off than 0
    best = {goal - goal % step} if goal % step * 2 <= step else {goal - goal % step + step}
    came, met = np.full(span + 1, -1, np.int32), np.zeros(span + 1, bool)
    met[0] = True
    items: list[tuple[int, int]] = []  # (index of the size, copies taken at once): 1, 2, 4, .. and a rest
    for i, (size, count) in enumerate(zip(map(int, sizes), map(int, counts), strict=True)):
        lot = 1
        while count > 0 and size > 0:
            lot = min(lot, count)
            count -= lot
            jump = size * lot
            lot *= 2
            if jump > span:
                break
            fresh = met[: span + 1 - jump] & ~met[jump:]
            came[jump:][fresh] = len(items)
            met[jump:] |= fresh
            items.append((i, jump // size))
        if any(b <= span and met[b] for b in best):
            break
    sums = np.flatnonzero(met)
    at = int(sums[np.argmin(np.abs(sums - goal))])
    while at:
        i, lot = items[came[at]]
        taken[i] += lot
        at -= int(sizes[i]) * lot
    return taken


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each distinct size to take for a sum near ``budget``.

    ``sizes`` ascend.  Lengths keep their proportions but for the last documents.
    """
    words = [int(s) * int(c) for s, c in zip(sizes, counts, strict=True)]
    total = sum(words)
    if budget >= total:
        return counts.astype(np.int64)
    upto = np.cumsum(np.array(words, np.float64))
    pool = int(np.searchsorted(upto, SPACE, side="right"))  # lengths that the knapsack may deal with
    taken = np.array([int(c) * budget // total for c in counts], np.int64)
    left = budget - sum(int(s) * int(t) for s, t in zip(sizes, taken, strict=True))
    for i in range(len(sizes) - 1, pool - 1, -1):
        more = min(int(counts[i] - taken[i]), left // int(sizes[i]), 1)
        taken[i] += more
        left -= more * int(sizes[i])
    if pool:
        goal = left + int(np.dot(sizes[:pool], taken[:pool]))
        taken[:pool] = reach(sizes[:pool], counts[:pool], goal)
        left = goal - int(np.dot(sizes[:pool], taken[:pool]))
    free = np.flatnonzero(taken < counts)
    if left > 0 and free.size:  # one document too many may be nearer than none
        i = free[np.argmin(np.abs(sizes[free] - left))]
        taken[i] += abs(int(sizes[i]) - left) < left
    return taken


def targets(sources: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """``source, source_size, target`` of ``(source, source_size)`` rows: shares by weight under each source's cap."""
    placed = running_sums(
        sources.withColumn("__one", F.lit(1)), [F.col("source").isNull(), F.asc("source")], ["__one"], prefix="__nth"
    )
    nth = (F.col("__nth__one") - 1) % len(weights)
    weighted = placed.select(
        "source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (nth + 1).cast("int")).alias("w"),
        (F.col("source_size") * max_repeats).alias("cap"),
    )
    weighted = stage_table(sources.sparkSession, weighted, "shares")
    row = weighted.agg(F.sum("source_size"), F.sum("w")).first()
    size, weight = row[0] or 0, row[1] or 0
    # Sources in order of cap by weight: those before the level are capped.  The share per weight that is left for the
    # rest rises while sources under it are taken out and falls after, so the greatest one is the level.
    before = running_sums(weighted, [F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source")], ["cap", "w"])
    spent, used = F.col("cum_cap") - F.col("cap"), F.col("cum_w") - F.col("w")
    level = (F.lit(size) - spent) / (F.lit(weight) - used)
    top = before.select(F.max(F.struct(level.alias("level"), spent.alias("spent"), used.alias("used"))).alias("m")).first()["m"]
    rest, among = (size - top["spent"], weight - top["used"]) if top else (0, 1)
    share = F.lit(float(rest)) * F.col("w") / F.lit(float(among))
    return weighted.select("source", "source_size", F.least(F.col("cap").cast("double"), share).alias("target"))


def _plans(lengths: DataFrame, max_repeats: int) -> DataFrame:
    """``full`` and ``extra`` for each (source, size): copies of every document, and how many documents get one more."""

    def run(keys: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(tables)).sort_by("size")
        sizes, counts = (rows[c].to_numpy().astype(np.int64) for c in ("size", "n"))
        own, target = rows["source_size"][0].as_py(), rows["target"][0].as_py()
        full = min(int(target // own), max_repeats) if own else 0
        extra = np.zeros(len(sizes), np.int64)
        some = sizes > 0
        if full < max_repeats and some.any():
            extra[some] = fit(sizes[some], counts[some], max(round(target) - full * own, 0))
        yield pa.RecordBatch.from_arrays(
            [*(rows[c].combine_chunks() for c in ("source", "source_size", "target", "size")), pa.array(np.full(len(sizes), full)), pa.array(extra)],
            ["source", "source_size", "target", "size", "full", "extra"],
        )

    # A set number of partitions: few rows may stand for long computations.
    parts = int(lengths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lengths.repartition(parts, "source").groupBy("source").applyInArrow(run, "source string, source_size long, target double, size long, full long, extra long")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    *,
    key: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    max_repeats: int = 3,
    seed: int = 42,
) -> DataFrame:
    """``key, source, size, source_size, target, copies``: how often each document is in the mix.

    Sources in code point order (null last) weigh ``weights``, repeating.
    """
    spark = docs.sparkSession
    h = F.xxhash64(F.lit(seed), F.col(key), F.col(text_col))
    sized = docs.select(
        F.col(key).alias("__key"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("size"), h.alias("__h"),
    ).withColumn("__bin", F.shiftrightunsigned("__h", 64 - _BIN_BITS))
    sized = stage_table(spark, sized, "sizes")
    bins = stage_table(spark, sized.groupBy("source", "size", "__bin").agg(F.count(F.lit(1)).alias("n")), "bins")
    lengths = bins.groupBy("source", "size").agg(F.sum("n").alias("n"))
    shares = targets(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, max_repeats)
    shares = stage_table(spark, shares, "targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    lengths = lengths.join(shares, same(lengths, shares)).select(lengths["source"], "size", "n", "source_size", "target")
    plans = _plans(lengths, max_repeats)

    # The bin in which the last document taken lies, and how many of its documents are taken.
    upto = Window.partitionBy("source", "size").orderBy("__bin")
    counted = bins.withColumn("before", F.sum("n").over(upto) - F.col("n")).withColumn("group", F.sum("n").over(Window.partitionBy("source", "size")))
    edge = counted.join(plans, same(counted, plans) & (counted["size"] == plans["size"])).select(
        counted["source"], counted["size"], "__bin", "n", "before", "group", "source_size", "target", "full", "extra"
    )
    within = (F.col("extra") > F.col("before")) & (F.col("extra") <= F.col("before") + F.col("n"))
    cut = edge.groupBy("source", "size").agg(
        *[F.first(c).alias(c) for c in ("full", "group", "source_size", "target")],
        F.coalesce(F.max(F.when(within, F.col("__bin"))), F.lit(-1)).alias("last_bin"),
        F.coalesce(F.max(F.when(within, F.col("extra") - F.col("before"))), F.lit(0)).alias("last_n"),
    )
    cut = stage_table(spark, cut, "cuts")
    n_docs = cut.agg(F.sum("group")).first()[0] or 0
    facts = ["full", "source_size", "target", "last_bin", "last_n"]
    nth = F.row_number().over(Window.partitionBy("source", "size", "__bin").orderBy("__h", "__key"))
    rows = sized.withColumn("__nth", nth)
    is_hot = F.col("group") * HOT_GROUPS > n_docs  # true for fewer than HOT_GROUPS groups
    hot = cut.where(is_hot).select(F.col("source").alias("__s"), F.col("size").alias("__z"), F.struct(facts).alias("__hot"))
    rows = rows.join(F.broadcast(hot), F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")), "left").drop("__s", "__z")
    # Rows whose plan is known spread over sizes that no document has.
    away = F.when(F.col("__hot").isNotNull(), -1 - F.pmod(F.col("__h"), F.lit(1 << 16))).otherwise(F.col("size"))
    cold = cut.where(~is_hot).select(F.col("source").alias("__s"), F.col("size").alias("__z"), F.struct(facts).alias("__cold"))
    rows = rows.withColumn("__away", away).join(cold, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__away") == F.col("__z")), "left")
    plan = F.coalesce("__hot", "__cold")
    one_more = (F.col("__bin") < plan["last_bin"]) | ((F.col("__bin") == plan["last_bin"]) & (F.col("__nth") <= plan["last_n"]))
    return rows.select(
        F.col("__key").alias(key), "source", "size", plan["source_size"].alias("source_size"), plan["target"].alias("target"),
        (plan["full"] + one_more.cast("long")).alias("copies"),
    )
