"""A prefix trie of conversations, built as a burst trie.

A turn's id is a 128-bit digest of its role and text, and a conversation is the
row of its turn ids.  Equal conversations are one row with a count.  Rows lie in
containers, each under a trie head (a path of turns).  A container of more than
``CONTAINER`` turns bursts: the path that all its rows share becomes head nodes,
and its rows go on to one container per next turn id.  What remains is sorted
by turn ids and swept with a stack, which yields the nodes of each container;
subtree sums then go up the heads, one round of bursts at a time.

Hot cases: a common first turn or a much copied conversation is counted with
map-side combines and then is one row or one head; bursting joins rows to heads
by (head, salt).  A conversation with more than ``LONG`` turns is numbered by a
distributed running count, and of the longest one, what lies beyond the second
longest stays in single rows: no other conversation can share it.  A digest of
members in order is one pass over sorted ids per node, with constant memory, as
the digest itself asks for.  After ``BURSTS`` rounds, containers are swept at any
size: the sweep reads rows as a stream and holds the nodes of one container.

Defined cases: null role or text is empty; a null turn comes first; rows of one
conversation and turn are ordered by role, then text; repeated rows are turns of
their own; rows without a conversation id belong to none and are left out; extra
columns do not matter; an empty table has no conversation and no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.llm.common import stage_table
from eventlens.operators.ordered import running_sums

CONTAINER = 20_000
BURSTS = 40
LONG = 50_000
_SALTS = 32
#: Characters of a turn id.
_WIDE = 32
EMPTY_SHA = hashlib.sha256(b"").hexdigest()

_NODE = "conv long, depth int, parent long, n_convs long, n_children long, n_leaves long, saved long, ends string"


def _numbered(rows: DataFrame, order: list, group: str) -> DataFrame:
    """``rows`` with ``place``, counted from 1 in each group; groups of over ``LONG`` rows are counted across tasks."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n"))
    long = [r[0] for r in sizes.where(F.col("__n") > LONG).orderBy(F.desc("__n")).limit(1_001).collect()]
    if len(long) > 1_000:  # then none of the groups holds more than a thousandth of what these have
        long = []
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")
    if not long:
        return rows.withColumn("place", place)
    few = rows.where(~F.col(group).isin(long)).withColumn("place", place)
    counted = running_sums(rows.where(F.col(group).isin(long)).withColumn("__one", F.lit(1)), [F.col(group), *order], ["__one"])
    starts = counted.groupBy(group).agg((F.min("cum___one") - 1).alias("__start"))
    many = counted.join(F.broadcast(starts), group).withColumn("place", (F.col("cum___one") - F.col("__start")).cast("long"))
    return few.unionByName(many.select(few.columns))


def ordered_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv, place, id, chars`` for each row with a conversation id; ``place`` counts from 1."""
    said = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text")
    )
    rows = _numbered(rows, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "conv")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    return stage_table(
        conversations.sparkSession, rows.select("conv", "place", digest.alias("id"), F.length("text").alias("chars")), "turns"
    )


def _common(a: str, b: str) -> int:
    """Turns that two paths share."""
    low, high = 0, min(len(a), len(b)) // _WIDE
    while low < high:
        mid = (low + high + 1) // 2
        if a.startswith(b[low * _WIDE : mid * _WIDE], low * _WIDE):
            low = mid
        else:
            high = mid - 1
    return low


@F.pandas_udf(T.IntegerType())
def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_common(x, y) for x, y in zip(a, b, strict=True)], dtype="int32")


def _digests(ends: DataFrame) -> DataFrame:
    """``path, ends``: the digest of the members' ids in order, from ``path, conv`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, out = None, None, []
        for batch in batches:
            for path, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if path == at:
                    sha.update(b",%d" % conv)
                    continue
                if sha:
                    out.append((at, sha.hexdigest()))
                at, sha = path, hashlib.sha256(b"%d" % conv)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["path", "ends"])
                out = []
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([sha.hexdigest()])], ["path", "ends"])

    return ends.repartition("path").sortWithinPartitions("path", "conv").mapInArrow(run, "path string, ends string")


class _Node:
    __slots__ = ("depth", "n", "first", "children", "leaves", "saved", "chars", "ends", "kids")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars = depth, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.first, self.ends, self.kids = None, EMPTY_SHA, []


class _Sweep:
    """Nodes of containers whose rows come sorted by (head, seq)."""

    def __init__(self):
        self.stack: list[_Node] = []
        self.head = self.seq = self.up = None
        self.out: list[tuple] = []

    def _emit(self, node: _Node, parent: int | None, up: str | None) -> None:
        self.out.append((node.first, node.depth, parent, node.n, node.children, node.leaves, node.saved, node.ends, up))

    def pop(self) -> None:
        node = self.stack.pop()
        node.leaves += node.children == 0
        node.saved += (node.n - 1) * node.chars
        for kid in node.kids:
            self._emit(kid, node.first, None)
        node.kids = None
        if not self.stack:
            self._emit(node, self.up[1], self.up[0])
            return
        over = self.stack[-1]
        over.n += node.n
        over.first = node.first if over.first is None else min(over.first, node.first)
        over.children += 1
        over.leaves += node.leaves
        over.saved += node.saved
        over.kids.append(node)

    def row(self, head: str, depth: int, up: tuple, seq: str, chars: list[int], more: bool, n: int, first: int, ends: str | None) -> None:
        if head != self.head:
            self.close()
            self.head, self.up, start = head, up, depth
        else:
            start = _common(self.seq, seq) + 1
            while self.stack and self.stack[-1].depth >= start:
                self.pop()
        self.seq = seq
        for d in range(start, len(chars) + 1):
            self.stack.append(_Node(d, chars[d - 1] if d else 0))
        end = self.stack[-1]
        end.n += n
        end.first = first if end.first is None else min(end.first, first)
        if more:  # the rest of this conversation is a chain that is written elsewhere
            end.children += 1
            end.leaves += 1
        elif ends is not None:
            end.ends = ends

    def close(self) -> None:
        while self.stack:
            self.pop()


def _swept(containers: DataFrame) -> DataFrame:
    """Nodes of all containers; ``up`` is the head above for a container's top node, else null."""
    fields = ["head", "depth", "up", "up_first", "seq", "chars", "more", "n", "first", "ends"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = _Sweep()

        def nodes() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.bool_()]
            columns = zip(*((*node, node[-1] is not None or node[1] == 0) for node in sweep.out), strict=True)
            sweep.out = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["conv", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends", "up", "top"],
            )

        for batch in batches:
            for head, depth, up, up_first, seq, chars, more, n, first, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sweep.row(head, depth, (up, up_first), seq, chars, more, n, first, ends)
            if sweep.out:
                yield nodes()
        sweep.close()
        if sweep.out:
            yield nodes()

    dealt = containers.select(fields).repartition("head").sortWithinPartitions("head", "seq")
    return dealt.mapInArrow(run, f"{_NODE}, up string, top boolean")


def _long_tail(turns: DataFrame) -> tuple[DataFrame, DataFrame | None, int]:
    """Turns up to the second longest conversation's length; the rest of the longest (with ``depth``) and where it starts."""
    top = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "conv").limit(2).collect()
    second = top[1]["n"] if len(top) > 1 else 0
    if not top or top[0]["n"] <= max(LONG, second):
        return turns, None, 0
    longest = top[0]["conv"]
    whole = running_sums(turns.where(F.col("conv") == longest).withColumn("depth", F.lit(1)), ["place"], ["depth"], prefix="__")
    whole = stage_table(turns.sparkSession, whole.withColumn("depth", F.col("__depth").cast("int")).drop("__depth"), "longest")
    near = turns.where(F.col("conv") != longest).unionByName(whole.where(F.col("depth") <= second).drop("depth"))
    return near, whole.where(F.col("depth") > second), second


def trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations, from the empty one on.

    ``turns`` has ``conv, place, id, chars`` (places ascend, gaps do not
    matter), ``members`` each ``conv`` once, turnless ones too.  Columns: the least member ``conv``,
    ``depth``, the ``parent``'s least member, ``n_convs``, ``n_children``, ``n_leaves``, ``saved`` (characters
    that repeat in the subtree) and ``ends`` (SHA-256 of the ids that end here).
    """
    spark = turns.sparkSession
    near, tail, cut = _long_tail(turns)
    packed = near.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("place", "id", "chars"))).alias("t"))
    longest = tail.first()["conv"] if tail is not None else None
    paths = members.join(packed, "conv", "left").select(
        "conv",
        F.coalesce(F.array_join("t.id", ""), F.lit("")).alias("seq"),
        F.coalesce(F.col("t.chars"), F.array().cast("array<int>")).alias("chars"),
        (F.col("conv") == longest if longest is not None else F.lit(False)).alias("more"),
    )
    paths = stage_table(spark, paths.withColumn("path", F.md5("seq")), "paths")
    distinct = paths.groupBy("path", "seq", "chars", "more").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"))
    state = distinct.join(_digests(paths.where(~F.col("more")).select("path", "conv")), "path", "left").select(
        F.lit("").alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("up"), F.lit(None).cast("long").alias("up_first"),
        "seq", "chars", "more", "n", "first", "ends",
    )
    state = stage_table(spark, state, "container")

    settled, heads = [], []
    for _ in range(BURSTS):
        sizes = state.groupBy("head", "depth", "up", "up_first").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.size("chars") - F.col("depth")).alias("turns"), F.min("seq").alias("low"),
            F.max("seq").alias("high"), F.min_by("chars", "seq").alias("path_chars"), F.sum("n").alias("n_convs"), F.min("first").alias("least"),
        )
        big = sizes.where((F.col("turns") > CONTAINER) & (F.col("rows") > 1)).withColumn("last", _shared("low", "high"))
        big = stage_table(spark, big.drop("rows", "turns", "low", "high"), "heads")
        if big.isEmpty():
            break
        salted = big.select("head", F.col("last"), F.col("least"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        burst = state.withColumn("salt", F.pmod(F.xxhash64("seq"), F.lit(_SALTS)).cast("int")).join(salted, ["head", "salt"], "left").drop("salt")
        burst = stage_table(spark, burst, "burst")
        settled.append(burst.where(F.col("last").isNull()).drop("last", "least"))
        ended = burst.where(F.size("chars") == F.col("last")).groupBy("head").agg(F.max("ends").alias("ends"), F.max("more").alias("more"))
        heads.append(big.join(ended, "head", "left"))
        state = burst.where(F.size("chars") > F.col("last")).select(
            F.md5(F.substring(F.col("seq"), F.lit(1), (F.col("last") + 1) * _WIDE)).alias("head"), (F.col("last") + 1).alias("depth"),
            F.col("head").alias("up"), F.col("least").alias("up_first"), "seq", "chars", "more", "n", "first", "ends",
        )
    for some in settled:
        state = state.unionByName(some)
    nodes = stage_table(spark, _swept(state), "nodes")

    parts = [nodes.drop("up", "top")]
    tops = nodes.where("top").select("up", "n_leaves", "saved")
    for head in reversed(heads):
        below = tops.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("head")).agg(
            F.count(F.lit(1)).alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved").alias("below")
        )
        more = F.coalesce(F.col("more").cast("long"), F.lit(0))
        # A head without containers below holds the longest conversation and its equal as far as it goes here.
        full = head.join(below, "head", "left").fillna(0, ["kids", "leaves", "below"])
        full = full.select("*", (F.col("kids") + more).alias("n_children"), (F.col("leaves") + more).alias("n_leaves"))
        at = F.explode(F.sequence("depth", "last")).alias("at")
        first = F.greatest(F.col("depth"), F.lit(1))
        under = F.slice("path_chars", first, F.col("last") - first + 1)
        saved = F.col("below") + (F.col("n_convs") - 1) * F.aggregate(under, F.lit(0).cast("long"), lambda a, x: a + x)
        lowest, top = F.col("depth") == F.col("last"), F.col("depth") == F.col("__start")
        chain = full.withColumn("__start", F.col("depth")).select("*", at).drop("depth").withColumnRenamed("at", "depth").select(
            F.col("least").alias("conv"), "depth", F.when(top, F.col("up_first")).otherwise(F.col("least")).alias("parent"), "n_convs",
            F.when(lowest, F.col("n_children")).otherwise(1).alias("n_children"), "n_leaves", saved.alias("saved"),
            F.when(lowest, F.coalesce("ends", F.lit(EMPTY_SHA))).otherwise(EMPTY_SHA).alias("ends"), F.when(top, F.col("up")).alias("up"),
            top.alias("top"),
        )
        chain = stage_table(spark, chain, "chains")
        parts.append(chain.drop("up", "top"))
        # Heads of earlier rounds are above: they see these tops and the ones swept under them.
        tops = tops.unionByName(chain.where("top").select("up", "n_leaves", "saved"))
    if tail is not None:
        path = paths.where("more").select("path").first()["path"]
        above = paths.where(F.col("path") == path).agg(F.min("conv")).first()[0]
        final = tail.agg(F.max("depth")).first()[0]
        last = F.col("depth") == final
        parts.append(tail.select(
            "conv", "depth", F.when(F.col("depth") == cut + 1, F.lit(above)).otherwise(F.col("conv")).alias("parent"), F.lit(1).alias("n_convs"),
            F.when(last, 0).otherwise(1).alias("n_children"), F.lit(1).alias("n_leaves"), F.lit(0).alias("saved"),
            F.when(last, F.sha2(F.col("conv").cast("string"), 256)).otherwise(EMPTY_SHA).alias("ends"),
        ))
    out = parts[0]
    for some in parts[1:]:
        out = out.unionByName(some)
    return out
