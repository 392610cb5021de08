"""CSV records with newlines inside quotes, cut in many tasks per file.

A line of text takes the reader from one of two states (outside, inside quotes)
to one of two, whatever came before; that pair is computed per line.  Lines stay
in the scan's splits:

1. each split composes its lines' pairs into one pair (one row per split);
2. a window over a file's splits in order gives the state each split starts in;
3. each split cuts its own records from that state.  What a record has in other
   splits, at most one piece at either end of a split, is put together by a
   small aggregate.

A quote opens a field only at the field's start, and a doubled quote inside
quotes is a quote; so a lone quote inside an unquoted field changes nothing.
A quote that is never closed makes the rest of its file one record, as it does for
any reader.  The table of splits is broadcast: it has a row per
``spark.sql.files.maxPartitionBytes`` of input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlens.session import stage_table


def _ends_inside(line: Column, sep: str) -> Column:
    """Whether a line that starts outside quotes ends inside them."""
    start = f"(^|{re.escape(sep)})"
    closed = F.regexp_replace(line, start + r'"[^"]*+(?:""[^"]*+)*+"', "$1")
    return closed.rlike(start + '"')


def _lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """``value`` lines in file order within a split ``(f, at)``, and the states they lead to from outside and inside."""
    text = spark.read.option("lineSep", "\n").text(path)
    rows = text.select("value", F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"))
    plain = ~F.contains("value", F.lit('"'))
    out = F.when(plain, False).otherwise(_ends_inside(F.col("value"), sep)).alias("out")
    into = F.when(plain, True).otherwise(_ends_inside(F.concat(F.lit('"'), "value"), sep)).alias("into")
    return rows.select("f", "at", "value", out, into)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """Stretches of a batch that lie in one split: ``(split, first row, row after)``."""
    f, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    edges = np.flatnonzero((f[1:] != f[:-1]) | (at[1:] != at[:-1])) + 1
    for a, b in zip([0, *edges], [*edges, len(f)]):
        if b > a:
            yield (int(f[a]), int(at[a])), int(a), int(b)


def _bools(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(bool)


def _split_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(split: tuple[int, int], out: bool, into: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([split[0]]), pa.array([split[1]]), pa.array([out]), pa.array([into])], ["f", "at", "out", "into"])

    now, pair = None, (False, True)
    for batch in batches:
        out, into = _bools(batch, "out"), _bools(batch, "into")
        for split, a, b in _runs(batch):
            if split != now:
                if now is not None:
                    yield row(now, *pair)
                now, pair = split, (False, True)
            same = np.flatnonzero(out[a:b] == into[a:b])  # lines that lead to one state from either
            last = a + int(same[-1]) if same.size else a - 1
            turns = bool((out[last + 1 : b] & ~into[last + 1 : b]).sum() % 2)
            ends = [out[last] ^ turns] * 2 if same.size else [p ^ turns for p in pair]
            pair = (bool(ends[0]), bool(ends[1]))
    if now is not None:
        yield row(now, *pair)


def _start_states(pairs: DataFrame) -> DataFrame:
    """``f, at, inside``: the state in which each split of a file starts."""
    order = Window.partitionBy("f").orderBy("at")
    turn = (F.col("out") & ~F.col("into")).cast("int")
    fixed = F.when(F.col("out") == F.col("into"), F.struct(F.col("out").cast("int").alias("to"), F.sum(turn).over(order).alias("turns")))
    marked = pairs.select("f", "at", F.sum(turn).over(order).alias("turns"), F.last(fixed, ignorenulls=True).over(order).alias("fixed"))
    after = F.coalesce(F.col("fixed.to") + F.col("turns") - F.col("fixed.turns"), F.col("turns")) % 2
    return marked.select("f", "at", F.coalesce(F.lag(after).over(order), F.lit(0)).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces: ``f, at, piece, record, first``; piece 0 is whole, 1 runs on from an earlier split, 2 runs on into a later one."""
    now, inside, held, started, first = None, False, [], False, False
    rows: list[tuple] = []

    def close(piece: int) -> None:
        nonlocal held, first
        rows.append((*now, piece, "\n".join(held), first))
        held, first = [], False

    def flush() -> pa.RecordBatch:
        nonlocal rows
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        rows = []
        return pa.RecordBatch.from_arrays(columns, ["f", "at", "piece", "record", "first"])

    for batch in batches:
        values, out, into = batch.column(2).to_pylist(), _bools(batch, "out"), _bools(batch, "into")
        begins = batch.column(5).to_numpy()
        for split, a, b in _runs(batch):
            if split != now:
                if held:
                    close(2 if started else 1)
                now, inside = split, bool(begins[a])
                started, first = not inside, split[1] == 0
            for i in range(a, b):
                held.append(values[i])
                inside = bool(into[i] if inside else out[i])
                if not inside:
                    close(0 if started else 1)
                    started = True
        if rows:
            yield flush()
    if held:
        close(2 if started else 1)
    if rows:
        yield flush()


def quoted_records(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """``record`` (without its line end) and ``first`` (of its file) for each record that is not blank."""
    lines = _lines(spark, path, sep)
    pairs = lines.select("f", "at", "out", "into").mapInArrow(_split_pairs, "f long, at long, out boolean, into boolean")
    states = stage_table(spark, _start_states(pairs), "splits")
    # A broadcast join leaves the lines in the scan's order.
    cut = lines.join(F.broadcast(states), ["f", "at"]).select("f", "at", "value", "out", "into", "inside").mapInArrow(
        _cut, "f long, at long, piece int, record string, first boolean"
    )
    cut = stage_table(spark, cut, "records")
    order = Window.partitionBy("f").orderBy("at", "piece")
    owner = F.sum((F.col("piece") == 2).cast("int")).over(order)
    joined = cut.where("piece > 0").withColumn("owner", owner).groupBy("f", "owner").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece", "record"))).alias("p"), F.max("first").alias("first")
    )
    every = cut.where("piece = 0").select("record", "first").unionByName(joined.select(F.array_join("p.record", "\n").alias("record"), "first"))
    every = every.select(F.regexp_replace("record", r"\r$", "").alias("record"), "first")
    return every.where(F.trim("record") != "")


def read_quoted_csv(spark: SparkSession, path: str, columns: list[str], *, corrupt: str, sep: str = ",", header: bool = True) -> DataFrame:
    """All-text columns and ``corrupt``, which holds a record with too many or too few fields."""
    records = quoted_records(spark, path, sep)
    if header:
        records = records.where(~F.col("first"))
    schema = ", ".join(f"`{c}` string" for c in [*columns, corrupt])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "sep": sep, "quote": '"', "escape": '"'}
    return records.select(F.from_csv("record", schema, options).alias("r")).select("r.*")
