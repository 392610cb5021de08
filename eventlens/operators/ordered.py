"""Order-dependent building blocks that never put a whole table in one task.

* :func:`running_sums` — running totals in a *global* order.  A bare
  ``Window.orderBy`` would move every row into one partition; instead the rows
  are range-partitioned on the order, summed locally per range partition, and
  each partition adds the totals of the partitions before it (one small table,
  one row per partition, broadcast — its size is the partition count).
* :func:`top_n_per_group` — the first ``n`` rows of each group.  A plain
  ``Window.partitionBy(group)`` would gather a hot group into one task; here
  each input partition first keeps its own top ``n`` per group, so the final
  per-group window sees at most ``n × partitions`` rows per group.
* :func:`rank_in_group` — the exact position of each row inside its group in
  a given order, computed like the running sums, so a group holding a third
  of all rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlens.session import stage_table

_PID = "_el_pid"


def _n_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Sequence[str],
    *,
    prefix: str = "cum_",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``{prefix}{c}``: the sum of ``c`` over every row at or before this
    row in ``order`` (a total order is the caller's duty; ties are split
    arbitrarily).  Distributed two-pass prefix sum."""
    order_cols = _as_cols(order)
    parts = df.repartitionByRange(_n_parts(df, num_partitions), *order_cols).withColumn(
        _PID, F.spark_partition_id()
    )
    # Every evaluation of a range exchange may sample other bounds, so the
    # partition of each row is settled once, in a written table, and read by
    # both branches below (local sums, partition totals).
    parts = stage_table(df.sparkSession, parts, "ranges")
    local_w = Window.partitionBy(_PID).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.select("*", *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in sums])

    totals = parts.groupBy(_PID).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sums])
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition: a table whose size is the partition count.
    offsets = totals.select(
        _PID, *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sums]
    )
    joined = local.join(F.broadcast(offsets), _PID)
    keep = [c for c in df.columns]
    return joined.select(
        *keep, *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in sums]
    )


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    *,
    name: str = "rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name``: the 0-based position of the row within its group in
    ``order`` (ties split arbitrarily but consistently)."""
    counted = df.withColumn("_one", F.lit(1))
    order_cols = [F.col(g) for g in group] + _as_cols(order)
    ranked = running_sums(counted, order_cols, ["_one"], prefix="_cum", num_partitions=num_partitions)
    # running_sums counts across group boundaries; subtract the rows of the
    # earlier groups, i.e. the count of all groups ordered before this one.
    sizes = counted.groupBy(*group).agg(F.count(F.lit(1)).alias("_gsize"))
    starts = running_sums(sizes, [F.col(g) for g in group], ["_gsize"], prefix="_gcum", num_partitions=num_partitions)
    starts = starts.select(*group, (F.col("_gcum_gsize") - F.col("_gsize")).alias("_gstart"))
    out = ranked.join(starts, list(group), "left")
    return out.select(*df.columns, (F.col("_cum_one") - F.col("_gstart") - 1).cast("long").alias(name))


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    n: int,
    *,
    rank_col: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of each group in ``order`` (ties broken by the
    order columns only; add a key to ``order`` for determinism)."""
    order_cols = _as_cols(order)
    tagged = df.withColumn(_PID, F.spark_partition_id())
    local_w = Window.partitionBy(*group, _PID).orderBy(*order_cols)
    local = tagged.withColumn("_lrn", F.row_number().over(local_w)).filter(F.col("_lrn") <= n)
    final_w = Window.partitionBy(*group).orderBy(*order_cols)
    out = local.withColumn("_grn", F.row_number().over(final_w)).filter(F.col("_grn") <= n)
    cols = list(df.columns) + ([F.col("_grn").alias(rank_col)] if rank_col else [])
    return out.select(*cols)


def even_keys(spark, n: int, parts: int) -> list[int]:
    """At least ``n`` integers of which a hash exchange deals as many to each of ``parts`` partitions."""
    each = -(-n // parts)
    tried = 8 * each * parts + 200
    while True:
        ids = spark.range(0, tried, 1, 1).select(F.col("id").cast("int").alias("id"))
        by_part: dict[int, list[int]] = {p: [] for p in range(parts)}
        for i, p in ids.select("id", F.pmod(F.hash("id"), F.lit(parts))).collect():
            by_part[p].append(i)
        if min(map(len, by_part.values())) >= each:
            return [k for i in range(each) for k in (by_part[p][i] for p in range(parts))]
        tried *= 2


def spread(df: DataFrame) -> DataFrame:
    """Round-robin the rows over all cores when the planner's size estimate
    is below one scan split per core (nothing is executed to find out).

    For CPU-heavy per-row work (tokenising long texts) fed by a scan of few
    splits — e.g. a file written as one row group.  A scan that already
    yields enough partitions is returned unchanged, so at scale this adds no
    shuffle.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    split_bytes = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) >= target * split_bytes:
        return df
    return df.repartition(target)


def size_for_iterations(df: DataFrame, n_rows: int, rows_per_partition: int = 50_000) -> DataFrame:
    """Coalesce (no shuffle) the input of an iterative fit to about
    ``n_rows / rows_per_partition`` partitions, but never to fewer than there are cores.

    Each L-BFGS or Lloyd iteration is one job whose per-task cost includes
    a dense partial gradient (classes × features) sent back for the tree
    aggregate; many tiny partitions make that fixed cost dominate.  A large
    input keeps many partitions (one per ``rows_per_partition`` rows), and one of
    long rows all cores.
    """
    want = max(df.sparkSession.sparkContext.defaultParallelism, -(-int(n_rows) // rows_per_partition))
    return df.coalesce(want)  # never more partitions than there are
