"""Category levels as a joined dictionary and sparse vectors, for any number of levels.

The dictionary is a table: a level's index is its place by frequency (ties by
name), counted across range partitions.  Levels that hold more than one in
``HOT`` rows, fewer than ``HOT`` by construction, are broadcast; the others are
joined by a shuffle in which no level has more than that share.  No list of
levels reaches the driver, only their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.operators.ordered import running_sums
from eventlens.session import stage_table

HOT = 1_000


@dataclass(frozen=True)
class Levels:
    """``table`` has ``level, n, idx`` (0 is the most frequent); ``size`` levels in ``rows`` rows."""

    column: str
    unknown: str | None
    table: DataFrame
    size: int
    rows: int


def fit_levels(df: DataFrame, column: str, unknown: str | None = "U") -> Levels:
    """The levels of ``column``; nulls are the level ``unknown`` (or stay without one)."""
    level = F.col(column).cast("string") if unknown is None else F.coalesce(F.col(column).cast("string"), F.lit(unknown))
    sizes = df.select(level.alias("level")).where(F.col("level").isNotNull()).groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    placed = running_sums(sizes.withColumn("one", F.lit(1)), [F.desc("n"), F.asc("level")], ["one"])
    table = stage_table(df.sparkSession, placed.select("level", "n", (F.col("cum_one") - 1).cast("long").alias("idx")), "levels")
    total = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Levels(column, unknown, table, total[0], total[1])


def index_levels(df: DataFrame, levels: Levels) -> DataFrame:
    """``df`` with ``{column}_idx``; null for a level that was not there when fitted."""
    c, name = levels.column, f"{levels.column}_idx"
    value = F.col(c).cast("string") if levels.unknown is None else F.coalesce(F.col(c).cast("string"), F.lit(levels.unknown))
    hot = levels.table.where(F.col("n") * HOT > levels.rows).select(F.col("level").alias("__level"), F.col("idx").alias("__hot"))
    cold = levels.table.where(F.col("n") * HOT <= levels.rows).select(F.col("level").alias("__level"), F.col("idx").alias("__cold"))
    rows = df.withColumn("__value", value)
    rows = rows.join(F.broadcast(hot), F.col("__value") == F.col("__level"), "left").drop("__level")
    # Rows that are settled get a null key: a left join emits them where they are, whatever their number.
    rows = rows.withColumn("__open", F.when(F.col("__hot").isNull(), F.col("__value")))
    rows = rows.join(cold, F.col("__open") == F.col("__level"), "left")
    return rows.select(*df.columns, F.coalesce("__hot", "__cold").alias(name))


def encode_levels(df: DataFrame, levels: Levels) -> DataFrame:
    """``df`` with ``{column}_idx`` and the sparse 0/1 vector ``{column}_vec`` over all levels (all zero for an unseen one)."""
    name, out = f"{levels.column}_idx", f"{levels.column}_vec"
    indexed = index_levels(df, levels).withColumn("__at", F.coalesce(F.col(name), F.lit(levels.size)).cast("double"))
    # One slot more than levels: the last is the unseen level, which dropLast leaves out of the vector.
    sizes = df.sparkSession.createDataFrame([(float(levels.size),)], "__at double")
    model = OneHotEncoder(inputCols=["__at"], outputCols=[out], dropLast=True).fit(sizes)
    return model.transform(indexed).drop("__at")


def set_places(vector: str) -> Column:
    """A sparse vector column as ``struct<size long, places array<int>, values array<double>>``: what is stored, of a row's own
    size.  A dense array of all levels would make rows times levels numbers."""
    v = F.unwrap_udt(F.col(vector))
    return F.struct(v["size"].cast("long").alias("size"), v["indices"].alias("places"), v["values"].alias("values"))
