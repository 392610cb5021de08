"""Day bucketing and timestamp literals that work for both timestamp kinds.

Spark has two timestamp types: ``timestamp`` (an instant, shown in the session
zone) and ``timestamp_ntz`` (a wall-clock value).  The product's event table
holds instants; the test tables hold wall-clock values.  Every helper here
takes the column's data type so one code path serves both, and every result
stays a built-in expression (no UDF).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType, TimestampType


def _session_tz() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"


def column_type(df: DataFrame, name: str) -> DataType:
    return df.schema[name].dataType


def is_wall_clock(dtype: DataType) -> bool:
    return isinstance(dtype, TimestampNTZType)


def local_date(ts: Column, dtype: DataType, tz: str | None = None) -> Column:
    """Calendar date of ``ts`` (``DateType``).

    Wall-clock input: its own date, ``tz`` ignored.  Instant input: the date in
    ``tz``, or in the session zone when ``tz`` is None (the reference behaviour,
    whose day buckets follow the host zone).
    """
    if is_wall_clock(dtype):
        return F.to_date(ts)
    if tz is None:
        return F.to_date(ts)
    wall = F.convert_timezone(F.lit(_session_tz()), F.lit(tz), ts.cast("timestamp_ntz"))
    return F.to_date(wall)


def day_start(ts: Column, dtype: DataType, tz: str | None = None) -> Column:
    """Midnight that starts the day of ``ts`` (``date_trunc('day', ts)``).

    Wall-clock input gives ``timestamp_ntz``.  Instant input with ``tz=None``
    gives an instant at session-zone midnight (exactly ``date_trunc``); with a
    ``tz`` it gives the wall-clock midnight in that zone as ``timestamp_ntz``.
    """
    return date_to_day_start(local_date(ts, dtype, tz), dtype, tz)


def date_to_day_start(d: Column, dtype: DataType, tz: str | None = None) -> Column:
    if is_wall_clock(dtype) or tz is not None:
        return d.cast("timestamp_ntz")
    return d.cast("timestamp")


def ts_literal(value, dtype: DataType) -> Column:
    """A timestamp literal of the column's own type, folded by Catalyst.

    ``value`` is a naive ``datetime`` for wall-clock columns and epoch
    microseconds for instant columns (see :func:`max_timestamp`).  Both forms
    fold to a literal, so a comparison against it reaches the Parquet scan as
    a pushed filter.
    """
    if is_wall_clock(dtype):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.timestamp_micros(F.lit(int(value)))


def max_timestamp(df: DataFrame, ts: str):
    """Global maximum of ``ts`` as a value usable by :func:`ts_literal`.

    One bounded action (a one-row aggregate).  Returns None for an empty input.
    """
    dtype = column_type(df, ts)
    if is_wall_clock(dtype):
        return df.agg(F.max(ts).alias("m")).first()["m"]
    return df.agg(F.unix_micros(F.max(ts)).alias("m")).first()["m"]


def shift(value, dtype: DataType, days: float):
    """``value - days`` in the representation used by :func:`ts_literal`."""
    if is_wall_clock(dtype):
        return value - dt.timedelta(days=days)
    return int(value) - int(round(days * 86_400_000_000))


def ensure_timestamp(dtype: DataType) -> None:
    if not isinstance(dtype, (TimestampType, TimestampNTZType)):
        raise TypeError(f"expected a timestamp column, got {dtype.simpleString()}")
