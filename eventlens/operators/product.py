"""Product analytics over the event table: DAU, top features, OS split,
cohort retention and daily feature adoption.

Scale notes (each is one or two hash aggregations, no join):

* DAU and devices-by-OS have few group keys but many distinct devices.  Spark
  plans ``count(DISTINCT device)`` as a two-level aggregate whose first shuffle
  is keyed on (day, device) / (os, device), so work spreads over all tasks even
  when one day or one OS holds most rows.
* Top features is a partial + final count followed by ``TakeOrderedAndProject``
  (a bounded top-k, never a full sort).
* Retention needs, per device, its first day and whether it came back on day
  +k.  One hash aggregation keyed on the device ORs each day into a bitmap of
  64-day words (combined map-side, a few longs per device); the first day and
  the days after it are read off the bits, so the plan has one shuffle and no
  join of the raw log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.constants import DEFAULT_KEYWORDS
from eventlens.functions.text import flag, has_keyword
from eventlens.functions.time import (
    column_type,
    date_to_day_start,
    day_start,
    ensure_timestamp,
    local_date,
)


def dau(events: DataFrame, *, ts: str = "event_ts", device: str = "device_id", tz: str | None = None) -> DataFrame:
    """Distinct devices per calendar day: ``(d, dau)`` ordered by day."""
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    return (
        events.groupBy(day_start(F.col(ts), dtype, tz).alias("d"))
        .agg(F.countDistinct(device).alias("dau"))
        .orderBy(F.asc_nulls_last("d"))
    )


def top_features(events: DataFrame, k: int = 20, *, feature: str = "feature") -> DataFrame:
    """The ``k`` features with most events: ``(feature, cnt)``.

    A NULL feature is a group of its own.  Ties on the count are broken by the
    feature name so the result is deterministic.
    """
    return (
        events.groupBy(feature)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc_nulls_last(feature))
        .limit(k)
    )


def devices_by_os(events: DataFrame, *, os_col: str = "os", device: str = "device_id") -> DataFrame:
    """Distinct devices per OS (NULL OS is a group): ``(os, devices)``."""
    return (
        events.groupBy(os_col)
        .agg(F.countDistinct(device).alias("devices"))
        .orderBy(F.desc("devices"), F.asc_nulls_last(os_col))
    )


def retention(
    events: DataFrame,
    offsets: Sequence[int] = (1, 7),
    *,
    ts: str = "event_ts",
    device: str = "device_id",
    tz: str | None = None,
    censor: bool = False,
) -> DataFrame:
    """Share of each first-seen cohort active again on exactly day +k.

    Returns ``(cohort_day, cohort_size, retention_d{k}...)`` ordered by cohort.
    With ``censor=True`` a cohort whose day +k lies after the last day in the
    log gets NULL instead of 0 for that offset.  A NULL device forms one
    cohort member that never counts as retained.
    """
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    day = local_date(F.col(ts), dtype, tz)
    # The log's first and last day: so many 64-day words hold every device's days.
    edge = events.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    base, last_day = (edge["first"], edge["last"] if censor else None)
    n_words = (edge["last"] - base).days // 64 + 1 if base is not None else 1
    at = F.date_diff(day, F.lit(base).cast("date"))
    bit = F.expr("shiftleft(1L, _at % 64)")
    words = [f"_w{i}" for i in range(n_words)]
    per_device = events.select(device, at.alias("_at")).groupBy(device).agg(
        *[F.bit_or(F.when(F.floor(F.col("_at") / 64) == i, bit)).alias(w) for i, w in enumerate(words)]
    )
    # The lowest bit of the first word that has one.
    lowest = [F.bit_count(F.col(w).bitwiseAND(-F.col(w)) - 1) + 64 * i for i, w in enumerate(words)]
    first = F.coalesce(*[F.when(F.col(w) != 0, n) for w, n in zip(words, lowest)])

    def active(k: int) -> Column:
        spot = F.col("_first") + k
        word = F.get(F.array(*words), F.floor(spot / 64).cast("int"))
        return F.coalesce(F.getbit(word, spot % 64), F.lit(0)).cast("int") if k >= 0 else F.lit(0)

    flags = [
        F.when(F.col(device).isNull(), F.lit(0)).when(F.col("_first").isNotNull(), active(k)).alias(f"d{k}") for k in offsets
    ]
    per_device = per_device.withColumn("_first", first).select(F.date_add(F.lit(base).cast("date"), F.col("_first")).alias("cohort"), *flags)

    aggs = [F.count(F.lit(1)).alias("cohort_size")]
    for k in offsets:
        rate = F.avg(f"d{k}")
        if last_day is not None:
            rate = F.when(F.date_add(F.col("cohort"), k) <= F.lit(last_day), rate)
        aggs.append(rate.alias(f"retention_d{k}"))
    out = per_device.groupBy("cohort").agg(*aggs)
    return out.select(
        date_to_day_start(F.col("cohort"), dtype, tz).alias("cohort_day"),
        *[c for c in out.columns if c != "cohort"],
    ).orderBy(F.asc_nulls_last("cohort_day"))


def adoption(
    events: DataFrame,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    *,
    ts: str = "event_ts",
    device: str = "device_id",
    feature: str = "feature",
    tz: str | None = None,
) -> DataFrame:
    """Per day, the share of active devices that used each keyword feature.

    Returns ``(d, {name}_adoption...)`` ordered by day.  Two aggregations: the
    first (keyed on day and device, with a map-side partial) collapses the log
    to one row per active device-day, the second averages the flags per day.
    """
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    daily = events.groupBy(day_start(F.col(ts), dtype, tz).alias("d"), F.col(device)).agg(
        *[F.max(flag(has_keyword(F.col(feature), kw))).alias(f"used_{name}") for name, kw in keywords.items()]
    )
    return (
        daily.groupBy("d")
        .agg(*[F.avg(f"used_{name}").alias(f"{name}_adoption") for name in keywords])
        .orderBy(F.asc_nulls_last("d"))
    )
