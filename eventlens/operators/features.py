"""Per-device behaviour features, the churn label and the churn dataset.

Scale notes.  All three are keyed on the device, so they are computed in ONE
aggregation over the log: the windowed feature measures are conditional
aggregates (``count_if``, ``count(DISTINCT CASE WHEN in_window ...)``) and the
label needs only ``max(ts)`` over the whole log.  The reference runs two
aggregations and joins them; here the scan, the shuffle and the join are done
once.  The time bounds come from one global ``max(ts)`` (a one-row action) and
enter the plan as literals, so a window-only query gets ``PushedFilters`` on
the scan.  The four distinct counts are (kind, value) pairs in one first
aggregate; every distinct value is deduplicated map-side, so a device with a
third of all events still ships only its distinct values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.constants import DEFAULT_KEYWORDS, FEATURE_DAYS, LABEL_DAYS
from eventlens.functions.text import flag, has_keyword
from eventlens.functions.time import (
    column_type,
    ensure_timestamp,
    local_date,
    max_timestamp,
    shift,
    ts_literal,
)
from eventlens.operators.normalize import unique_socdem as _unique_socdem
from eventlens.operators.selection import medians
from eventlens.session import stage_table


#: Behaviour measures that count distinct values, in the order of their kind (kind 0 is the row itself).
_DISTINCT = ("active_days", "sessions_cnt", "screens_cnt", "features_cnt")


def _per_device(
    events: DataFrame,
    keywords: Mapping[str, str],
    ts: str,
    device: str,
    session: str,
    screen: str,
    feature: str,
    tz: str | None,
    within: Column | None = None,
    *extra: Column,
) -> DataFrame:
    """Eight measures per device over the rows ``within``, and ``extra`` sums or maxima over all rows.

    Each row becomes one (kind, value) pair per distinct count and one for the row
    itself.  The first aggregate is keyed on (device, kind, value), so a device
    with a third of all events spreads over as many tasks as it has values; the
    second one counts what is left.
    """
    day = local_date(F.col(ts), column_type(events, ts), tz)
    inside = F.lit(True) if within is None else within
    values = [day, F.col(session), F.col(screen), F.col(feature)]
    pairs = F.array(
        F.struct(F.lit(0).alias("kind"), F.lit(None).cast("string").alias("value")),
        *[F.struct(F.lit(i).alias("kind"), F.when(inside, v).cast("string").alias("value")) for i, v in enumerate(values, 1)],
    )
    hits = {f"{name}_events": flag(has_keyword(F.col(feature), kw) & inside) for name, kw in keywords.items()}
    rows = events.select(
        F.col(device), flag(inside).alias("_in"), *[h.alias(n) for n, h in hits.items()], *extra,
        F.explode(F.filter(pairs, lambda p: (p["kind"] == 0) | p["value"].isNotNull())).alias("_p"),
    ).select(device, "_p.*", "_in", *hits, *[F.col(c) for c in _names(extra)])
    itself = F.col("kind") == 0
    distinct = rows.groupBy(device, "kind", "value").agg(
        F.sum(F.when(itself, F.col("_in"))).alias("_in"), *[F.sum(F.when(itself, F.col(n))).alias(n) for n in hits],
        *[F.max(c).alias(c) for c in _names(extra)],
    )
    counts = [F.count_if(F.col("kind") == i).alias(n) for i, n in enumerate(_DISTINCT, 1)]
    return distinct.groupBy(device).agg(
        F.sum("_in").cast("bigint").alias("events_cnt"), *counts, *[F.sum(n).cast("bigint").alias(n) for n in hits],
        *[F.max(c).alias(c) for c in _names(extra)],
    )


def _names(columns: tuple[Column, ...]) -> list[str]:
    return [f"_x{i}" for i in range(len(columns))]


def device_features(
    events: DataFrame,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    *,
    ts: str = "event_ts",
    device: str = "device_id",
    session: str = "device_session_id",
    screen: str = "screen",
    feature: str = "feature",
    tz: str | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """Eight behaviour measures per device over ``[start, end)`` (open when None).

    ``start``/``end`` are values of the timestamp column's own kind (naive
    ``datetime`` for wall-clock columns, epoch microseconds for instants).
    """
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    src = events
    if start is not None:
        src = src.filter(F.col(ts) >= ts_literal(start, dtype))
    if end is not None:
        src = src.filter(F.col(ts) < ts_literal(end, dtype))
    return _per_device(src, keywords, ts, device, session, screen, feature, tz)


def daily_sketches(
    events: DataFrame,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    *,
    ts: str = "event_ts",
    device: str = "device_id",
    session: str = "device_session_id",
    screen: str = "screen",
    feature: str = "feature",
    tz: str | None = None,
    lg_k: int = 12,
) -> DataFrame:
    """One row per device and day: event and keyword counts, and mergeable sketches of sessions, screens and features.

    Days can be computed as they arrive and any range of them merged later by
    :func:`features_from_days` without reading the log again."""
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    sketch = lambda c: F.hll_sketch_agg(F.col(c).cast("string"), lg_k)
    hits = [F.sum(flag(has_keyword(F.col(feature), kw))).cast("bigint").alias(f"{n}_events") for n, kw in keywords.items()]
    return events.groupBy(device, local_date(F.col(ts), dtype, tz).alias("day")).agg(
        F.count(F.lit(1)).alias("events_cnt"), sketch(session).alias("sessions"), sketch(screen).alias("screens"),
        sketch(feature).alias("features"), *hits,
    )


def features_from_days(days: DataFrame, *, device: str = "device_id", first=None, last=None) -> DataFrame:
    """The eight measures per device from :func:`daily_sketches`, over days ``first`` to ``last`` (both included).

    Days, events and keyword counts are exact.  Sessions, screens and features
    are estimates with a relative standard error of about ``1.04 / sqrt(2 ** lg_k)``
    (1.6 % for the default) above a few hundred distinct values, below that they
    are exact but for hash collisions."""
    if first is not None:
        days = days.where(F.col("day") >= F.lit(first))
    if last is not None:
        days = days.where(F.col("day") <= F.lit(last))
    merged = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    hits = [F.sum(c).alias(c) for c in days.columns if c.endswith("_events")]
    return days.groupBy(device).agg(
        F.sum("events_cnt").alias("events_cnt"), F.count("day").alias("active_days"), merged("sessions").alias("sessions_cnt"),
        merged("screens").alias("screens_cnt"), merged("features").alias("features_cnt"), *hits,
    )


def churn_bounds(events: DataFrame, ts: str = "event_ts", feature_days: float = FEATURE_DAYS, label_days: float = LABEL_DAYS):
    """(max_ts, cutoff, feature_start) from one global max; None when empty."""
    dtype = column_type(events, ts)
    top = max_timestamp(events, ts)
    if top is None:
        return None
    cutoff = shift(top, dtype, label_days)
    return top, cutoff, shift(cutoff, dtype, feature_days)


def churn_label(events: DataFrame, label_days: float = LABEL_DAYS, *, ts: str = "event_ts", device: str = "device_id") -> DataFrame:
    """``(device_id, churn)``: 1 when the device's last event precedes
    ``max_ts - label_days``, else 0.  Every device in the log gets a label."""
    dtype = column_type(events, ts)
    bounds = churn_bounds(events, ts, 0, label_days)
    if bounds is None:
        return events.select(device, F.lit(0).alias("churn")).limit(0)
    cutoff = ts_literal(bounds[1], dtype)
    return events.groupBy(device).agg(F.when(F.max(ts) >= cutoff, 0).otherwise(1).alias("churn"))


def churn_dataset(
    events: DataFrame,
    socdem: DataFrame,
    feature_days: float = FEATURE_DAYS,
    label_days: float = LABEL_DAYS,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    *,
    ts: str = "event_ts",
    device: str = "device_id",
    session: str = "device_session_id",
    screen: str = "screen",
    feature: str = "feature",
    tz: str | None = None,
    unique_socdem: bool = False,
) -> DataFrame:
    """Features on ``[cutoff - feature_days, cutoff)``, label after ``cutoff``,
    plus age and gender.

    Devices without events in the feature window are left out; a device with
    several socdem rows yields several rows unless ``unique_socdem=True``.
    """
    dtype = column_type(events, ts)
    ensure_timestamp(dtype)
    bounds = churn_bounds(events, ts, feature_days, label_days)
    if bounds is None:
        raise ValueError("event table is empty")
    _, cutoff, start = bounds
    cut_lit, start_lit = ts_literal(cutoff, dtype), ts_literal(start, dtype)
    within = (F.col(ts) >= start_lit) & (F.col(ts) < cut_lit)
    per_device = (
        # A device in the window has its label decided by events from the cutoff on, so nothing before the window is read.
        _per_device(
            events.filter(F.col(device).isNotNull() & (F.col(ts) >= start_lit)),
            keywords, ts, device, session, screen, feature, tz, within, F.col(ts).alias("_x0"),
        )
        .filter(F.col("events_cnt") > 0)
        .withColumnRenamed("_x0", "_last_ts")
    )
    measures = [c for c in per_device.columns if c not in (device, "_last_ts")]
    labelled = per_device.select(
        device, *measures, F.when(F.col("_last_ts") >= cut_lit, 0).otherwise(1).alias("churn")
    )
    dem = socdem.select(F.col("device_id").alias(device), "age", "gender")
    if unique_socdem:
        dem = _unique_socdem(dem.withColumnRenamed(device, "device_id")).withColumnRenamed("device_id", device)
    return labelled.join(dem, device, "left")


def impute_and_encode(
    ds: DataFrame,
    *,
    numeric_fill: tuple[str, ...] = ("age",),
    category: str = "gender",
    unknown: str = "U",
    max_levels: int = 1000,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Median-fill numeric columns, fill the category with ``unknown`` and add
    one 0/1 column per level (all levels kept), named ``{category}_{level}``.

    The medians are exact (interpolating, by histogram refinement) over the whole
    dataset (or over ``fit_on``, e.g. the training side).  The levels are the
    distinct category values, fetched with ``limit(max_levels + 1)`` so the
    driver never receives more than that; for a column of more levels, one column
    per level is no table, and :mod:`eventlens.operators.levels` makes sparse vectors.
    The dataset is read from a written table after the first pass.
    """
    ds = stage_table(ds.sparkSession, ds, "dataset")
    filled_cat = F.coalesce(F.col(category), F.lit(unknown))
    src = ds if fit_on is None else fit_on
    stats = medians(src, numeric_fill)
    found = src.select(filled_cat.alias("lv")).distinct().limit(max_levels + 1).collect()
    if len(found) > max_levels:
        raise ValueError(f"{category} has more than {max_levels} levels: use encode_levels")
    levels = sorted(r["lv"] for r in found)
    out = ds
    for c in numeric_fill:
        med = stats[c]
        if med is None:
            raise ValueError(f"column {c} has no values to take a median from")
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(med).cast("double")))
    out = out.withColumn(category, filled_cat)
    for lv in levels:
        out = out.withColumn(f"{category}_{lv}", (F.col(category) == F.lit(lv)).cast("int"))
    return out.drop(category)
