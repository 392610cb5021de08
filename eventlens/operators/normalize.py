"""Normalisation of raw event and socio-demographic text tables.

Raw tables arrive as all-text columns (see :mod:`eventlens.sources.files`).
Normalising is one projection of tolerant casts, one validity filter and an
optional whole-row DISTINCT.  The projection and filter are narrow (no
shuffle); DISTINCT is the only shuffle, hash-partitioned on all columns, so
exact copies meet in one task whatever the skew of any single column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlens.constants import RAW_EVENT_COLUMNS, RAW_SOCDEM_COLUMNS
from eventlens.functions.casts import blank_to_null, safe_int, safe_long, safe_timestamp

EVENT_COLUMNS = [name for _, name in RAW_EVENT_COLUMNS]
_LONG_EVENT_COLUMNS = {"device_id", "device_session_id"}


def _roles(default: list[tuple[str, str]], roles: Mapping[str, str] | None) -> dict[str, str]:
    if roles is None:
        return {norm: raw for raw, norm in default}
    return dict(roles)


def _text(raw: DataFrame, roles: Mapping[str, str], name: str) -> Column:
    src = roles.get(name)
    if src is None or src not in raw.columns:
        return F.lit(None).cast("string")
    return F.col(src)


def event_projection(raw: DataFrame, roles: Mapping[str, str] | None = None, *, lenient_ints: bool = False) -> DataFrame:
    """Typed event columns from raw text, before any row is dropped.

    ``roles`` maps each normalised name to its raw column; absent roles become
    NULL, but time and device must be there.  Defaults to the raw file's own headers.
    """
    r = _roles(RAW_EVENT_COLUMNS, roles)
    lacking = [r.get(c, c) for c in ("event_ts", "device_id") if r.get(c) not in raw.columns]
    if lacking:
        raise ValueError(f"not an event table: no column {lacking} among {raw.columns}")
    cols = []
    for name in EVENT_COLUMNS:
        text = _text(raw, r, name)
        if name == "event_ts":
            cols.append(safe_timestamp(text).alias(name))
        elif name in _LONG_EVENT_COLUMNS:
            cols.append(safe_long(text, lenient_ints).alias(name))
        else:
            cols.append(blank_to_null(text).alias(name))
    return raw.select(*cols)


def valid_event(require_device: bool = True) -> Column:
    cond = F.col("event_ts").isNotNull()
    if require_device:
        cond = cond & F.col("device_id").isNotNull()
    return cond


def normalize_events(
    raw: DataFrame,
    roles: Mapping[str, str] | None = None,
    *,
    dedupe: bool = True,
    require_device: bool = True,
    lenient_ints: bool = False,
) -> DataFrame:
    """Clean, typed event table.

    Keeps rows with a parseable time (and a device, unless
    ``require_device=False``) and removes exact copies (unless
    ``dedupe=False``).  ``dedupe=False, require_device=False`` is the older
    variant of the job.  Without DISTINCT the operator is stateless, so it
    also accepts a streaming DataFrame.
    """
    out = event_projection(raw, roles, lenient_ints=lenient_ints).filter(valid_event(require_device))
    return out.distinct() if dedupe else out


def normalize_counts(
    raw: DataFrame,
    roles: Mapping[str, str] | None = None,
    *,
    require_device: bool = True,
    lenient_ints: bool = False,
) -> DataFrame:
    """One row: raw rows, valid rows and distinct valid rows, in one pass.

    The distinct count is ``count(DISTINCT struct(*))`` over valid rows; a
    struct is never NULL, so rows holding NULL fields are counted too.
    """
    proj = event_projection(raw, roles, lenient_ints=lenient_ints)
    valid = valid_event(require_device)
    row = F.struct(*[F.col(c) for c in EVENT_COLUMNS])
    return proj.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.countDistinct(F.when(valid, row)).alias("distinct_rows"),
    )


def normalize_socdem(raw: DataFrame, roles: Mapping[str, str] | None = None, *, lenient_ints: bool = False) -> DataFrame:
    """``(device_id, age, gender)``; rows without a device dropped; exact copies removed.

    A device may keep several rows (different ages or genders); see
    :func:`unique_socdem` for one row per device.
    """
    r = _roles(RAW_SOCDEM_COLUMNS, roles)
    return (
        raw.select(
            safe_long(_text(raw, r, "device_id"), lenient_ints).alias("device_id"),
            safe_int(_text(raw, r, "age"), lenient_ints).alias("age"),
            blank_to_null(_text(raw, r, "gender")).alias("gender"),
        )
        .filter(F.col("device_id").isNotNull())
        .distinct()
    )


def unique_socdem(socdem: DataFrame) -> DataFrame:
    """One row per device: the greatest age, then the greatest gender.

    ``max(struct(age, gender))`` is an algebraic aggregate, so it combines
    map-side and a device with many rows never gathers them in one task.
    """
    best = socdem.groupBy("device_id").agg(F.max(F.struct("age", "gender")).alias("b"))
    return best.select("device_id", F.col("b.age").alias("age"), F.col("b.gender").alias("gender"))
