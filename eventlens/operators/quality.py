"""Input preconditions: columns present, enough rows, enough classes.

All checks that need data run as ONE aggregate (row count and distinct class
count together), so a guard costs one pass, and ``min_rows`` alone stops at
the first ``min_rows`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class InputError(ValueError):
    """The input does not meet an operator's preconditions."""


def require(
    df: DataFrame,
    columns: Sequence[str] = (),
    *,
    min_rows: int = 1,
    class_col: str | None = None,
    min_classes: int = 2,
    what: str = "input",
) -> None:
    """Raise :class:`InputError` unless ``df`` has ``columns``, at least
    ``min_rows`` rows and (with ``class_col``) at least ``min_classes``
    distinct non-null classes."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise InputError(f"{what}: missing columns {missing}; available: {df.columns}")
    if class_col is None:
        if min_rows <= 0:
            return
        n = df.limit(min_rows).count()
        if n < min_rows:
            raise InputError(f"{what}: {n} rows, need at least {min_rows}" if n else f"{what} is empty")
        return
    row = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(class_col).alias("k")).first()
    if row["n"] < min_rows:
        raise InputError(f"{what}: {row['n']} rows, need at least {min_rows}" if row["n"] else f"{what} is empty")
    if row["k"] < min_classes:
        raise InputError(f"{what}: {row['k']} classes in {class_col}, need at least {min_classes}")
