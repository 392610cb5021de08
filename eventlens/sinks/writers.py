"""Sinks: Parquet tables, CSV reports, JSON metrics and saved models.

Each writes a directory of part files (one per task), so a write never
funnels through one task unless the caller asks for a single file of a
small, already-aggregated report.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str, *, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """ZSTD Parquet.  ``partition_by`` (e.g. an event date) lets later time
    filters prune whole folders."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, *, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with a header, quotes doubled (as the reader and other tools take them).

    ``single_file`` is for small aggregated reports only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> str:
    """JSON lines, one object per row (metric tables are one row)."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
    return path


def metrics_frame(spark: SparkSession, metrics: Mapping[str, object], schema: T.StructType | None = None) -> DataFrame:
    """One-row DataFrame of scalar metrics (NaN kept as NaN)."""
    row = {k: (float(v) if isinstance(v, float) else v) for k, v in metrics.items()}
    if schema is not None:
        return spark.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)
    return spark.createDataFrame([row])



def save_model(model, path: str) -> str:
    """Save a fitted Spark ML model or pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path
