"""Parquet table scans and named views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SCANS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str, *, reuse: bool = True) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet``; column pruning and filters reach the scan.

    The scan (a lazy plan: file listing and schema, no data) is reused within
    a session, so repeated queries skip the listing and footer reads.
    """
    path = table_path(sf_dir, name)
    if not reuse:
        return spark.read.parquet(path)
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _SCANS[key] = df
    return df


def parquet_view(spark: SparkSession, path: str, view: str) -> DataFrame:
    """Expose a Parquet path as a named temp view (lazy, nothing is read)."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(view)
    return df
