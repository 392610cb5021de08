"""Ingestion job: raw events and socdem CSV → clean Parquet tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.normalize import (
    event_projection,
    normalize_events,
    normalize_socdem,
    valid_event,
)
from eventlens.session import stage_table
from eventlens.sinks.writers import write_parquet
from eventlens.sources import files


@dataclass(frozen=True)
class BuildResult:
    events_path: str
    socdem_path: str | None
    raw_rows: int
    valid_rows: int
    written_rows: int
    quarantined_rows: int
    socdem_rows: int | None


def build_events(
    spark: SparkSession,
    source: str,
    out_path: str,
    *,
    quarantine_path: str | None = None,
    dedupe: bool = True,
    require_device: bool = True,
    lenient_ints: bool = False,
    multiline: bool = True,
    partition_by_date: bool = False,
) -> tuple[int, int, int, int]:
    """Write the clean event table; return (raw, valid, written, quarantined).

    Counts are reported separately: raw parsed rows, rows passing the validity
    rule, and rows written after DISTINCT.  The file is parsed once, into a
    staged Parquet table that everything else reads; written and quarantined
    counts are read from Parquet footers.
    """
    raw = stage_table(spark, files.read_raw_csv(spark, source, multiline=multiline), "raw-events")
    good, bad = files.split_valid(raw)
    quarantined = 0
    if quarantine_path:
        write_parquet(bad, quarantine_path)
        quarantined = spark.read.parquet(quarantine_path).count()

    clean = normalize_events(good, dedupe=dedupe, require_device=require_device, lenient_ints=lenient_ints)
    if partition_by_date:
        clean = clean.withColumn("event_date", F.to_date("event_ts"))
        write_parquet(clean, out_path, partition_by=["event_date"])
    else:
        write_parquet(clean, out_path)

    proj = event_projection(good, lenient_ints=lenient_ints)
    counts = proj.agg(F.count(F.lit(1)).alias("raw"), F.count_if(valid_event(require_device)).alias("valid")).first()
    written = spark.read.parquet(out_path).count()
    return counts["raw"], counts["valid"], written, quarantined


def build_socdem(spark: SparkSession, source: str, out_path: str, *, lenient_ints: bool = False) -> int:
    raw = files.read_raw_csv(spark, source)
    good, _ = files.split_valid(raw)
    write_parquet(normalize_socdem(good, lenient_ints=lenient_ints), out_path)
    return spark.read.parquet(out_path).count()


def build_tables(
    spark: SparkSession,
    out_dir: str,
    *,
    events_source: str | None = None,
    socdem_source: str | None = None,
    raw_dir: str | None = None,
    quarantine: bool = True,
    **kw,
) -> BuildResult:
    """Resolve sources (env var, argument, newest file), then build both tables."""
    ev_src = files.resolve_events_source(spark, events_source, raw_dir)
    ev_out = out_dir.rstrip("/") + "/events.parquet"
    q_out = out_dir.rstrip("/") + "/events_quarantine.parquet" if quarantine else None
    raw_n, valid_n, written_n, bad_n = build_events(spark, ev_src, ev_out, quarantine_path=q_out, **kw)
    so_out, so_n = None, None
    if socdem_source is not None or raw_dir is not None:
        so_src = files.resolve_socdem_source(spark, socdem_source, raw_dir)
        so_out = out_dir.rstrip("/") + "/socdem.parquet"
        so_n = build_socdem(spark, so_src, so_out)
    return BuildResult(ev_out, so_out, raw_n, valid_n, written_n, bad_n, so_n)
