"""Session helpers: a tuned local session for tests and a checkpoint folder lookup."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "eventlens",
    time_zone: str = "UTC",
    driver_memory: str | None = None,
) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster the caller's session is used as it is; this helper is for
    tests, benches and single-machine runs.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, creating a scratch one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that setting
    always wins.  Only a local-mode session with nothing set (tests, a
    laptop) gets a fresh scratch folder; a cluster session without the
    setting is an error rather than a silent machine-local folder.
    """
    existing = checkpoint_dir(spark)
    if existing:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by the cluster; "
            "a machine-local scratch folder is only used in local mode"
        )
    scratch = tempfile.mkdtemp(prefix="eventlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch


def stage_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    The plan above is cut there: whatever reads the table sees the same rows in
    the same partitions' order, and a lost executor costs no recomputation of
    what lies below.
    """
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/eventlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._eventlens_path = path
    return table


def drop_stage(table: DataFrame) -> None:
    """Delete the files of a table that :func:`stage_table` returned and that nothing reads any more."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._eventlens_path)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
