"""Raw file sources: tolerant CSV scans, file resolution and artifact reads.

CSV rule: every column is read as text with an explicit schema (never
inferred), plus a corrupt-record column.  A row with too many or too few
fields fills that column; :func:`split_valid` separates such rows into a
quarantine set instead of silently dropping them.

``multiline=True`` keeps a quoted field that holds a newline inside its row; files are
still cut in many tasks (:mod:`eventlens.sources.quoted`; UTF-8 only, other encodings are
read in one task per file).  ``multiline=False`` takes every line as a row and needs one pass less.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlens.constants import EVENT_FILE_GLOB, EVENTS_ENV, RAW_EVENT_COLUMNS, RAW_SOCDEM_COLUMNS, SOCDEM_ENV
from eventlens.sources.quoted import read_quoted_csv

CORRUPT = "_corrupt_record"


def _reader(spark: SparkSession, multiline: bool, sep: str, encoding: str, header: bool = True):
    return (
        spark.read.option("header", header)
        .option("multiLine", multiline)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
    )


def csv_header(spark: SparkSession, path: str, *, multiline: bool = True, sep: str = ",", encoding: str = "UTF-8"):
    """Column names of the header line (reads only the first line)."""
    return _reader(spark, multiline, sep, encoding).option("inferSchema", False).csv(path).columns


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    *,
    multiline: bool = True,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
) -> DataFrame:
    """All-text scan with a corrupt-record column.

    ``columns`` are the header names in file order; by default they are read
    from the header line, so a file whose columns come in another order is
    still mapped by name.
    """
    if columns is None:
        if not header:
            raise ValueError("columns are required for a file without a header line")
        columns = csv_header(spark, path, multiline=multiline, sep=sep, encoding=encoding)
    if multiline and encoding.upper().replace("-", "") == "UTF8":
        return read_quoted_csv(spark, path, columns, corrupt=CORRUPT, sep=sep, header=header)
    schema = T.StructType(
        [T.StructField(c, T.StringType(), True) for c in columns] + [T.StructField(CORRUPT, T.StringType(), True)]
    )
    return (
        _reader(spark, multiline, sep, encoding, header)
        .schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .csv(path)
    )


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows without the corrupt column, quarantined rows)``.

    Spark's CSV source refuses a query whose only needed column is the
    corrupt-record column (e.g. ``count()`` after the filter).  Both filters
    therefore also read the first data column through a test that is always
    true but not constant-folded, so either side can be counted directly.
    """
    first = next(c for c in raw.columns if c != CORRUPT)
    keep_scanned = F.length(F.coalesce(F.col(first), F.lit(""))) >= 0
    good = raw.filter(F.col(CORRUPT).isNull() & keep_scanned).drop(CORRUPT)
    bad = raw.filter(F.col(CORRUPT).isNotNull() & keep_scanned)
    return good, bad


def read_events_csv(spark: SparkSession, path: str, **kw) -> tuple[DataFrame, DataFrame]:
    return split_valid(read_raw_csv(spark, path, **kw))


def read_socdem_csv(spark: SparkSession, path: str, **kw) -> tuple[DataFrame, DataFrame]:
    return split_valid(read_raw_csv(spark, path, **kw))


EVENTS_HEADER = [raw for raw, _ in RAW_EVENT_COLUMNS]
SOCDEM_HEADER = [raw for raw, _ in RAW_SOCDEM_COLUMNS]


# --- file resolution -------------------------------------------------------

def list_files(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """``(path, modificationTime, length)`` of files under ``directory``.

    The binary-file source reads file content only when the content column
    is selected, so this is a listing, distributed like any scan.
    """
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory).select("path", "modificationTime", "length")


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        return list_files(spark, path).limit(1).count() > 0
    except AnalysisException:
        return False


def newest_file(spark: SparkSession, directory: str, glob: str = EVENT_FILE_GLOB) -> str:
    """Path of the most recently modified matching file (one-row aggregate)."""
    try:
        row = list_files(spark, directory, glob).agg(F.max_by("path", "modificationTime").alias("p")).first()
    except AnalysisException as e:
        raise FileNotFoundError(f"no input directory {directory}") from e
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no files matching {glob} in {directory}")
    return row["p"]


def resolve_source(
    spark: SparkSession,
    *,
    env_var: str | None = None,
    explicit: str | None = None,
    directory: str | None = None,
    default_name: str | None = None,
    glob: str | None = None,
) -> str:
    """Resolve an input file: environment variable, then explicit path, then
    the newest ``glob`` match (or ``default_name``) in ``directory``.

    A named file that does not exist is an error, never a silent fallback.
    """
    for label, candidate in (("environment", os.environ.get(env_var) if env_var else None), ("argument", explicit)):
        if candidate:
            if not path_exists(spark, candidate):
                raise FileNotFoundError(f"{label} names a missing file: {candidate}")
            return candidate
    if directory is None:
        raise FileNotFoundError("no input given and no directory to search")
    if default_name is not None:
        p = directory.rstrip("/") + "/" + default_name
        if not path_exists(spark, p):
            raise FileNotFoundError(f"input file not found: {p}")
        return p
    return newest_file(spark, directory, glob or EVENT_FILE_GLOB)


def resolve_events_source(spark: SparkSession, explicit: str | None = None, directory: str | None = None) -> str:
    return resolve_source(spark, env_var=EVENTS_ENV, explicit=explicit, directory=directory, glob=EVENT_FILE_GLOB)


def resolve_socdem_source(
    spark: SparkSession, explicit: str | None = None, directory: str | None = None, default_name: str | None = None
) -> str:
    from eventlens.constants import DEFAULT_SOCDEM_FILE

    return resolve_source(
        spark, env_var=SOCDEM_ENV, explicit=explicit, directory=directory, default_name=default_name or DEFAULT_SOCDEM_FILE
    )


# --- artifact reads ----------------------------------------------------------

def read_json_artifact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON artifact with a fixed schema; an empty table when it is absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.option("multiLine", True).option("allowNonNumericNumbers", True).schema(schema).json(path)


def read_csv_artifact(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV artifact with header and a fixed schema; empty when absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)
