"""Adapter views that give the shared test tables the product's shapes.

The product works on app events, socio-demographics and labelled texts.  The
shared test tables are a generic star schema plus an event log, so each
adapter is a projection of those tables into the product's columns.  Each
function here has a twin SQL text (``*_SQL``) for DuckDB, used by the oracle
checks; the two must stay equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.sources.tables import read_table

# Keywords that play pay / ticket / meter on the test event log.
TEST_KEYWORDS = {"pay": "purch", "ticket": "error", "meter": "view"}


def app_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → (event_ts, device_id, device_session_id, screen, feature, action, os)."""
    ev = read_table(spark, sf_dir, "events")
    # Whole hours since the epoch of the wall-clock time: zone-independent.
    hours = F.unix_date(F.to_date("ts")) * F.lit(24) + F.hour("ts")
    return ev.select(
        F.col("ts").alias("event_ts"),
        F.col("user_id").alias("device_id"),
        hours.cast("bigint").alias("device_session_id"),
        F.get_json_object("props", "$.k").alias("screen"),
        F.col("event_type").alias("feature"),
        F.lit(None).cast("string").alias("action"),
        F.when(F.col("user_id") % 3 == 0, "iOS").when(F.col("user_id") % 3 == 1, "Android").alias("os"),
    )


APP_EVENTS_SQL = """
SELECT ts AS event_ts, user_id AS device_id,
       CAST(floor(epoch(ts) / 3600) AS BIGINT) AS device_session_id,
       json_extract_string(props, '$.k') AS screen,
       event_type AS feature, CAST(NULL AS VARCHAR) AS action,
       CASE user_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' END AS os
FROM events
"""


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → an event log with a long history (one event per order)."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("event_ts"),
        F.col("o_custkey").alias("device_id"),
        F.col("o_orderkey").alias("device_session_id"),
        F.col("o_orderstatus").alias("screen"),
        F.col("o_orderpriority").alias("feature"),
    )


ORDER_EVENTS_SQL = """
SELECT o_orderdate AS event_ts, o_custkey AS device_id, o_orderkey AS device_session_id,
       o_orderstatus AS screen, o_orderpriority AS feature
FROM orders
"""


def socdem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → (device_id, age, gender) with NULL ages and genders."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("device_id"),
        F.when(F.col("c_acctbal") >= 0, (F.lit(18) + F.col("c_custkey") % 60).cast("int")).alias("age"),
        F.when(F.col("c_nationkey") % 3 == 0, "M").when(F.col("c_nationkey") % 3 == 1, "F").alias("gender"),
    )


SOCDEM_SQL = """
SELECT c_custkey AS device_id,
       CASE WHEN c_acctbal >= 0 THEN CAST(18 + c_custkey % 60 AS INTEGER) END AS age,
       CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS gender
FROM customer
"""


def raw_socdem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → socdem as padded text, as a raw CSV would hold it."""
    s = socdem(spark, sf_dir)
    pad = lambda c: F.concat(F.lit(" "), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(" "))
    return s.select(pad("device_id").alias("number"), pad("age").alias("age_back"), pad("gender").alias("gender"))


RAW_SOCDEM_SQL = f"""
SELECT ' ' || CAST(device_id AS VARCHAR) || ' ' AS number,
       ' ' || coalesce(CAST(age AS VARCHAR), '') || ' ' AS age_back,
       ' ' || coalesce(gender, '') || ' ' AS gender
FROM ({SOCDEM_SQL}) s
"""


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → raw text columns with bad times, blank devices and blank features."""
    ev = read_table(spark, sf_dir, "events")
    fmt = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss")
    eid = F.col("event_id")
    return ev.select(
        F.when(eid % 97 == 0, "bad")
        .when(eid % 89 == 0, "")
        .otherwise(F.concat(fmt, F.lit("+03:00[Europe/Moscow]")))
        .alias("ts_text"),
        F.when(eid % 83 == 0, " ")
        .otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .alias("device_text"),
        F.when(eid % 7 == 0, "   ").otherwise(F.concat(F.lit(" "), F.col("event_type"))).alias("feature_text"),
    )


RAW_EVENTS_SQL = """
SELECT CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN ''
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00[Europe/Moscow]' END AS ts_text,
       CASE WHEN event_id % 83 = 0 THEN ' ' ELSE ' ' || CAST(user_id AS VARCHAR) || ' ' END AS device_text,
       CASE WHEN event_id % 7 = 0 THEN '   ' ELSE ' ' || event_type END AS feature_text
FROM events
"""

def raw_events_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → all ten raw columns as text: quotes, commas, newlines, blanks and bad numbers among them."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00[Europe/Moscow]"))
    return ev.select(
        F.when(eid % 97 == 0, "bad").when(eid % 89 == 0, "").otherwise(stamp).alias("event_ts"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" screen ")).alias("screen"),
        F.when(eid % 7 == 0, "   ").otherwise(F.col("event_type")).alias("feature"),
        F.col("props").alias("action"),
        F.when(eid % 83 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("user_id").cast("string"))).alias("device_id"),
        F.when(eid % 11 == 0, "x1").otherwise((eid % 1000).cast("string")).alias("device_session_id"),
        F.when(eid % 5 == 0, "one, two").otherwise("three").alias("device_vendor"),
        F.when(eid % 13 == 0, 'first\n"second"').otherwise("plain").alias("device_model"),
        F.lit(None).cast("string").alias("device_type"),
        F.when(eid % 2 == 0, "iOS").otherwise("Android").alias("os"),
    )


RAW_EVENTS_WIDE_SQL = """
SELECT CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN ''
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+03:00[Europe/Moscow]' END AS event_ts,
       ' ' || event_type || ' screen ' AS screen,
       CASE WHEN event_id % 7 = 0 THEN '   ' ELSE event_type END AS feature,
       props AS action,
       CASE WHEN event_id % 83 = 0 THEN ' ' ELSE ' ' || CAST(user_id AS VARCHAR) END AS device_id,
       CASE WHEN event_id % 11 = 0 THEN 'x1' ELSE CAST(event_id % 1000 AS VARCHAR) END AS device_session_id,
       CASE WHEN event_id % 5 = 0 THEN 'one, two' ELSE 'three' END AS device_vendor,
       CASE WHEN event_id % 13 = 0 THEN 'first' || chr(10) || '"second"' ELSE 'plain' END AS device_model,
       CAST(NULL AS VARCHAR) AS device_type,
       CASE WHEN event_id % 2 = 0 THEN 'iOS' ELSE 'Android' END AS os
FROM events
"""


# Raw role → column of the raw_events adapter (other roles are absent).
RAW_EVENTS_ROLES = {"event_ts": "ts_text", "device_id": "device_text", "feature": "feature_text"}


def text_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels: labelled texts for the text model and its metrics."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lab, "doc_id")


TEXT_ROWS_SQL = """
SELECT d.doc_id, d.text, d.lang, d.source, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def text_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as texts with two possible targets."""
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


TEXT_DOCS_SQL = "SELECT doc_id, text, lang, source FROM documents"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents ⋈ labels: a (score, binary label) table for ranking metrics."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return d.join(lab, "doc_id").select(
        "doc_id", F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label")
    )


SCORED_SQL = """
SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""
