"""Registered queries over what the jobs write: each job's files are written, read back and compared with SQL.

The clusters of ``fitted_summary`` are KMeans clusters after a fixed number of passes
from fixed starts, which recursive SQL reproduces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.plans import catalog as c
from eventlens.plans.reports import scratch_dir
from eventlens.sinks.writers import write_csv, write_json
from eventlens.sources import adapters as ad
from eventlens.sources.files import read_csv_artifact

# --- the two-table ingestion job --------------------------------------------------

_EVENT_STAMP = "try_cast(split_part(replace(event_ts, 'T', ' '), '[', 1) AS TIMESTAMPTZ)"


@c.register(
    "two_table_job",
    c.with_views(
        """
        SELECT 'events' AS tbl, (SELECT count(*) FROM raw_wide) AS raw_rows, (SELECT count(*) FROM valid) AS valid_rows,
               count(*) AS written_rows, count(DISTINCT device_id) AS devices, CAST(sum(device_session_id) AS BIGINT) AS checksum
        FROM (SELECT DISTINCT * FROM valid)
        UNION ALL
        SELECT 'socdem', NULL, NULL, count(*), count(DISTINCT device_id), CAST(sum(age) AS BIGINT) FROM socdem
        """,
        raw_wide=ad.RAW_EVENTS_WIDE_SQL,
        valid=f"""
        SELECT {_EVENT_STAMP} AS event_at, trim(screen) AS screen, nullif(trim(feature), '') AS feature, action,
               try_cast(trim(device_id) AS BIGINT) AS device_id, try_cast(device_session_id AS BIGINT) AS device_session_id,
               device_vendor, device_model, os
        FROM raw_wide WHERE {_EVENT_STAMP} IS NOT NULL AND try_cast(trim(device_id) AS BIGINT) IS NOT NULL
        """,
        socdem=ad.SOCDEM_SQL,
    ),
)
def q_two_table_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and socdem CSV files through the whole job: reported counts and totals of both written tables."""
    from eventlens.plans.etl import build_tables
    from eventlens.sources.files import EVENTS_HEADER, SOCDEM_HEADER

    base = scratch_dir(spark, "two-tables")
    events = write_csv(ad.raw_events_wide(spark, sf_dir).toDF(*EVENTS_HEADER), f"{base}/raw/events")
    socdem = write_csv(ad.raw_socdem(spark, sf_dir).toDF(*SOCDEM_HEADER), f"{base}/raw/socdem")
    done = build_tables(spark, f"{base}/clean", events_source=events, socdem_source=socdem)

    def totals(path: str, name: str, raw: int | None, valid: int | None, what: str) -> DataFrame:
        return spark.read.parquet(path).agg(
            F.lit(name).alias("tbl"), F.lit(raw).cast("long").alias("raw_rows"), F.lit(valid).cast("long").alias("valid_rows"),
            F.count(F.lit(1)).alias("written_rows"), F.countDistinct("device_id").alias("devices"), F.sum(what).cast("long").alias("checksum"),
        )

    both = totals(done.events_path, "events", done.raw_rows, done.valid_rows, "device_session_id")
    return both.unionByName(totals(done.socdem_path, "socdem", None, None, "age"))


# --- chart series -------------------------------------------------------------------

#: Query of the same rows → label column, its type and the measures.
_SERIES = {
    "dau": ("d", "timestamp", ("dau",)),
    "top_features": ("feature", "string", ("cnt",)),
    "devices_by_os": ("os", "string", ("devices",)),
    "retention_d1_d7": ("cohort_day", "timestamp", ("cohort_size", "retention_d1", "retention_d7")),
    "adoption_by_day": ("d", "timestamp", ("pay_adoption", "ticket_adoption", "meter_adoption")),
}


def _series_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{query}' AS report, '{value}' AS measure, left(CAST({label} AS VARCHAR), {10 if kind == 'timestamp' else 1_000}) AS label,"
        f" round(CAST({value} AS DOUBLE), 6) AS value FROM ({c.ORACLE_SQL[query]})"
        for query, (label, kind, values) in _SERIES.items()
        for value in values
    )


@c.register("report_series", _series_sql())
def q_report_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart series of the event reports, read back from the CSV files that their jobs write."""
    from eventlens.plans import jobs

    events, out = ad.app_events(spark, sf_dir), scratch_dir(spark, "series")
    paths = list(jobs.run_eda(events, out).values())
    paths += [jobs.run_retention(events, out), jobs.run_adoption(events, out, ad.TEST_KEYWORDS)]
    parts = []
    for path, (report, (_, kind, values)) in zip(paths, _SERIES.items(), strict=True):
        rows = read_csv_artifact(spark, path, ", ".join([f"label {kind}", *[f"{v} double" for v in values]]))
        label = F.date_format("label", "yyyy-MM-dd") if kind == "timestamp" else F.col("label")
        parts += [rows.select(F.lit(report).alias("report"), F.lit(v).alias("measure"), label.alias("label"), F.round(v, 6).alias("value")) for v in values]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- summary tables of fitted clusters ------------------------------------------------

_K = 4
_LABEL_DAYS = 2
_PASSES_SQL, _FITTED_SQL = c._lloyd_sql()


@c.register(
    "fitted_summary",
    _PASSES_SQL
    + f""", clusters AS (SELECT device_id, cluster, feats.* EXCLUDE (device_id) FROM feats JOIN ({_FITTED_SQL}) f USING (device_id) WHERE f.k = {_K}),
profile AS ({c._PROFILE_SQL}),
label AS (SELECT device_id, CASE WHEN max(event_ts) >= (SELECT max(event_ts) FROM app_events) - INTERVAL {_LABEL_DAYS} DAY THEN 0 ELSE 1 END AS churn
          FROM app_events GROUP BY 1),
cbc AS ({c._CHURN_BY_CLUSTER_SQL}),
described AS ({c._DESCRIBE_SQL})
SELECT d.cluster, {", ".join(f"round(d.{f}, 6) AS {f}" for f in c._FEATS)}, d.description_draft, round(b.churn_rate, 6) AS churn_rate,
       b.users, d.cluster = (SELECT cluster FROM cbc ORDER BY churn_rate DESC, cluster LIMIT 1) AS is_worst
FROM described d LEFT JOIN cbc b USING (cluster)
""",
)
def q_fitted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster summary and worst cluster of a fitted segmentation, read back from the files that the segment job writes."""
    import numpy as np

    from eventlens.operators.features import churn_label, device_features
    from eventlens.operators.lloyd import fit_all
    from eventlens.operators.metrics import silhouette_all_rows
    from eventlens.operators.scale import fit_scaler
    from eventlens.operators.segment import SegmentModel, SegmentResult, churn_by_cluster, cluster_profile
    from eventlens.plans.jobs import run_summary
    from eventlens.plans.reports import write_segment_artifacts
    from eventlens.session import stage_table

    events, base = ad.app_events(spark, sf_dir), scratch_dir(spark, "summary")
    feats = stage_table(spark, device_features(events, ad.TEST_KEYWORDS), "features")
    scaler = fit_scaler(feats, c._FEATS, with_mean=True)
    space = SegmentModel(scaler, np.empty((0, len(c._FEATS)))).scaled()
    points = feats.select(F.xxhash64("device_id").alias("h"), "device_id", F.array(*space).alias("x"))
    first = [r["x"] for r in points.orderBy("device_id").limit(_K).collect()]
    model = SegmentModel(scaler, fit_all(points, [np.array(first)], max_iter=c._PASSES, tol=-1.0)[0].centers)
    clusters = model.assign(feats)
    score = silhouette_all_rows(clusters.select(F.array(*space).alias("x"), "cluster"), "x", "cluster").first()["silhouette"]
    result = SegmentResult(model, _K, score, {_K: score}, clusters, cluster_profile(clusters, c._FEATS))
    write_segment_artifacts(spark, result, churn_by_cluster(clusters, churn_label(events, _LABEL_DAYS)), f"{base}/behavior")
    read = run_summary(spark, base)
    worst = read["worst_cluster"].select("cluster", F.lit(True).alias("is_worst"))
    summary = read["cluster_summary"].join(F.broadcast(worst), "cluster", "left")  # one row
    return summary.select(
        "cluster", *[c.r6(f) for f in c._FEATS], "description_draft", c.r6("churn_rate"), "users", F.coalesce("is_worst", F.lit(False)).alias("is_worst")
    )


@c.register(
    "churn_metrics_file",
    "WITH order_events AS (" + ad.ORDER_EVENTS_SQL + "), socdem AS (" + ad.SOCDEM_SQL + "),"
    + c._CHURN_DATASET_SQL
    + "SELECT count(*) AS rows, round(avg(churn), 6) AS churn_rate, TRUE AS areas_of_predictions, TRUE AS empty_if_absent FROM ds",
)
def q_churn_metrics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The churn job's metrics row read back, and whether its two areas are those of the written predictions.

    ROC-AUC is taken anew as the share of (churned, stayed) pairs in order, ties half; average precision as the
    mean precision over churned devices.  Both follow from the counts at or above each distinct score."""
    from eventlens.operators.churn import train_churn
    from eventlens.operators.ordered import running_sums
    from eventlens.plans.reports import metrics_summary, write_churn_artifacts

    res = c.memo("train_churn", spark, sf_dir, lambda: train_churn(c._churn_ds(spark, sf_dir)))
    out = scratch_dir(spark, "churn")
    read = metrics_summary(spark, write_churn_artifacts(spark, res, out)["metrics"])
    scores = res.predictions.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos"))
    above = running_sums(scores, [F.desc("score")], ["n", "pos"])
    stayed, pos = F.col("n") - F.col("pos"), F.col("pos")
    sums = above.agg(
        F.sum(stayed * (F.col("cum_pos") - pos / 2)).alias("in_order"), F.sum(pos * F.col("cum_pos") / F.col("cum_n")).alias("precisions"),
        F.sum(pos).alias("p"), F.sum(stayed).alias("q"),
    )
    areas = sums.select((F.col("in_order") / (F.col("p") * F.col("q"))).alias("area"), (F.col("precisions") / F.col("p")).alias("average"))
    near = (F.abs(F.col("roc_auc") - F.col("area")) < 1e-9) & (F.abs(F.col("pr_auc") - F.col("average")) < 1e-9)
    absent = metrics_summary(spark, f"{out}/none.json").isEmpty()
    return read.crossJoin(areas).select("rows", c.r6("churn_rate"), near.alias("areas_of_predictions"), F.lit(absent).alias("empty_if_absent"))  # two one-row tables


# --- text reports -----------------------------------------------------------------------

@c.register(
    "misclassified_file",
    "WITH text_rows AS (" + ad.TEXT_ROWS_SQL + ") SELECT doc_id, text, CAST(quality AS VARCHAR) AS target, CAST(1 - toxic AS VARCHAR) AS predicted"
    " FROM text_rows WHERE quality <> 1 - toxic",
)
def q_misclassified_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts whose quality is not that of the rule "toxic texts are bad", written as the report's CSV and read back."""
    from eventlens.operators.text import misclassified

    rows = ad.text_rows(spark, sf_dir)
    pred = rows.select("doc_id", "text", F.col("quality").cast("string").alias("target"), (1 - F.col("toxic")).cast("string").alias("predicted"))
    path = write_csv(misclassified(pred), f"{scratch_dir(spark, 'errors')}/misclassified.csv")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.schema("doc_id long, text string, target string, predicted string").csv(path)


@c.register("topics_from_metrics", c.ORACLE_SQL["topic_distribution"])
def q_topics_from_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes as the summary takes them from the text model's metrics file."""
    from eventlens.operators.text import class_counts, metrics_frame
    from eventlens.plans.jobs import topics_from_metrics

    texts = c._prepared(spark, sf_dir, "lang")
    topics = {r[0]: r[1] for r in class_counts(texts).limit(1_000).collect()}  # languages, a few
    n = sum(topics.values())
    metrics = dict(
        rows_total=n, rows_used=n, text_col="text", target_col="lang", test_size=0.2, random_state=42, min_class_count=2, merge_rare_to_other=False,
        accuracy=0.0, f1_macro=0.0, classes=sorted(topics), rare_classes={}, topics=topics,
    )
    path = write_json(metrics_frame(spark, metrics), f"{scratch_dir(spark, 'text')}/metrics.json")
    return topics_from_metrics(spark, path)
