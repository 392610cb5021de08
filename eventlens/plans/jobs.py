"""End-to-end jobs, one per analysis of the reference project.

Each job reads its tables, runs the operators and writes its artifacts under
``out_dir`` (Parquet / CSV / JSON folders and saved Spark ML models).  They
are thin compositions: all work happens in the operators, on executors.

* :func:`run_eda` — DAU, top features, devices per OS (the chart series).
* :func:`run_retention` — D1/D7 retention by first-seen cohort.
* :func:`run_adoption` — daily adoption of the keyword features.
* :func:`run_segmentation` — device features → KMeans segments, profiles,
  metrics, and churn by cluster.
* :func:`run_churn` — churn dataset → balanced logistic model + metrics.
* :func:`run_text` — labelled texts → classifier, metrics, report,
  misclassified rows, sub-topics of the dominant class.
* :func:`run_summary` — the read-back tables of the models summary.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.constants import DEFAULT_KEYWORDS, DEVICE_FEATURE_COLUMNS, FEATURE_DAYS, LABEL_DAYS
from eventlens.operators import product
from eventlens.operators.features import churn_dataset, churn_label, device_features
from eventlens.operators.quality import require
from eventlens.sinks.writers import write_csv, write_json
from eventlens.sources.files import read_csv_artifact, read_json_artifact

EVENT_COLUMNS_NEEDED = ("event_ts", "device_id", "device_session_id", "screen", "feature")


def run_eda(events: DataFrame, out_dir: str, *, tz: str | None = None) -> dict[str, str]:
    require(events, ("event_ts", "device_id", "feature", "os"), what="events")
    return {
        "dau": write_csv(product.dau(events, tz=tz), f"{out_dir}/dau.csv", single_file=True),
        "top_feature": write_csv(product.top_features(events, 20), f"{out_dir}/top_feature.csv", single_file=True),
        "devices_by_os": write_csv(product.devices_by_os(events), f"{out_dir}/devices_by_os.csv", single_file=True),
    }


def run_retention(events: DataFrame, out_dir: str, *, tz: str | None = None, censor: bool = False) -> str:
    require(events, ("event_ts", "device_id"), what="events")
    out = product.retention(events, (1, 7), tz=tz, censor=censor)
    return write_csv(out, f"{out_dir}/retention_d1_d7_by_cohort.csv", single_file=True)


def run_adoption(events: DataFrame, out_dir: str, keywords: Mapping[str, str] = DEFAULT_KEYWORDS, *, tz=None) -> str:
    require(events, ("event_ts", "device_id", "feature"), what="events")
    return write_csv(product.adoption(events, keywords, tz=tz), f"{out_dir}/adoption_by_day.csv", single_file=True)


def run_segmentation(
    events: DataFrame,
    out_dir: str,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    *,
    label_days: float = LABEL_DAYS,
    tz: str | None = None,
    **segment_kw,
):
    """Segments plus the churn-by-cluster table (population: every clustered
    device; label: the churn label, which covers every device)."""
    from eventlens.operators.segment import churn_by_cluster, segment
    from eventlens.plans.reports import write_segment_artifacts

    require(events, EVENT_COLUMNS_NEEDED, what="events")
    feats = device_features(events, keywords, tz=tz)
    res = segment(feats, DEVICE_FEATURE_COLUMNS, **segment_kw)
    churn = churn_by_cluster(res.clusters, churn_label(events, label_days))
    paths = write_segment_artifacts(events.sparkSession, res, churn, out_dir)
    return res, paths


def run_churn(
    events: DataFrame,
    socdem: DataFrame,
    out_dir: str,
    *,
    feature_days: float = FEATURE_DAYS,
    label_days: float = LABEL_DAYS,
    keywords: Mapping[str, str] = DEFAULT_KEYWORDS,
    tz: str | None = None,
    unique_socdem: bool = False,
    **train_kw,
):
    from eventlens.operators.churn import train_churn
    from eventlens.plans.reports import write_churn_artifacts

    require(events, EVENT_COLUMNS_NEEDED, what="events")
    require(socdem, ("device_id", "age", "gender"), min_rows=0, what="socdem")
    ds = churn_dataset(events, socdem, feature_days, label_days, keywords, tz=tz, unique_socdem=unique_socdem)
    require(ds, min_rows=1, what="churn dataset")
    res = train_churn(ds, **train_kw)
    return res, write_churn_artifacts(events.sparkSession, res, out_dir)


def run_text(
    df: DataFrame,
    out_dir: str,
    text_col: str | None = None,
    target_col: str | None = None,
    *,
    subtopic_kw: Mapping | None = None,
    **kw,
):
    """Classifier artifacts plus the sub-topics of the dominant class."""
    from eventlens.operators.text import prepare_texts, resolve_roles, train_text
    from eventlens.operators.topics import subtopics
    from eventlens.plans.reports import write_text_artifacts

    require(df, min_rows=1, what="labelled texts")
    res = train_text(df, text_col, target_col, **kw)
    paths = write_text_artifacts(df.sparkSession, res, out_dir)
    text, target = resolve_roles(df, text_col, target_col)
    sub = subtopics(prepare_texts(df.withColumn("_doc", F.monotonically_increasing_id()), text, target, keep=["_doc"]),
                    doc="_doc", **dict(subtopic_kw or {}))
    paths["subtopics"] = write_json(sub.coalesce(1), f"{out_dir}/subtopics.json")
    return res, paths


def run_summary(spark: SparkSession, artifacts_dir: str) -> dict[str, DataFrame]:
    """The summary tables: churn metrics row, cluster summary sorted by churn
    rate, worst cluster.  Missing artifacts give empty tables."""
    from eventlens.operators.segment import cluster_summary, worst_cluster
    from eventlens.plans.reports import CHURN_BY_CLUSTER_SCHEMA, metrics_summary
    from pyspark.sql import types as T

    profile_schema = T.StructType(
        [T.StructField("cluster", T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in DEVICE_FEATURE_COLUMNS]
    )
    profile = read_csv_artifact(spark, f"{artifacts_dir}/behavior/cluster_profiles.csv", profile_schema)
    churn = read_csv_artifact(spark, f"{artifacts_dir}/behavior/churn_by_cluster.csv", CHURN_BY_CLUSTER_SCHEMA)
    return {
        "churn_metrics": metrics_summary(spark, f"{artifacts_dir}/churn/metrics.json"),
        "cluster_summary": cluster_summary(profile, churn),
        "worst_cluster": worst_cluster(churn),
    }


def topics_from_metrics(spark: SparkSession, nlp_metrics_path: str) -> DataFrame:
    """``(topic, count)`` rows from the ``topics`` map of the text metrics."""
    from eventlens.operators.text import NLP_METRICS_SCHEMA

    schema = spark.createDataFrame([], NLP_METRICS_SCHEMA).schema
    m = read_json_artifact(spark, nlp_metrics_path, schema)
    return m.select(F.explode("topics").alias("topic", "count")).orderBy(F.desc("count"), F.asc("topic"))
