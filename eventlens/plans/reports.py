"""Artifacts: write the run outputs and read them back as report tables."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventlens.plans.scoring import save_scorer
from eventlens.session import ensure_checkpoint_dir
from eventlens.sinks.writers import metrics_frame, save_model, write_csv, write_json
from eventlens.sources.files import read_csv_artifact, read_json_artifact

CHURN_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("churn_rate", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("pr_auc", T.DoubleType()),
    ]
)
SEGMENT_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("best_k", T.IntegerType()),
        T.StructField("silhouette", T.DoubleType()),
        T.StructField("all_scores", T.MapType(T.IntegerType(), T.DoubleType())),
    ]
)
CHURN_BY_CLUSTER_SCHEMA = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("users", T.LongType()),
        T.StructField("churn_rate", T.DoubleType()),
    ]
)


def scratch_dir(spark: SparkSession, name: str = "run") -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/eventlens-{name}-{uuid.uuid4().hex[:12]}"


def write_churn_artifacts(spark: SparkSession, result, out_dir: str) -> dict[str, str]:
    """Model, metrics (JSON) and test-set scores of a churn fit."""
    m = dict(result.metrics)
    paths = {
        "model": save_model(result.model, f"{out_dir}/churn_model"),
        "scorer": save_scorer(result.model, result.inputs, result.feature_cols, f"{out_dir}/churn_scorer"),
        "metrics": write_json(metrics_frame(spark, m, CHURN_METRICS_SCHEMA).coalesce(1), f"{out_dir}/metrics.json"),
    }
    return paths


def write_segment_artifacts(spark: SparkSession, result, churn_by_cluster: DataFrame | None, out_dir: str) -> dict:
    """Device → cluster table, cluster profiles, churn by cluster, metrics."""
    paths = {
        "model": result.model.save(spark, f"{out_dir}/segment_model"),
        "user_clusters": write_csv(result.clusters, f"{out_dir}/user_clusters.csv"),
        "cluster_profiles": write_csv(result.profile, f"{out_dir}/cluster_profiles.csv", single_file=True),
    }
    if churn_by_cluster is not None:
        paths["churn_by_cluster"] = write_csv(churn_by_cluster, f"{out_dir}/churn_by_cluster.csv", single_file=True)
    scores = {int(k): float(v) for k, v in result.all_scores.items()}
    row = [(int(result.best_k), float(result.silhouette), scores)]
    paths["metrics"] = write_json(spark.createDataFrame(row, SEGMENT_METRICS_SCHEMA), f"{out_dir}/metrics.json")
    return paths


def write_text_artifacts(spark: SparkSession, result, out_dir: str) -> dict[str, str]:
    """Model, metrics, report table and misclassified rows of a text fit."""
    from eventlens.operators.text import metrics_frame as nlp_metrics_frame
    from eventlens.operators.text import misclassified

    return {
        "model": save_model(result.model, f"{out_dir}/text_model"),
        "metrics": write_json(nlp_metrics_frame(spark, result.metrics).coalesce(1), f"{out_dir}/metrics.json"),
        "report": write_csv(result.report, f"{out_dir}/classification_report.csv", single_file=True),
        "misclassified": write_csv(misclassified(result.predictions), f"{out_dir}/misclassified.csv"),
    }


def metrics_summary(spark: SparkSession, churn_metrics_path: str) -> DataFrame:
    """One-row churn metrics table; empty when the artifact is missing."""
    return read_json_artifact(spark, churn_metrics_path, CHURN_METRICS_SCHEMA).select(
        "rows", "churn_rate", "roc_auc", "pr_auc"
    )
