"""End-to-end jobs write their artifacts and the summary reads them back."""

import os

import pytest

from eventlens.operators.quality import InputError, require
from eventlens.plans import jobs
from eventlens.sources import adapters as ad
from eventlens.sources.tables import read_table
from tests.conftest import SMALL


def test_require(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id long, y string")
    require(df, ["id"], min_rows=2)
    with pytest.raises(InputError):
        require(df, ["nope"])
    with pytest.raises(InputError):
        require(df, min_rows=3)
    with pytest.raises(InputError):
        require(df, class_col="y", min_classes=2)


def test_csv_artifact_keeps_quotes_commas_and_newlines(spark, scratch):
    from eventlens.sinks.writers import write_csv
    from eventlens.sources.files import read_csv_artifact

    df = spark.createDataFrame([(1, 'say "hi", you'), (2, '{"k": 0}'), (3, "a\\b"), (4, None)], "id int, t string")
    write_csv(df, scratch + "/quoted")
    assert sorted(read_csv_artifact(spark, scratch + "/quoted", df.schema).collect()) == sorted(df.collect())


def test_product_jobs(spark, scratch):
    ev = ad.app_events(spark, SMALL)
    paths = jobs.run_eda(ev, scratch)
    assert spark.read.option("header", True).csv(paths["dau"]).count() == 30
    assert spark.read.option("header", True).csv(jobs.run_retention(ev, scratch)).count() >= 1
    assert spark.read.option("header", True).csv(jobs.run_adoption(ev, scratch, ad.TEST_KEYWORDS)).count() == 30


def test_churn_segmentation_summary(spark, scratch):
    ev = ad.order_events(spark, SMALL)
    so = ad.socdem(spark, SMALL)
    res, _ = jobs.run_churn(ev, so, os.path.join(scratch, "churn"), feature_days=360, label_days=180)
    assert res.metrics["rows"] > 0 and 0 <= res.metrics["churn_rate"] <= 1
    seg, _ = jobs.run_segmentation(
        ev, os.path.join(scratch, "behavior"), {"pay": "urgent", "ticket": "high", "meter": "low"},
        label_days=180, k_min=2, k_max=3, n_init=2,
    )
    summary = jobs.run_summary(spark, scratch)
    m = summary["churn_metrics"].first()
    assert m["rows"] == res.metrics["rows"]
    assert summary["cluster_summary"].count() == seg.best_k
    assert summary["worst_cluster"].count() == 1


def test_text_job(spark, scratch):
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text", "lang")
    res, paths = jobs.run_text(docs, scratch, "text", "lang", key="doc_id", subtopic_kw={"max_iter": 15})
    assert 0 <= res.metrics["accuracy"] <= 1
    assert set(res.metrics["classes"]) == set(res.metrics["topics"])
    sub = spark.read.json(paths["subtopics"])
    assert sub.count() == 1
    topics = jobs.topics_from_metrics(spark, paths["metrics"]).collect()
    assert sum(r["count"] for r in topics) == res.metrics["rows_used"]


def test_churn_impute_on_train(spark):
    from eventlens.operators.churn import train_churn
    from eventlens.operators.features import churn_dataset

    ds = churn_dataset(ad.order_events(spark, SMALL), ad.socdem(spark, SMALL), 360, 180,
                       {"pay": "urgent", "ticket": "high", "meter": "low"})
    a = train_churn(ds)
    b = train_churn(ds, impute_on="train")
    assert a.metrics["rows"] == b.metrics["rows"]
    assert a.predictions.count() == b.predictions.count()
    assert 0.0 <= b.metrics["roc_auc"] <= 1.0
