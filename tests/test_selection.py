"""Exact order statistics, level dictionaries, day bitmaps and plans without Expand."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlens.operators import levels
from eventlens.operators.features import churn_dataset, device_features
from eventlens.operators.levels import encode_levels, fit_levels
from eventlens.operators.product import retention
from eventlens.operators.selection import medians, order_statistics


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_median_of_a_million_distinct_doubles(spark):
    df = spark.range(0, 1_000_000, 1, 8).select((F.sin(F.col("id") * 12.9898) * F.pow(F.lit(10.0), F.col("id") % 40 - 20)).alias("x"))
    x = np.array([r[0] for r in df.collect()])
    assert len(np.unique(x)) > 990_000
    got = order_statistics(df, {"x": (0.0, 0.1, 0.5, 0.999, 1.0)})["x"]
    assert got == [pytest.approx(v, rel=1e-15) for v in np.quantile(x, (0.0, 0.1, 0.5, 0.999, 1.0))]


def test_medians_of_odd_values(spark):
    rows = [(None, 1, -0.0), (None, None, float("nan")), (None, 3, float("-inf")), (None, 3, 0.0), (None, -7, 5e-324)]
    df = spark.createDataFrame(rows, "a double, b int, c double")
    assert medians(df, ["a", "b", "c"]) == {"a": None, "b": 2.0, "c": 0.0}
    assert math.isnan(order_statistics(df, {"c": (1.0,)})["c"][0])
    assert medians(df.limit(0), ["b"]) == {"b": None} and medians(df, []) == {}


def test_a_hundred_thousand_levels(spark, monkeypatch):
    monkeypatch.setattr(levels, "HOT", 10)
    df = spark.range(130_000).select("id", F.when(F.col("id") >= 100_000, "many").when(F.col("id") % 50 != 0, F.col("id").cast("string")).alias("c"))
    fitted = fit_levels(df, "c")
    assert fitted.size == 98_002 and fitted.rows == 130_000
    top = {r["level"]: r["idx"] for r in fitted.table.where("idx < 3").collect()}
    assert top == {"many": 0, "U": 1, "1": 2}
    out = encode_levels(df.where("id in (0, 1, 99999, 100001)").union(spark.createDataFrame([(-1, "new")], df.schema)), fitted)
    got = {r["id"]: (r["c_idx"], r["c_vec"].size, r["c_vec"].indices.tolist()) for r in out.collect()}
    assert got[100001] == (0, 98_002, [0]) and got[0] == (1, 98_002, [1]) and got[-1] == (None, 98_002, [])
    assert got[99999][2] == [got[99999][0]]


def test_sparse_vectors_are_read_without_a_dense_array(spark):
    df = spark.range(60_000).select("id", F.col("id").cast("string").alias("c"))
    fitted = fit_levels(df, "c")
    rows = encode_levels(df.union(spark.createDataFrame([(-1, "new")], df.schema)), fitted)
    out = rows.select("id", "c_idx", levels.set_places("c_vec").alias("v"))
    assert out.where("v.size = 60000 and v.places = array(cast(c_idx as int)) and v.values = array(1.0D)").count() == 60_000
    assert [(r["v"]["size"], r["v"]["places"]) for r in out.where("id = -1").collect()] == [(60_000, [])]


def test_retention_bitmap_over_long_logs(spark, rng=np.random.default_rng(4)):
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=int(n), hours=5)
    active = {d: sorted({int(x) for x in rng.integers(0, 400, 12)} | ({int(rng.integers(0, 64)) + k for k in (0, 1, 63, 64, 65, 130)})) for d in range(60)}
    rows = [(d, day(n)) for d, ns in active.items() for n in ns] + [(None, day(3)), (None, day(4)), (99, None)]
    df = spark.createDataFrame(rows, "device_id long, event_ts timestamp_ntz")
    got = {r["cohort_day"]: r for r in retention(df, (1, 63, 64, 130)).collect()}
    for n in {min(v) for v in active.values()}:
        cohort = [v for v in active.values() if min(v) == n] + ([[3]] if n == 3 else [])
        row = got[dt.datetime(2024, 1, 1) + dt.timedelta(days=n)]
        assert row["cohort_size"] == len(cohort)
        for k in (1, 63, 64, 130):
            assert row[f"retention_d{k}"] == pytest.approx(sum(n + k in v for v in cohort) / len(cohort))
    assert got[None]["cohort_size"] == 1
    plan = plan_of(retention(df))
    assert "ObjectHashAggregate" not in plan and "collect_set" not in plan and "SortAggregate" not in plan
    assert retention(df.limit(0)).count() == 0


def test_several_distinct_counts_without_expand(spark):
    events = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1 + i % 5), i % 3, f"s{i % 2}" if i % 4 else None, "Pay" if i % 2 else None) for i in range(40)],
        "device_id long, event_ts timestamp_ntz, device_session_id long, screen string, feature string",
    )
    out = device_features(events, {"pay": "pay"})
    assert "Expand" not in plan_of(out)
    assert out.first().asDict() == {
        "device_id": 1, "events_cnt": 40, "active_days": 5, "sessions_cnt": 3, "screens_cnt": 2, "features_cnt": 1, "pay_events": 20,
    }
    dem = spark.createDataFrame([(1, 30, "M")], "device_id long, age int, gender string")
    assert "Expand" not in plan_of(churn_dataset(events, dem, 2, 2, {"pay": "pay"}))
