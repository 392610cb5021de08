"""Metrics against brute force, split properties, fitted-model properties."""

import math
import os

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from eventlens.operators.churn import balanced_weights, fit_balanced_logistic
from eventlens.operators.lloyd import fit_all, fit_grid, seeds
from eventlens.operators.metrics import (
    MetricError,
    accuracy_macro_f1,
    average_precision,
    per_class,
    roc_auc,
    silhouette,
    silhouette_all_rows,
)
from eventlens.operators.ordered import rank_in_group, running_sums, top_n_per_group
from eventlens.operators.segment import SegmentModel, segment
from eventlens.operators.split import split
from eventlens.operators.topics import nmf


def _brute_auc(s, y):
    pos = [a for a, b in zip(s, y) if b == 1]
    neg = [a for a, b in zip(s, y) if b == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(s, y):
    P = sum(y)
    out = 0.0
    for a, b in zip(s, y):
        if b == 1:
            above = [bb for aa, bb in zip(s, y) if aa >= a]
            out += sum(above) / len(above)
    return out / P


def test_ranking_metrics_with_ties(spark):
    rng = np.random.default_rng(1)
    s = rng.integers(0, 20, 300).astype(float).tolist()
    y = rng.integers(0, 2, 300).tolist()
    df = spark.createDataFrame(list(zip(s, y)), "score double, label int")
    assert roc_auc(df).first()[0] == pytest.approx(_brute_auc(s, y), abs=1e-12)
    assert average_precision(df).first()[0] == pytest.approx(_brute_ap(s, y), abs=1e-12)
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "score double, label int")
    assert math.isnan(roc_auc(one).first()[0])


def test_running_sums_and_ranks(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit(1).alias("one"), (F.col("id") % 3).alias("g"))
    cum = {r["k"]: r["cum_one"] for r in running_sums(df, ["k"], ["one"], num_partitions=7).collect()}
    assert all(cum[k] == k + 1 for k in range(1000))
    ranked = rank_in_group(df, ["g"], ["k"], num_partitions=5).collect()
    for g in range(3):
        ks = sorted(r["k"] for r in ranked if r["g"] == g)
        got = {r["k"]: r["rank"] for r in ranked if r["g"] == g}
        assert [got[k] for k in ks] == list(range(len(ks)))
    top = top_n_per_group(df.repartition(6), ["g"], [F.desc("k")], 3).collect()
    group_of = {r["k"]: r["g"] for r in ranked}
    for g in range(3):
        expect = sorted([k for k, gg in group_of.items() if gg == g], reverse=True)[:3]
        assert sorted([r["k"] for r in top if r["g"] == g], reverse=True) == expect


def test_classification_metrics(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    df = spark.createDataFrame(rows, "y string, p string")
    pc = {r["label"]: r for r in per_class(df, "y", "p").collect()}
    assert pc["a"]["precision"] == pytest.approx(0.5) and pc["a"]["recall"] == pytest.approx(0.5)
    assert pc["b"]["precision"] == pytest.approx(2 / 3) and pc["b"]["recall"] == pytest.approx(1.0)
    assert pc["c"]["f1"] == 0.0 and pc["c"]["support"] == 1
    m = accuracy_macro_f1(df, "y", "p").first()
    assert m["accuracy"] == pytest.approx(3 / 5)
    assert m["f1_macro"] == pytest.approx((0.5 + 0.8 + 0.0) / 3)


def _brute_silhouette(x, y):
    n = len(x)
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(n):
        own = y == y[i]
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, y == c].mean() for c in set(y.tolist()) if c != y[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_of_all_rows(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 200)
    x = rng.normal(size=(200, 4)) + y[:, None]
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    want = []
    for i in range(len(x)):
        mean = [d[i, y == c].sum() / ((y == c).sum() - (c == y[i])) for c in range(3)]
        a, b = mean[y[i]], min(m for c, m in enumerate(mean) if c != y[i])
        want.append((b - a) / max(a, b))
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "f array<double>, c int")
    assert silhouette_all_rows(df, "f", "c").first()[0] == pytest.approx(np.mean(want), abs=1e-9)
    with pytest.raises(MetricError):
        silhouette_all_rows(df.where("c = 0"), "f", "c")


def test_silhouette_exact_and_guards(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.5, (40, 3)) for c in (0, 3, 6)])
    y = np.repeat([0, 1, 2], 40)
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(len(y))], "id long, f array<double>, c int")
    assert silhouette(df, "f", "c", key="id").first()[0] == pytest.approx(_brute_silhouette(x, y), abs=1e-9)
    single = df.union(spark.createDataFrame([(999, [9.0, 9.0, 9.0], 7)], df.schema))
    with pytest.raises(MetricError):
        silhouette(single, "f", "c", key="id")


def test_silhouette_scores_more_rows_than_a_sample(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 3, 5_200)
    x = rng.normal(size=(5_200, 2)) + y[:, None] + 1_000.0
    x[:300] = x[0]
    df = spark.createDataFrame(list(zip(range(len(y)), x.tolist(), y.tolist())), "id long, f array<double>, c int")
    got = silhouette(df, "f", "c", key="id")
    assert got.columns == ["silhouette"] and got.first()[0] == pytest.approx(_brute_silhouette(x, y), abs=1e-9)
    assert silhouette(df, "f", "c", key="id", sample_size=100).first()["rows_scored"] == 100


def test_stratified_split_properties(spark):
    df = spark.range(997).select("id", (F.col("id") % 4).alias("c"))
    train, test = split(df, ["id"], label="c", test_size=0.2, seed=42)
    tr, te = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not tr & te and len(tr | te) == 997
    for c in range(4):
        n = sum(1 for i in range(997) if i % 4 == c)
        got = sum(1 for i in te if i % 4 == c)
        assert abs(got - 0.2 * n) <= 1
    again = {r["id"] for r in split(df, ["id"], label="c", test_size=0.2, seed=42)[1].collect()}
    assert again == te


def test_segment_recovers_planted_clusters(spark):
    rng = np.random.default_rng(7)
    centers = np.array([[0, 0], [10, 0], [0, 10]])
    pts = np.vstack([rng.normal(c, 0.3, (60, 2)) for c in centers])
    df = spark.createDataFrame([(i, float(p[0]), float(p[1])) for i, p in enumerate(pts)], "device_id long, a double, b double")
    res = segment(df, ["a", "b"], k_min=2, k_max=5, n_init=3, parallelism=8)
    assert res.best_k == 3
    labels = {r["device_id"]: r["cluster"] for r in res.clusters.collect()}
    for g in range(3):
        assert len({labels[i] for i in range(g * 60, g * 60 + 60)}) == 1


def test_models_fitted_together_equal_models_fitted_alone(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3)) + rng.integers(0, 4, 400)[:, None] * 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    points = df.select(F.xxhash64("id").alias("h"), "x").repartition(5).cache()
    starts = seeds(points, [2, 4, 4, 7], 1)
    assert [len(s) for s in starts] == [2, 4, 4, 7] and not np.array_equal(starts[1], starts[2])
    assert all((np.abs(x[:, None] - s[None]).sum(-1).min(0) < 1e-12).all() and len(np.unique(s, axis=0)) == len(s) for s in starts)
    for start, fit in zip(starts, fit_all(points, starts, tol=0.0), strict=True):
        c = start
        for _ in range(300):
            own = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            c, was = np.array([x[own == i].mean(0) for i in range(len(c))]), c
            if np.allclose(c, was, atol=1e-13):
                break
        assert np.allclose(fit.centers, c) and fit.cost == pytest.approx(((x - c[own]) ** 2).sum())


def test_lost_centres_move_and_few_distinct_rows(spark):
    x = [[0.0], [0.1], [5.0], [5.1], [9.0]]
    points = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "h long, x array<double>")
    fit = fit_all(points, [np.array([[0.0], [5.0], [100.0]])])[0]
    assert sorted(np.round(fit.centers.ravel(), 6)) == [0.05, 5.05, 9.0]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(6)], "h long, x array<double>")
    fits = fit_grid(same, [2, 3], n_init=2)
    assert fits[3].cost == 0.0 and fits[2].k == 2


def test_segment_model_round_trip(spark, scratch):
    df = spark.createDataFrame([(i, float(i % 2 * 10 + i * 0.01), 1.0) for i in range(40)], "device_id long, a double, b double")
    res = segment(df, ["a", "b"], k_min=2, k_max=3, n_init=2)
    back = SegmentModel.load(spark, res.model.save(spark, f"{scratch}/m"))
    assert sorted(map(tuple, back.assign(df).collect())) == sorted(map(tuple, res.clusters.collect()))
    with pytest.raises(ValueError):
        segment(df.limit(0), ["a", "b"])


def test_logistic_matches_stated_objective(spark):
    rng = np.random.default_rng(5)
    n = 300
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0.6).astype(int)
    df = spark.createDataFrame([(float(a), float(b), float(c), int(t)) for (a, b, c), t in zip(x, y)], "a double, b double, c double, y int")
    model = fit_balanced_logistic(df, ["a", "b", "c"], "y", max_iter=500)
    lr = model.stages[-1]
    sd = x.std(axis=0)
    xs = x / sd
    beta, b0 = lr.coefficients.toArray(), lr.intercept
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    p = 1 / (1 + np.exp(-(xs @ beta + b0)))
    grad = xs.T @ (w * (p - y)) + beta
    grad0 = np.sum(w * (p - y))
    assert np.max(np.abs(grad)) < 1e-2 * n ** 0.5 and abs(grad0) < 1e-2 * n ** 0.5
    _, m = balanced_weights(df, "y")
    assert m == n


def test_nmf_residual_falls_and_topics_separate(spark):
    rows = []
    for d in range(40):
        idx = [0, 1, 2] if d % 2 == 0 else [3, 4, 5]
        rows.append((d, idx, [1.0, 0.8, 0.6]))
    df = spark.createDataFrame(rows, "doc long, idx array<int>, val array<double>")
    entries = df.select("doc", F.explode(F.arrays_zip("idx", "val")).alias("e")).select("doc", F.col("e.idx").alias("term"), F.col("e.val").alias("x"))
    h, w, errors = nmf(entries, 2, max_iter=25, tol=0.0)
    h = np.array([r["h"] for r in h.orderBy("term").collect()]).T
    got = {r["doc"]: r["w"] for r in w.collect()}
    x = np.zeros((40, 6))
    for d, idx, val in rows:
        x[d, idx] = val
    assert ((x - np.array([got[d] for d in range(40)]) @ h) ** 2).sum() == pytest.approx(errors[-1], abs=1e-6 * errors[0])
    # the error is computed from sums, so allow round-off near an exact fit
    assert all(b <= a + 1e-9 * errors[0] for a, b in zip(errors, errors[1:]))
    assert errors[-1] < 0.05 * errors[0]
    tops = {tuple(sorted(np.argsort(-h[t])[:3].tolist())) for t in range(2)}
    assert tops == {(0, 1, 2), (3, 4, 5)}


def test_stream_normalize(spark, scratch):
    from eventlens.sources.files import EVENTS_HEADER
    from eventlens.streaming.ingest import normalize_event_stream, raw_event_stream, start_parquet_sink

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    line = "2025-10-06T17:08:06+03:00[Europe/Moscow],s,f,,7,1,v,m,t,iOS"
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(",".join(EVENTS_HEADER) + "\n" + line + "\n" + line + "\nbad,s,f,,8,1,v,m,t,iOS\n")
    q = start_parquet_sink(normalize_event_stream(raw_event_stream(spark, src)), os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    q.awaitTermination()
    out = spark.read.parquet(os.path.join(scratch, "out"))
    assert out.count() == 1
    assert out.first()["device_id"] == 7



def test_split_falls_back_when_a_class_has_one_row(spark):
    from eventlens.operators.split import StratifyError, can_stratify

    assert not can_stratify({"a": 50, "b": 1}, 0.2)
    assert can_stratify({"a": 50, "b": 10}, 0.2)
    df = spark.range(51).select("id", F.when(F.col("id") == 0, "b").otherwise("a").alias("c"))
    train, test = split(df, ["id"], label="c", test_size=0.2, seed=1)
    assert train.count() + test.count() == 51
    assert test.count() == 10  # round(0.2 * 51) over the whole table
    with pytest.raises(StratifyError):
        split(df, ["id"], label="c", fallback=False)


def test_running_sums_without_exchange_reuse(spark):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("k"), F.lit(1).alias("one"))
        cum = {r["k"]: r["cum_one"] for r in running_sums(df, ["k"], ["one"], num_partitions=9).collect()}
        assert all(cum[k] == k + 1 for k in range(5000))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


@pytest.fixture(scope="module")
def million(spark):
    from pyspark.sql import functions as F

    unit = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10**12)) / 1e12
    df = spark.range(1_000_000).select("id", unit(1).alias("u"), unit(2).alias("v"), F.pmod("id", F.lit(7)).alias("c"))
    return df.select("*", (F.col("u") * 0.6 + F.col("v") * 0.4 > 0.5).cast("int").alias("label"), F.lit("wide").alias("w"))


def test_roc_auc_on_a_million_distinct_scores(million):
    rows = million.select("u", "label").toPandas().sort_values("u")
    y = rows["label"].to_numpy()
    p, n = y.sum(), len(y) - y.sum()
    truth = (np.flatnonzero(y).sum() + p - p * (p + 1) / 2) / (p * n)
    for _ in range(3):
        assert abs(roc_auc(million, "u", "label").first()[0] - truth) < 1e-9


@pytest.mark.parametrize("label", ["c", None])
def test_split_of_a_million_rows_is_disjoint_and_complete(million, label):
    from pyspark.sql import functions as F

    train, test = split(million, ["id"], label=label, test_size=0.2, seed=42)
    # read with different columns, as the two sides of a fit are
    assert train.select("id", "u").count() + test.select("id").count() == 1_000_000
    assert train.select("id", "w", "v").join(test.select("id"), "id").isEmpty()
    sizes = {r[0]: r[1] for r in million.groupBy("c").count().collect()}
    for c, k in test.groupBy("c").agg(F.count("*")).collect():
        assert label is None or abs(k - 0.2 * sizes[c]) <= 1
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Exchange hashpartitioning" not in plan


def test_stream_keeps_quoted_and_late_rows(spark, scratch):
    from eventlens.sources.files import EVENTS_HEADER
    from eventlens.streaming.ingest import normalize_event_stream, raw_event_stream, start_parquet_sink

    src, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    os.makedirs(src)
    row = '2025-10-{day}T17:08:06+03:00[Europe/Moscow],{screen},f,,7,1,v,m,t,iOS'
    lines = [row.format(day=10, screen='"two\nlines"'), row.format(day=10, screen='"a ""b"", c"'), row.format(day=10, screen="s")]
    late = [row.format(day="05", screen="late"), lines[2]]
    for name, part in (("a.csv", lines), ("b.csv", late)):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join([",".join(EVENTS_HEADER), *part]) + "\n")
        start_parquet_sink(normalize_event_stream(raw_event_stream(spark, src)), out, ck).awaitTermination()
    assert sorted(r.screen for r in spark.read.parquet(out).collect()) == ['a "b", c', "late", "s", "two\nlines"]


def test_subtopics_use_every_term(spark, monkeypatch):
    from eventlens.operators import topics

    words = [f"w{i}" for i in range(20_050)]
    rows = [(i, " ".join(words[i % 2 :: 2]), "en") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, target string")
    used = []

    def one_step(x, k, **kw):
        ones = F.array(*[F.lit(1.0)] * k)
        h = x.select("term").distinct()
        used.append(h.count())
        return h.select("term", ones.alias("h")), x.select("doc").distinct().select("doc", ones.alias("w")), []

    monkeypatch.setattr(topics, "nmf", one_step)
    out = topics.subtopics(df, n_topics=2)
    assert out.columns == ["target_topic", "topics"]
    cut = topics.subtopics(df, n_topics=2, max_features=50)
    assert used == [20_050, 50] and cut.first()["terms_cut"] == 20_000
