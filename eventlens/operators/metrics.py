"""Exact evaluation metrics as DataFrame computations.

* ROC-AUC (tie-corrected Mann–Whitney) and average precision (the step sum
  Σ ΔRecall·Precision over distinct score thresholds) — both need running
  counts over the score order; they come from :func:`running_sums`, never a
  single-partition window.  Rows are first collapsed to one row per distinct
  score (a partial + final aggregation).
* Accuracy, macro-F1 and the per-class report come from the confusion table
  ``groupBy(y, ŷ).count()``, whose size is classes², not rows.
* Euclidean silhouette on a bounded, seeded sample: each task computes the
  distances from its share of sample points to the whole sample (shipped once
  with the task, size bounded by ``sample_size × dim``) and emits one value
  per point — never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlens.constants import SEED, SILHOUETTE_SAMPLE
from eventlens.operators.ordered import running_sums
from eventlens.session import stage_table


class MetricError(ValueError):
    """A metric is undefined for the given input."""


class SampleTooLarge(ValueError):
    """The silhouette's sample does not fit in a task; never treated as an undefined metric."""


def _score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    pos = F.col(label).cast("int") == 1
    return df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(pos).alias("pos"), F.count_if(~pos).alias("neg")
    )


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row ``(roc_auc)``; NaN when only one class is present."""
    g = running_sums(_score_table(df, score, label), ["s"], ["neg"])
    part = g.agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") * 0.5)).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    return part.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / (F.col("P") * F.col("N")))
        .otherwise(F.lit(float("nan")))
        .alias("roc_auc")
    )


def average_precision(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row ``(average_precision)``: Σ over distinct thresholds (descending)
    of (positives at the threshold / all positives) × precision at it.
    NaN when only one class is present (as the reference reports it)."""
    g = running_sums(_score_table(df, score, label), [F.col("s").desc()], ["pos", "neg"])
    part = g.agg(
        F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("num"),
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
    )
    return part.select(
        F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("num") / F.col("P"))
        .otherwise(F.lit(float("nan")))
        .alias("average_precision")
    )


# --- classification --------------------------------------------------------

def confusion(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """``(y, y_pred, n)`` with labels as strings."""
    return df.groupBy(F.col(y).cast("string").alias("y"), F.col(y_pred).cast("string").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n")
    )


def per_class(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """``(label, precision, recall, f1, support)`` for every label seen in the
    truth or the prediction; a zero division gives 0.

    Each confusion cell counts once toward its true label (support, and true
    positives on the diagonal) and once toward its predicted label, so one
    aggregation over the exploded cells gives all three counts."""
    cm = confusion(df, y, y_pred)
    zero = F.lit(0).cast("long")
    cells = F.explode(
        F.array(
            F.struct(
                F.col("y").alias("label"),
                F.col("n").alias("support"),
                zero.alias("predicted"),
                F.when(F.col("y") == F.col("y_pred"), F.col("n")).otherwise(zero).alias("tp"),
            ),
            F.struct(F.col("y_pred").alias("label"), zero.alias("support"), F.col("n").alias("predicted"), zero.alias("tp")),
        )
    )
    t = (
        cm.select(cells.alias("c"))
        .select("c.*")
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.select("label", "support", p.alias("precision"), r.alias("recall"))
    f1 = F.when(
        F.col("precision") + F.col("recall") > 0,
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
    ).otherwise(0.0)
    return t.select("label", "precision", "recall", f1.alias("f1"), F.col("support").cast("long").alias("support"))


def accuracy_macro_f1(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """One row ``(accuracy, f1_macro)``."""
    pc = per_class(df, y, y_pred)
    return pc.agg(
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
    )


def classification_report(df: DataFrame, y: str, y_pred: str) -> DataFrame:
    """Long-form report: one row per label, then ``accuracy`` (its value in
    ``f1``), ``macro avg`` and ``weighted avg``; support is the row count."""
    pc = per_class(df, y, y_pred)
    total = F.sum("support")
    summary = pc.agg(
        (F.sum(F.col("recall") * F.col("support")) / total).alias("acc"),
        F.avg("precision").alias("mp"),
        F.avg("recall").alias("mr"),
        F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("wf"),
        total.cast("long").alias("n"),
    )
    rows = F.explode(
        F.array(
            F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), F.col("acc").alias("f1"), F.col("n").alias("support")),
            F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("n").alias("support")),
            F.struct(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                     F.col("wf").alias("f1"), F.col("n").alias("support")),
        )
    )
    tail = summary.select(rows.alias("r")).select("r.*")
    return pc.unionByName(tail)


# --- silhouette ---------------------------------------------------------------

def _as_array(df: DataFrame, features: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import VectorUDT

    dtype = df.schema[features].dataType
    if isinstance(dtype, VectorUDT):
        return df.withColumn(features, vector_to_array(features))
    return df.withColumn(features, F.col(features).cast("array<double>"))


def _check_sizes(counts: dict, n: int) -> None:
    if n < 3:
        raise MetricError("not enough samples for silhouette")
    if len(counts) < 2:
        raise MetricError("need at least 2 clusters for silhouette")
    if min(counts.values()) < 2:
        raise MetricError("some clusters have fewer than 2 samples")


def silhouette_sample(
    df: DataFrame,
    features: str,
    cluster: str,
    *,
    sample_size: int = SILHOUETTE_SAMPLE,
    seed: int = SEED,
    key: str | None = None,
    resamples: int = 5,
) -> DataFrame:
    """The rows the silhouette is computed on: all rows when there are at most
    ``sample_size``, else a seeded exact-size sample (hash order, a bounded
    top-k).  Raises :class:`MetricError` on the same conditions as the
    reference: < 3 rows, < 2 clusters, a cluster of one row, or a sample that
    keeps a one-row cluster after ``resamples`` further draws."""
    counts = {r[0]: r[1] for r in df.groupBy(cluster).count().collect()}
    n = sum(counts.values())
    _check_sizes(counts, n)
    if n <= sample_size:
        return df
    hash_of = [F.col(key)] if key else [F.col(features).cast("string"), F.col(cluster)]
    for attempt in range(resamples + 1):
        h = F.xxhash64(F.lit(seed + attempt), *hash_of)
        sample = df.withColumn("_h", h).orderBy("_h").limit(sample_size).drop("_h")
        sc = {r[0]: r[1] for r in sample.groupBy(cluster).count().collect()}
        if len(sc) >= 2 and min(sc.values()) >= 2:
            return sample
    raise MetricError("could not draw a sample without one-row clusters")


def _silhouette_points(ref_x: np.ndarray, ref_y: np.ndarray, chunk: int = 16):
    """Per-batch function: silhouette value of each point against the reference set."""
    order = np.argsort(ref_y, kind="stable")
    rx, ry = ref_x[order], ref_y[order]
    labels, starts, sizes = np.unique(ry, return_index=True, return_counts=True)

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["f"].to_numpy()).astype(np.float64)
            own = pdf["c"].to_numpy()
            out = np.empty(len(pdf))
            for i in range(0, len(pdf), chunk):
                diff = x[i : i + chunk, None, :] - rx[None, :, :]
                dist = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
                sums = np.add.reduceat(dist, starts, axis=1)
                rows, li = np.arange(len(sums)), np.searchsorted(labels, own[i : i + chunk])
                a = sums[rows, li] / (sizes[li] - 1)
                means = sums / sizes
                means[rows, li] = np.inf
                b = means.min(axis=1)
                m = np.maximum(a, b)
                out[i : i + chunk] = np.where(m == 0, 0.0, (b - a) / np.where(m == 0, 1.0, m))
            yield pd.DataFrame({"s": out})

    return run


#: Rows whose distances to as many others one step of the full silhouette holds.
BLOCK_ROWS = 1_024


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances; where products cancel, they are taken from the differences."""
    norms = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :]
    sq = norms - 2.0 * (x @ y.T)
    at, to = np.nonzero(sq <= 1e-6 * norms)
    for i in range(0, len(at), 1 << 14):
        j = slice(i, i + (1 << 14))
        diff = x[at[j]] - y[to[j]]
        sq[at[j], to[j]] = np.einsum("ij,ij->i", diff, diff)
    return np.sqrt(sq)


def _silhouette_of_all(arr: DataFrame, features: str, cluster: str) -> DataFrame:
    """Blocks of rows meet all blocks; a task adds the sums per point and cluster, and no pair leaves it."""
    counts = {r[0]: r[1] for r in arr.groupBy(cluster).count().collect()}
    n = sum(counts.values())
    _check_sizes(counts, n)
    place = {c: i for i, c in enumerate(counts)}
    sizes = np.array(list(counts.values()), dtype=np.float64)
    k = len(sizes)

    def pack(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(i, BLOCK_ROWS)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                y = np.array([place[c] for c in part.column(1).to_pylist()], dtype=np.int32)
                yield pa.RecordBatch.from_pydict({"x": [x.tobytes()], "y": [y.tobytes()]})

    def meet(batches):
        sums, own = {}, {}
        for pdf in batches:
            for block, x, y, ox, oy in pdf.itertuples(index=False):
                y, oy = np.frombuffer(y, np.int32), np.frombuffer(oy, np.int32)
                dist = _distances(np.frombuffer(x).reshape(len(y), -1), np.frombuffer(ox).reshape(len(oy), -1))
                part = dist @ np.eye(k)[oy]
                sums[block] = sums[block] + part if block in sums else part
                own[block] = y
        for block, part in sums.items():
            yield pd.DataFrame({"block": [block], "y": [own[block].tobytes()], "sums": [part.tobytes()]})

    def score(pdf):
        y = np.frombuffer(pdf["y"].iloc[0], np.int32)
        sums = sum(np.frombuffer(v).reshape(len(y), k) for v in pdf["sums"])
        rows = np.arange(len(y))
        a = sums[rows, y] / (sizes[y] - 1)
        means = sums / sizes
        means[rows, y] = np.inf
        b = means.min(axis=1)
        m = np.maximum(a, b)
        s = np.where(m == 0, 0.0, (b - a) / np.where(m == 0, 1.0, m))
        return pd.DataFrame({"s": [s.sum()]})

    spark = arr.sparkSession
    n_parts = max(1, min(-(-n // BLOCK_ROWS), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    packed = arr.select(features, cluster).repartition(n_parts).mapInArrow(pack, "x binary, y binary")
    blocks = stage_table(spark, packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    left = blocks.select("block", "x", "y").repartition(n_parts, "block")
    pairs = left.crossJoin(blocks.select(F.col("x").alias("ox"), F.col("y").alias("oy")))
    scored = pairs.mapInPandas(meet, "block long, y binary, sums binary").groupBy("block").applyInPandas(score, "s double")
    return scored.agg((F.sum("s") / F.lit(n)).alias("silhouette"))


def silhouette(
    df: DataFrame,
    features: str,
    cluster: str,
    *,
    sample_size: int | None = None,
    seed: int = SEED,
    key: str | None = None,
    max_ship_bytes: int = 256 << 20,
) -> DataFrame:
    """One row ``(silhouette)``: mean Euclidean silhouette over all rows, whatever their number.

    The work grows with the square of the rows (:func:`silhouette_all_rows` is
    linear, for squared distances).  With ``sample_size``, one row
    ``(silhouette, rows_scored)`` over a sample that travels with every task: its
    size (``rows × dim × 8`` bytes) is checked against ``max_ship_bytes``
    before it is collected."""
    arr = _as_array(df.select(features, cluster, *([key] if key else [])), features)
    if sample_size is None:
        return _silhouette_of_all(arr, features, cluster)
    dim = arr.select(F.max(F.size(features)).alias("d")).first()["d"] or 0
    shipped = min(sample_size, arr.count())
    if shipped * dim * 8 > max_ship_bytes:
        raise SampleTooLarge(
            f"a sample of {shipped} × {dim} values exceeds {max_ship_bytes} bytes; lower sample_size"
        )
    sample = silhouette_sample(arr, features, cluster, sample_size=sample_size, seed=seed, key=key)
    rows = sample.select(F.col(features).alias("f"), F.col(cluster).alias("c")).collect()
    ref_x = np.array([r["f"] for r in rows], dtype=np.float64)
    ref_y = np.array([r["c"] for r in rows])
    n_parts = max(1, min(len(rows) // 64, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    points = sample.select(F.col(features).alias("f"), F.col(cluster).alias("c")).repartition(n_parts)
    per_point = points.mapInPandas(_silhouette_points(ref_x, ref_y), "s double")
    return per_point.agg(F.avg("s").alias("silhouette"), F.count("s").alias("rows_scored"))


def silhouette_all_rows(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """One row ``(silhouette)``: mean squared-Euclidean silhouette over all rows.

    Squared distances to a whole cluster follow from its count, vector sum and
    sum of squared norms, so one aggregate and one pass score every row
    exactly, whatever their number; what is sent out is one vector per cluster.
    Raises :class:`MetricError` for fewer than 3 rows or 2 clusters, or a cluster of one row."""
    counts = {r[0]: r[1] for r in df.groupBy(cluster).count().collect()}
    _check_sizes(counts, sum(counts.values()))
    arr = _as_array(df.select(features, cluster), features)
    rows = arr.select(array_to_vector(features).alias("features"), F.col(cluster).cast("double").alias("prediction"))
    value = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(rows)
    return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")


def silhouette_value(df: DataFrame, features: str, cluster: str, **kw) -> float:
    try:
        return float(silhouette(df, features, cluster, **kw).first()["silhouette"])
    except MetricError:
        return math.nan


__all__ = [
    "MetricError",
    "SampleTooLarge",
    "roc_auc",
    "average_precision",
    "confusion",
    "per_class",
    "accuracy_macro_f1",
    "classification_report",
    "silhouette",
    "silhouette_all_rows",
    "silhouette_sample",
    "silhouette_value",
]
