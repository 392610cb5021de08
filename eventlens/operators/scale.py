"""Column standardisation with the *population* standard deviation.

Spark ML's ``StandardScaler`` divides by the sample deviation; the behaviour
to match divides by the population one, so the statistics come from one
``agg(avg, stddev_pop)`` (a one-row collect) and the scaling is a projection.
A column with zero deviation is centred (``with_mean``) or passed through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScaleStats:
    columns: tuple[str, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]  # population sd, 1.0 where it is 0 or undefined
    with_mean: bool
    rows: int = 0

    def apply(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = df
        for c, m, s in zip(self.columns, self.means, self.scales):
            x = F.col(c).cast("double")
            if self.with_mean:
                x = x - F.lit(m)
            out = out.withColumn(c + suffix, x / F.lit(s))
        return out


def fit_scaler(df: DataFrame, columns: Sequence[str], *, with_mean: bool = True) -> ScaleStats:
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for c in columns:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"), F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    means, scales = [], []
    for c in columns:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        means.append(0.0 if m is None else float(m))
        scales.append(1.0 if (s is None or s == 0.0) else float(s))
    return ScaleStats(tuple(columns), tuple(means), tuple(scales), with_mean, int(row["_rows"]))


def standardize(df: DataFrame, columns: Sequence[str], *, with_mean: bool = True) -> DataFrame:
    """Replace each column by ``(x - mean) / sd_pop`` (or ``x / sd_pop``)."""
    return fit_scaler(df, columns, with_mean=with_mean).apply(df)
