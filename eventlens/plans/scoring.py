"""Saved models in use: a pipeline with the schema of its input, loaded again to score a table.

``save_scorer`` writes the Spark ML pipeline and, beside it, the columns that it
reads with their types.  ``load_scorer`` reads both; ``score`` refuses a table that
lacks a column or has another type for it, and adds the class and its probability.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlens.operators.quality import InputError
from eventlens.sinks.writers import save_model

_SCHEMA = "place int, name string, type string"


@dataclass(frozen=True)
class Scorer:
    model: PipelineModel
    columns: tuple[tuple[str, str], ...]

    def check(self, df: DataFrame) -> None:
        """Raise if ``df`` lacks an input column or has it with another type."""
        have = dict(df.dtypes)
        faults = [f"{c} is missing" if c not in have else f"{c} is {have[c]}, not {t}" for c, t in self.columns if have.get(c) != t]
        if faults:
            raise InputError("input does not fit the saved model: " + "; ".join(faults))

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``score`` (probability of the second class; NaN where an input is null) and ``predicted``."""
        self.check(df)
        out = self.model.transform(df)
        return out.select(*df.columns, vector_to_array("probability")[1].alias("score"), F.col("prediction").alias("predicted"))


def save_scorer(model: PipelineModel, train: DataFrame, feature_cols: Sequence[str], path: str) -> str:
    spark, types = train.sparkSession, dict(train.dtypes)
    save_model(model, f"{path}/model")
    rows = [(i, c, types[c]) for i, c in enumerate(feature_cols)]
    spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/input")
    return path


def load_scorer(spark: SparkSession, path: str) -> Scorer:
    rows = spark.read.schema(_SCHEMA).json(f"{path}/input").orderBy("place").collect()  # one row per input column
    return Scorer(PipelineModel.load(f"{path}/model"), tuple((r["name"], r["type"]) for r in rows))
