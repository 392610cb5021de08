import random

import pytest


@pytest.fixture()
def rng():
    return random.Random(7)


@pytest.fixture()
def documents(spark):
    """Nulls, empty and repeated rows, a clashing extra column."""

    def make(texts):
        rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
        rows += [rows[0], (None, texts[-1], "x", "y")]
        return spark.createDataFrame(rows, "doc_id long, text string, ids string, spans string")

    return make
