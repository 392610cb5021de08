"""Text and model edge cases from the fixture list."""

import pytest
from pyspark.sql import functions as F

from eventlens.constants import OTHER_CLASS
from eventlens.functions.text import clean_target, clean_text
from eventlens.operators.features import impute_and_encode
from eventlens.operators.scale import standardize
from eventlens.operators.text import handle_rare_classes, infer_roles, prepare_texts, tfidf_long


def test_clean_text_fixtures(spark):
    rows = [(1, None), (2, "   "), (3, "Line one\r\nLine\ttwo"), (4, "a  b　c"), (5, "ОПЛАТА  ЖКХ ")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r["c"] for r in df.select("id", clean_text(F.col("t")).alias("c")).collect()}
    assert got == {1: "", 2: "", 3: "line one line two", 4: "a b c", 5: "оплата жкх"}
    t = spark.createDataFrame([(" x ",), (None,)], "y string").select(clean_target(F.col("y")).alias("y"))
    assert [r["y"] for r in t.collect()] == ["x", None]


def test_blank_rows_dropped_and_rare_classes(spark):
    rows = [(i, f"text {i}", "big") for i in range(5)] + [(10, "only one", "solo"), (11, "   ", "big"),
                                                           (12, "no label", None), (13, "x", "edge"), (14, "y", "edge")]
    df = spark.createDataFrame(rows, "id long, body string, label string")
    prep = prepare_texts(df, "body", "label", keep=["id"])
    assert {r["id"] for r in prep.collect()} == {0, 1, 2, 3, 4, 10, 13, 14}
    merged, rare = handle_rare_classes(prep, min_class_count=2, merge_to_other=True)
    assert [tuple(r) for r in rare.collect()] == [("solo", 1)]
    assert {r["target"] for r in merged.collect()} == {"big", "edge", OTHER_CLASS}  # "edge" has exactly 2
    dropped, _ = handle_rare_classes(prep, min_class_count=2)
    assert dropped.filter(F.col("target") == "solo").count() == 0 and dropped.count() == 7


def test_role_inference_picks_long_text_and_low_cardinality_target(spark):
    rows = [(i, "a fairly long sentence number %d" % i, "x" if i % 2 else "y", i % 7) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, body string, cls string, other int")
    r = infer_roles(df).first()
    assert (r["text_col"], r["target_col"]) == ("body", "cls")


def test_tfidf_rows_have_unit_length(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma"), (3, "alpha gamma gamma")], "doc_id long, text string")
    out = tfidf_long(df, min_df=1)
    norms = out.groupBy("doc_id").agg(F.sum(F.col("tfidf") ** 2).alias("n")).collect()
    assert all(abs(r["n"] - 1.0) < 1e-12 for r in norms)
    assert out.filter(F.col("term") == "alpha beta").count() == 1


def test_constant_column_and_all_null_age(spark):
    df = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "id long, c double, v double")
    z = {r["id"]: (r["c"], r["v"]) for r in standardize(df, ["c", "v"]).collect()}
    assert z == {1: (0.0, -1.0), 2: (0.0, 1.0)}
    ds = spark.createDataFrame([(1, None, None), (2, None, "F")], "device_id long, age int, gender string")
    with pytest.raises(ValueError):
        impute_and_encode(ds)
    ok = impute_and_encode(ds.withColumn("age", F.lit(30)))
    assert sorted(ok.columns) == ["age", "device_id", "gender_F", "gender_U"]


def test_a_target_of_very_many_values_is_not_collected(spark, monkeypatch):
    from eventlens.operators import text

    monkeypatch.setattr(text, "MAX_CLASSES", 50)
    df = spark.range(200).select(F.concat(F.lit("some words "), F.col("id")).alias("body"), F.concat(F.lit("t"), F.col("id")).alias("topic"))
    with pytest.raises(ValueError, match="rare classes"):
        text.train_text(df, "body", "topic")
