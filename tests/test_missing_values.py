"""NaN, null labels and numeric ties, which the driver's tables do not hold."""

from pyspark.sql import functions as F

from scorewright.functions.columns import truncated_json
from scorewright.operators import features, feedback, model, ordered, validation


def test_nan_is_imputed(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert sorted(r["x"] for r in features.impute(df, {"x": 2.0}, {}).collect()) == [1.0, 2.0, 2.0, 3.0]


def test_nan_is_missing_to_validation(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    field = validation.Field("x", "double", nullable=False)
    violated = dict(validation.rules(field))["not_nullable"]
    assert df.where(violated).count() == 2


def test_a_null_label_is_no_label(spark):
    preds = spark.createDataFrame([("a",), ("b",)], "id string")
    labels = spark.createDataFrame([("a", 1, 1), ("a", None, 2), ("b", None, 1), (None, 1, 1)], "id string, y int, at int")
    got = {r["id"]: (r["ground_truth"], r["feedback_received"]) for r in feedback.label_join(preds, labels, "id", "id", "y", ["at"]).collect()}
    assert got == {"a": (1, True), "b": (None, False)}


def test_numeric_ties_go_by_number(spark):
    df = spark.createDataFrame([(9, "9"), (10, "10")], "n int, s string")
    assert {r["feature"]: r["mode"] for r in ordered.modes(df, ["n", "s"]).collect()} == {"n": "9", "s": "10"}


def test_fit_skips_rows_without_a_label(spark):
    df = spark.createDataFrame([(float(i % 2), i % 2) for i in range(20)] + [(5.0, None)], "x double, y int")
    assert model.fit_logreg(df, ["x"], "y").weights[0] > 0


def test_json_is_whole(spark):
    text = spark.range(1).select(truncated_json(F.struct(F.lit("x" * 3000).alias("t")))).first()[0]
    assert len(text) == 3008 and text.endswith('"}')
