import pytest
from pyspark.sql import functions as F

from scorewright.operators import validation as V

FIELDS = (
    V.Field("PassengerId", "int", (V.greater_than(0),), unique=True),
    V.Field("Pclass", "int", (V.isin(1, 2, 3),)),
    V.Field("Name", "string", (V.non_empty(),)),
    V.Field("Sex", "string", (V.isin("male", "female"),)),
    V.Field("Age", "double", (V.at_least(0), V.at_most(120)), nullable=True),
    V.Field("Fare", "double", (V.at_least(0),)),
    V.Field("Cabin", "string", nullable=True, required=False),
    V.Field("Embarked", "string", (V.isin("S", "C", "Q"),), nullable=True),
)
LABEL = V.Field("Survived", "int", (V.isin(0, 1),))
TRAIN = V.Schema("train", (*FIELDS, LABEL), (V.min_rows(500), V.min_rate("Survived", 0.25)))
SCORE = V.Schema("score", (*FIELDS, V.Field("Survived", "int", (V.isin(0, 1),), required=False)), (V.min_rows(1),))


def broken(df, schema):
    rows = V.error_counts(df, schema).where("violations > 0").collect()
    return {(r["column"], r["check"]): r["violations"] for r in rows}


def test_good_table_passes(many):
    summary, listed = V.validate(many, TRAIN, ["PassengerId"], raise_on_error=True)
    row = summary.first()
    assert row["passed"] and row["error_count"] == 0 and row["errors"] == [] and row["schema_name"] == "train"
    assert listed.count() == 0


def test_missing_label(many):
    without = many.drop("Survived")
    table_free = V.Schema("train", TRAIN.fields)
    assert broken(without, table_free) == {("Survived", "column_in_dataframe"): 1}
    assert V.validate(without, SCORE, ["PassengerId"])[0].first()["passed"]


def test_bad_class_is_listed_and_raises(many):
    bad = many.withColumn("Pclass", F.when(F.col("PassengerId") == 9, 5).otherwise(F.col("Pclass")))
    with pytest.raises(V.ValidationError, match="Schema 'train' validation failed with 1 error"):
        V.validate(bad, TRAIN, ["PassengerId"], raise_on_error=True)
    _, listed = V.validate(bad, TRAIN, ["PassengerId"])
    row = listed.first().asDict()
    assert row["column"] == "Pclass" and row["failure_case"] == "5" and row["index"] == "9"
    assert row["schema_context"] == "Column" and row["check"] == "isin(1, 2, 3)"


def test_few_rows_fail_only_training(five):
    assert broken(five, TRAIN) == {("", "min_rows(500)"): 1}
    assert broken(five, SCORE) == {}


def test_nulls_duplicates_and_uncastable_values(spark):
    df = spark.createDataFrame(
        [("1", "x", None), ("1", "", 4.0), ("oops", "y", 130.0), (None, "z", -1.0)], "id string, name string, age double"
    )
    schema = V.Schema(
        "s",
        (
            V.Field("id", "int", (V.greater_than(0),), unique=True),
            V.Field("name", "string", (V.non_empty(),)),
            V.Field("age", "double", (V.at_least(0), V.at_most(120)), nullable=True),
        ),
    )
    assert broken(df, schema) == {
        ("id", "dtype(int)"): 1,
        ("id", "not_nullable"): 1,
        ("id", "field_uniqueness"): 2,
        ("name", "length>0"): 1,
        ("age", "greater_than_or_equal_to(0)"): 1,
        ("age", "less_than_or_equal_to(120)"): 1,
    }
    assert V.violations(df, schema, ["name"]).count() == 7
    good, bad = V.quarantine(df, schema)
    assert good.count() + bad.count() == 4 and [r["name"] for r in good.collect()] == ["x"]


def test_empty_table(many):
    empty = many.where("PassengerId < 0")
    assert broken(empty, SCORE) == {("", "min_rows(1)"): 1}


def test_request_defaults(spark):
    df = spark.createDataFrame(
        [("MALE", None, None), ("other", "", 2), ("female", "q", 1)], "Sex string, Embarked string, SibSp int"
    )
    fields = [
        V.RequestField("Sex", case="lower"),
        V.RequestField("Embarked", "S", "upper", blank_is_missing=True),
        V.RequestField("SibSp", 0),
    ]
    ready = V.normalize_requests(df, fields)
    assert [tuple(r) for r in ready.collect()] == [("male", "S", 0), ("other", "S", 2), ("female", "Q", 1)]
    schema = V.Schema("r", (V.Field("Sex", "string", (V.isin("male", "female"),)),))
    assert [r["Sex"] for r in V.quarantine(ready, schema)[1].collect()] == ["other"]


def test_batch_bounds(spark):
    df = spark.range(503).select(F.when(F.col("id") < 501, "big").otherwise("small").alias("b"))
    assert {r["b"]: r["size_ok"] for r in V.batch_sizes(df, ["b"]).collect()} == {"big": False, "small": True}
