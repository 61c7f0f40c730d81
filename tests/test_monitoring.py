import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.functions.columns import row_id
from scorewright.operators import drift as D
from scorewright.operators import feedback as FB
from scorewright.operators import metrics as M


def test_mean_shift_of_ten_years(five):
    cur = five.withColumn("Age", F.col("Age") + 10)
    row = {r["feature"]: r for r in D.mean_shift(five, cur, ["Age", "Fare"]).collect()}
    assert row["Age"]["shift"] == pytest.approx(10) and row["Fare"]["shift"] == pytest.approx(0)


def brute_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    gap = np.abs([np.mean(a <= x) - np.mean(b <= x) for x in grid])
    return gap.max(), float(np.sum(gap[:-1] * np.diff(grid)))


def test_numeric_tests_match_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(0, 1, 300), 1), np.round(rng.normal(0.3, 1, 200), 1)
    ref, cur = (spark.createDataFrame([(float(v),) for v in x], "x double") for x in (a, b))
    row = D.feature_tests(ref, cur, ["x"]).first()
    d, w = brute_ks(a, b)
    assert row["statistic"] == pytest.approx(d) and row["wasserstein"] == pytest.approx(w)
    assert row["reference_mean"] == pytest.approx(a.mean()) and row["n_current"] == 200


def test_same_sample_never_drifts(many):
    features, data = D.drift(many, many, ["Age", "Fare"], ["Sex", "Embarked"])
    assert all(r["drift_score"] == 1.0 and not r["drift_detected"] for r in features.collect())
    assert data.first()["overall_drift_detected"] is False


def test_categories_and_share(many):
    cur = many.withColumn("Sex", F.lit("male")).withColumn("Age", F.col("Age") + 50)
    features, data = D.drift(many, cur, ["Age", "Fare"], ["Sex", "Embarked"])
    hit = {r["feature"]: r["drift_detected"] for r in features.collect()}
    assert hit == {"Age": True, "Fare": False, "Sex": True, "Embarked": False}
    row = data.first()
    assert (row["drift_percentage"], row["overall_drift_detected"]) == (50.0, True)
    assert D.dataset_drift(features, share=0.51).first()["overall_drift_detected"] is False


def test_one_category_is_no_drift(spark):
    one = spark.createDataFrame([("a",)] * 4, "c string")
    row = D.feature_tests(one, one, [], ["c"]).first()
    assert (row["statistic"], row["dof"], row["drift_score"]) == (0.0, 0, 1.0)


def test_empty_side_is_not_flagged(many):
    features, data = D.drift(many, many.where("Age < -1"), ["Age"], ["Sex"])
    assert not any(r["drift_detected"] for r in features.collect())


def test_vanished_features_are_flagged(many):
    gone = many.withColumns({"Age": F.lit(float("nan")), "Sex": F.lit(None).cast("string"), "Cabin": F.lit(None).cast("string")})
    ref = many.withColumn("Cabin", F.lit(None).cast("string"))
    for a, b in ((ref, gone), (gone, ref)):
        features, data = D.drift(a, b, ["Age", "Fare"], ["Sex", "Cabin"])
        rows = {r["feature"]: r for r in features.collect()}
        assert {k: r["drift_detected"] for k, r in rows.items()} == {"Age": True, "Fare": False, "Sex": True, "Cabin": False}
        assert rows["Age"]["statistic"] is None and rows["Age"]["stattest_name"] == "ks"
        assert {rows["Sex"]["n_reference"], rows["Sex"]["n_current"]} == {0, 550}
        assert (data.first()["n_features_tested"], data.first()["drift_percentage"]) == (4, 50.0)


def test_missing_values_leave_statistics_alone(many):
    some = many.withColumn("Age", F.when(F.col("PassengerId") % 3 > 0, F.col("Age")))
    row = D.feature_tests(many, some, ["Age"]).first()
    want = D.feature_tests(many, some.where("Age IS NOT NULL"), ["Age"]).first()
    assert row["missing_current"] == 183
    assert all(row[c] == want[c] for c in ("statistic", "drift_score", "wasserstein", "n_current", "current_mean"))


def test_no_common_columns(many):
    with pytest.raises(ValueError, match="No common feature columns"):
        D.drift(many.select("Age"), many.select("Fare"), ["Age", "Fare"])


def test_scoring_columns_are_no_features(many):
    df = many.withColumn("prediction", F.lit(1))
    assert D.feature_columns(df, ["Age", "prediction", "absent", "Fare"]).columns == ["Age", "Fare"]


def test_prediction_drift_is_strict(spark):
    df = spark.createDataFrame([(1,)] * 43 + [(0,)] * 57, "prediction int")
    row = D.prediction_drift(df).first()
    assert row["absolute_shift"] == 0.05 and row["current_positive_rate"] == 0.43
    assert row["prediction_drift_detected"] == (abs(0.43 - 0.38) > 0.05)
    assert D.prediction_drift(df, baseline=0.3).first()["prediction_drift_detected"]
    assert D.prediction_drift(df.where("prediction = 5")).first()["prediction_drift_detected"] is False


@pytest.mark.parametrize("acc,hit", [(0.75, True), (0.78, False), (0.9, False)])
def test_concept_drift(spark, acc, hit):
    rows = spark.createDataFrame([(acc, 100)], "accuracy double, support long")
    row = D.concept_drift(rows).first()
    assert row["concept_drift_detected"] is hit
    assert row["reason"] == ("Concept drift detected" if hit else "Performance within acceptable range")


def test_concept_drift_needs_labels(spark):
    row = D.concept_drift(spark.createDataFrame([(0.0, 0)], "accuracy double, support long")).first()
    assert (row["concept_drift_detected"], row["reason"], row["current_accuracy"]) == (False, "No ground truth", None)


def test_degradation_scalars(spark):
    rows = spark.createDataFrame([(0.75, 8)], "accuracy double, support long")
    assert D.concept_drift(rows, baseline=0.85, threshold=0.05).first()["concept_drift_detected"]


GRADES = [(True, True, 10.0, "CRITICAL", "HIGH"), (False, True, 0.0, "HIGH", "MEDIUM"), (False, False, 60.0, "HIGH", "NONE"),
          (False, False, 50.0, "MEDIUM", "NONE"), (False, False, 20.0, "NONE", "NONE"), (True, False, 20.0, "LOW", "LOW")]


@pytest.mark.parametrize("data,concept,pct,severity,fallback", GRADES)
def test_severity(spark, data, concept, pct, severity, fallback):
    df = spark.createDataFrame(
        [("g", data, concept, pct, data or concept)],
        "g string, data_drift_detected boolean, concept_drift_detected boolean, drift_percentage double, any_drift_detected boolean",
    )
    row = D.grade(df).first()
    assert row["severity"] == severity and row["recommendation"] == D.RECOMMENDATIONS[severity]
    assert row["action_required"] == (severity in ("CRITICAL", "HIGH"))
    gate = D.alert_gate(D.grade(df).where("g = 'other'"), df, ["g"]).collect()
    assert [r["severity"] for r in gate] == ([fallback] if fallback in D.ALERT_SEVERITIES else [])


def test_summary_without_groups(spark):
    data = spark.createDataFrame([(True, 60.0)], "overall_drift_detected boolean, drift_percentage double")
    none = spark.createDataFrame([], "concept_drift_detected boolean")
    pred = spark.createDataFrame([(None,)], "prediction_drift_detected boolean")
    row = D.monitoring_summary(data, none, pred).first()
    assert row.asDict() == {
        "data_drift_detected": True, "concept_drift_detected": False, "prediction_drift_detected": False,
        "drift_percentage": 60.0, "any_drift_detected": True,
    }


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 1)], "id long, prediction int")


@pytest.fixture(scope="module")
def late(spark):
    return spark.createDataFrame([("1", 0, 1), ("2", 0, 1), ("2", 1, 2), ("9", 1, 1)], "key string, label int, at int")


def test_last_label_wins_on_every_row_of_a_key(log, late):
    rows = FB.label_join(log, late, "id", "key", "label", ["at"]).collect()
    got = sorted((r["id"], r["prediction"], r["ground_truth"], r["feedback_received"]) for r in rows)
    assert got == [(1, 1, 0, True), (2, 0, 1, True), (2, 1, 1, True), (3, 1, None, False)]
    assert FB.submit_labels(log, late, "id", "key", "label", ["at"]).first()["updated"] == 3
    assert [r["id"] for r in FB.unmatched(log, late, "id", "key").collect()] == [3]


def test_coverage_gate(log, late):
    joined = FB.label_join(log, late, "id", "key", "label", ["at"])
    row = FB.coverage(joined).first()
    assert (row["total_predictions"], row["feedback_received"]) == (4, 3)
    assert (row["coverage_fraction"], row["coverage_percent"]) == (0.75, 75.0)
    assert FB.matched(joined, 0.75).count() == 3 and FB.matched(joined, 0.76).count() == 0
    empty = FB.coverage(joined.where("id > 100")).first()
    assert (empty["total_predictions"], empty["coverage_fraction"]) == (0, 0.0)
    m = M.metrics(FB.matched(joined), "actual_label", "prediction").first()
    assert m["accuracy"] == pytest.approx(1 / 3)


def test_log_is_idempotent(spark, log, tmp_path):
    path = str(tmp_path / "log")
    for run in ("a", "b", "b"):
        FB.log_predictions(log.distinct(), path, ["id", "prediction"], run)
    back = spark.read.parquet(path)
    assert back.count() == 8 and back.select("inference_id").distinct().count() == 8


def test_row_ids_tell_nulls_and_separators_apart(spark):
    rows = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "a"), ("a", None), ("", "a"), ('a","b', "c"), ("a", 'b","c')], "x string, y string")
    assert rows.select(row_id(["x", "y"], "run")).distinct().count() == 7


def test_quality(many):
    cur = many.withColumn("Age", F.when(F.col("PassengerId") <= 55, None).otherwise(F.col("Age") + 500))
    cur = cur.withColumn("Embarked", F.when(F.col("PassengerId") == 1, "X").otherwise(F.col("Embarked")))
    rows = {r["column"]: r for r in D.quality_compare(many, cur, ["Age", "Fare"], ["Embarked"]).collect()}
    assert rows["Age"]["missing_rate_change"] == pytest.approx(0.1) and rows["Age"]["out_of_range"]
    assert rows["Embarked"]["new_values"] == 1 and not rows["Fare"]["out_of_range"]


def test_ingested_stream_keeps_the_unparsable_lines(spark, sf, monkeypatch):
    """Every whole line is ingested and every line broken off is in the second table; blank ones are in neither."""
    from scorewright.catalog import streams

    tables, real = {}, streams.finish

    def finish(spark, stream, name, mode="append"):
        tables[name] = real(spark, stream, name, mode)
        return tables[name]

    monkeypatch.setattr(streams, "finish", finish)
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    assert streams.stream_ingest_logs(spark, sf).count() == n
    lines = tables["quarantined"].groupBy("line").count().collect()
    assert [(r["line"], r["count"]) for r in lines] == [('{"request":{"body":{', n)]


def test_log_has_label_columns_that_late_labels_fill(spark, tmp_path):
    path = str(tmp_path / "log")
    FB.log_predictions(spark.createDataFrame([(1, 1), (2, 0)], "id long, prediction int"), path, ["id"], "a")
    back = spark.read.parquet(path)
    empty = back.select("ground_truth", "feedback_received", "feedback_received_at").distinct().collect()
    assert [tuple(r) for r in empty] == [(None, False, None)]
    late = spark.createDataFrame([(1, 0, 1)], "key long, label int, at int")
    once = FB.label_join(back, late, "id", "key", "label", ["at"])
    again = FB.label_join(once, late.where("key > 1"), "id", "key", "label", ["at"])
    for joined in (once, again):
        got = {r["id"]: r for r in joined.collect()}
        assert (got[1]["ground_truth"], got[1]["feedback_received"]) == (0, True) and got[1]["feedback_received_at"]
        assert (got[2]["ground_truth"], got[2]["feedback_received"], got[2]["feedback_received_at"]) == (None, False, None)
