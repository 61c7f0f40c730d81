import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from scorewright.operators import explain as E
from scorewright.operators import features as X
from scorewright.operators import model as ML
from scorewright.plans.scoring import score_table
from scorewright.plans.training import train
from scorewright.sources import readers, writers
from scorewright.operators import surrogate as SG
from scorewright.streaming import jobs as J


@pytest.fixture(scope="module")
def trained(many):
    return train(many, X.passenger_spec(), "Survived", ["PassengerId"], tol=1e-10)


def test_training_report(trained):
    rows = {r["split"]: r for r in trained.metrics.collect()}
    assert rows["train"]["support"] + rows["test"]["support"] == 550
    for r in rows.values():
        assert 0.5 < r["roc_auc"] <= 1.0 and 0.0 <= r["f1_score"] <= 1.0
    assert trained.importance.count() == 12
    p = trained.scored.agg(F.min("survival_probability"), F.max("survival_probability"), F.count_if(F.col("prediction").isNull())).first()
    assert 0 < p[0] and p[1] < 1 and p[2] == 0


def test_scoring_ignores_the_rest_of_the_batch(many, trained):
    spec = X.passenger_spec()
    every = {r["PassengerId"]: r["survival_probability"] for r in score_table(many, spec, trained.state, trained.model, ["PassengerId"]).collect()}
    some = score_table(many.where("PassengerId <= 3"), spec, trained.state, trained.model, ["PassengerId"]).collect()
    assert len(every) == 550
    for r in some:
        assert r["survival_probability"] == pytest.approx(every[r["PassengerId"]], abs=1e-12)


def gradient(x, y, w, model, C):
    z = x @ np.array(model.weights) + model.intercept
    r = w * (1 / (1 + np.exp(-z)) - y)
    return np.array(model.weights) + C * (x.T @ r), C * r.sum()


@pytest.mark.parametrize("C,balanced", [(1.0, True), (0.1, False)])
def test_fit_is_stationary(spark, C, balanced):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + rng.normal(size=400) > 0.8).astype(int)
    df = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(x, y)], "a double, b double, c double, y int")
    model = ML.fit_logreg(df, ["a", "b", "c"], "y", C=C, balanced=balanced, tol=1e-12)
    weight = np.where(y == 1, 400 / (2 * y.sum()), 400 / (2 * (1 - y).sum())) if balanced else np.ones(400)
    g, g0 = gradient(x, y, weight, model, C)
    assert np.abs(g).max() < 1e-3 and abs(g0) < 1e-3


def test_l1_drops_features(many, trained):
    ready = X.apply(many, X.passenger_spec(), trained.state, ["Survived"])
    model = ML.fit_logreg(ready, X.passenger_spec().select, "Survived", C=0.01, penalty="l1")
    assert sum(w == 0 for w in model.weights) > 0


def test_trials_are_seeded_and_in_range():
    trials = ML.draw_trials(50, 42)
    assert trials == ML.draw_trials(50, 42) and len(trials) == 50
    assert all(1e-3 <= t.C <= 10 and 200 <= t.max_iter <= 2000 and t.max_iter % 200 == 0 for t in trials)
    assert {t.penalty for t in trials} == {"l1", "l2", None}


def test_search_takes_a_custom_fit(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "a double, y int")
    fixed = lambda rows, t: ML.LogisticModel(("a",), (float(t.number),), 0.0)
    trials = ML.search(df, df, ["a"], "y", n_trials=3, fit_one=fixed)
    assert trials.count() == 3 and trials.where("val_roc_auc IS NULL").count() == 0
    assert ML.best_trial(trials).count() == 1


def test_best_trial_ties(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9), (3, None)], "number int, val_roc_auc double")
    assert ML.best_trial(df).first()["number"] == 1


def test_scored_lines(spark):
    from scorewright.functions.columns import scored_line

    df = spark.createDataFrame([(100, 1, 0.9, "Survived"), (101, 0, 0.1, "Did not survive")], "id long, p int, s double, l string")
    lines = [r[0] for r in df.select(scored_line("id", "p", "s", "l")).collect()]
    assert lines == ["100,1,0.9000,Survived", "101,0,0.1000,Did not survive"]


def test_model_round_trip(spark, trained, tmp_path):
    writers.save_model(trained.model, spark, str(tmp_path / "m"))
    assert writers.load_model(spark, str(tmp_path / "m")) == trained.model


def test_additivity(many, trained):
    ready = X.apply(many, X.passenger_spec(), trained.state, ["PassengerId"])
    means = E.background_means(ready, trained.model.features)
    assert E.additivity_gap(ready, trained.model, means, ["PassengerId"]).agg(F.max("gap")).first()[0] < 1e-9
    local = E.explain_rows(E.first_rows(ready, ["PassengerId"], 3), trained.model, means, ["PassengerId"])
    rows = local.orderBy("PassengerId", "rank").collect()
    assert len(rows) == 24 and [r["rank"] for r in rows[:8]] == list(range(1, 9))
    assert all(abs(a["phi"]) >= abs(b["phi"]) for a, b in zip(rows[:7], rows[1:8]))


def test_csv_quarantine_judges_whole_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,age\n1,22\n2,old\n3\n4,5,6\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("age", T.DoubleType())])
    good, bad = readers.read_csv(spark, str(tmp_path), schema)
    assert [r["id"] for r in good.select("id").collect()] == [1]
    assert sorted(r["line"] for r in bad.select("line").collect()) == ["2,old", "3", "4,5,6"]


def test_jsonl(spark, tmp_path):
    (tmp_path / "2024").mkdir()
    (tmp_path / "2024" / "a.jsonl").write_text(
        '{"request":{"body":{"Age":22,"Sex":"male"},"headers":{"deployment":"blue"}},"response":{"body":{"prediction":1}}}\n\n'
        '{"request":{"body":{"Age":3}},"response":{"body":{"prediction":0}}}\nnot json\n'
    )
    (tmp_path / "b.txt").write_text("{}\n")
    good, bad = readers.read_jsonl(spark, str(tmp_path), readers.REQUEST_LOG)
    flat = readers.flatten_requests(good, ["Age", "Sex"]).collect()
    assert [tuple(r) for r in flat] == [("22", "male", "1", "blue"), ("3", None, "0", "unknown")]
    assert [r["line"] for r in bad.collect()] == ["not json"]
    stream, _ = J.ingest_requests(spark, str(tmp_path), readers.REQUEST_LOG, ["Age", "Sex"])
    J.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(flat)


def test_latest_compares_numbers(spark):
    df = spark.createDataFrame([("a", "9"), ("a", "10"), ("b", "2")], "k string, version string")
    assert [r["version"] for r in readers.latest(df, "version").collect()] == ["10"]
    assert sorted(r["version"] for r in readers.latest(df, "version", ["k"]).collect()) == ["10", "2"]
    assert {r["k"]: r["version"] for r in readers.newest_entry(df, "version", ["k"]).collect()} == {"a": "10", "b": "2"}


def test_reconstructed_reference(spark):
    stats = {"Age": {"mean": 30.0, "std": 2.0}, "Fare": {"mean": 5.0}, "note": "x", "Odd": {"std": 1.0}}
    df = readers.reconstruct_reference(spark, stats, 500, label="Survived")
    assert df.columns == ["Age", "Fare", "Survived"] and df.count() == 500
    row = df.agg(F.avg("Age"), F.stddev("Fare"), F.avg("Survived")).first()
    assert abs(row[0] - 30) < 0.5 and abs(row[1] - 1) < 0.2 and abs(row[2] - 0.38) < 0.1
    assert math.isclose(df.agg(F.avg("Age")).first()[0], row[0])


def test_search_and_surrogate_queries_run_the_whole_job(spark, sf, monkeypatch):
    from scorewright.catalog import evaluation, plugins

    asked = []
    real, surrogate = ML.search, SG.local_surrogate

    def search(*args, n_trials=50, fit_one=None, **kw):
        asked.append(n_trials)
        fixed = lambda rows, t: ML.LogisticModel(tuple(args[2]), (t.C,) * len(args[2]), 0.0)
        return real(*args, n_trials=n_trials, fit_one=fixed, **kw)

    def local(*args, n_samples=SG.SAMPLES, **kw):
        asked.append(n_samples)
        return surrogate(args[0].limit(3), *args[1:], n_samples=n_samples, **kw)

    monkeypatch.setattr(ML, "search", search)
    monkeypatch.setattr(SG, "local_surrogate", local)
    for name in (evaluation.hyperparam_search, plugins.objective):
        assert sorted(r["number"] for r in name(spark, sf).select("number").collect()) == list(range(50))
    for name in (evaluation.local_surrogate, plugins.predict_fn):
        assert name(spark, sf).count() == 6
    assert asked == [50, 50, 5000, 5000]


def test_objective_reads_the_class_means_once_for_all_trials(spark, sf, monkeypatch):
    from scorewright.catalog import plugins

    class Counted:
        def __init__(self, df):
            self.df, self.calls = df, 0

        def groupBy(self, *names):
            self.calls += 1
            return self.df.groupBy(*names)

    def search(train, valid, features, label, fit_one):
        counted = Counted(train)
        fits = [fit_one(counted, t) for t in plugins.ML.draw_trials(3)]
        return counted.calls, fits

    monkeypatch.setattr(plugins.ML, "search", search)
    calls, fits = plugins.objective(spark, sf)
    assert calls == 1 and len({f.weights for f in fits}) == 3
