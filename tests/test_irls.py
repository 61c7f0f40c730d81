"""Fits by passes over the rows: optimal, the same alone and together, few jobs, odd rows refused."""

import numpy as np
import pytest

from scorewright.operators import irls, model as ML

FEATURES = ["a", "b", "c"]


def made(spark, n=600, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (x @ [1.0, -2.0, 0.0] + rng.logistic(size=n) > 0.8).astype(float)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, _y double")


@pytest.fixture(scope="module")
def data(spark):
    x, y, frame = made(spark)
    return x, y, frame.repartition(6).cache()


SETTINGS = [irls.Setting(C, p, b) for C in (0.01, 1.0, 10.0) for p in ("l1", "l2", None) for b in (True, False)]


def test_all_settings_reach_their_optimum_in_few_passes(data):
    x, y, frame = data
    fitted, passes = irls.fit_many(frame, FEATURES, SETTINGS)
    assert passes <= 10
    full, n = np.column_stack([np.ones(len(x)), x]), len(y)
    for s, w in zip(SETTINGS, fitted):
        weight = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum()))) if s.balanced else np.ones(n)
        gradient = full.T @ (weight * (1 / (1 + np.exp(-full @ w)) - y))
        assert np.abs(irls.optimality(s, w, gradient)).max() < 1e-6
    assert any((w[1:] == 0).any() for s, w in zip(SETTINGS, fitted) if s.penalty == "l1")


def test_together_as_alone(data, monkeypatch):
    together, _ = irls.fit_many(data[2], FEATURES, SETTINGS[:4])
    monkeypatch.setattr(irls, "SUMS_AT_ONCE", 1)
    alone, _ = irls.fit_many(data[2], FEATURES, SETTINGS[:4])
    assert np.abs(together - alone).max() < 1e-8


def test_sums_are_those_of_the_rows(data):
    x, y, frame = data
    at, weights = np.array([[0.1, 0.5, -0.3, 0.2], [0.0, 0.0, 0.0, 0.0]]), np.array([[1.0, 2.0], [0.5, 1.0]])
    got, full = irls.loss_sums(frame, FEATURES, at, weights), np.column_stack([np.ones(len(x)), x])
    for k in range(2):
        p, w = 1 / (1 + np.exp(-full @ at[k])), weights[k][y.astype(int)]
        assert np.allclose(got.gradient[k], full.T @ (w * (p - y)))
        assert np.allclose(got.gram[k], (full * (w * p * (1 - p))[:, None]).T @ full)
        assert np.isclose(got.loss[k], -(w * np.log(np.where(y == 1, p, 1 - p))).sum())


def test_a_fit_takes_fewer_than_twenty_jobs(spark, data):
    sc = spark.sparkContext
    sc.setJobGroup("irls", "fit")
    try:
        ML.fit_logreg(data[2].withColumnRenamed("_y", "y"), FEATURES, "y")
        assert len(sc.statusTracker().getJobIdsForGroup("irls")) < 20
    finally:
        sc._jsc.clearJobGroup()


def test_search_scores_equal_single_fits(spark, data):
    frame = data[2].withColumnRenamed("_y", "y")
    together = {r["number"]: r for r in ML.search(frame, frame, FEATURES, "y", n_trials=5).collect()}
    one = lambda rows, t: ML.fit_logreg(rows, FEATURES, "y", t.C, t.penalty, t.class_weight == "balanced", t.max_iter)
    alone = {r["number"]: r for r in ML.search(frame, frame, FEATURES, "y", n_trials=5, fit_one=one).collect()}
    for k in range(5):
        assert together[k]["val_roc_auc"] == pytest.approx(alone[k]["val_roc_auc"], abs=1e-9)
        assert together[k]["val_f1_score"] == pytest.approx(alone[k]["val_f1_score"], abs=1e-9)


def test_odd_rows(spark):
    schema = "a double, b double, c double, y double"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert ML.fit_logreg(frame([]), FEATURES, "y").weights == (0.0, 0.0, 0.0)
    with pytest.raises(ValueError, match="0 or 1"):
        ML.fit_logreg(frame([(1.0, 1.0, 1.0, 2.0)]), FEATURES, "y")
    with pytest.raises(ValueError, match="impute"):
        ML.fit_logreg(frame([(None, 1.0, 1.0, 1.0)]), FEATURES, "y")
    with pytest.raises(ValueError, match="not known"):
        irls.Setting(penalty="l3")
    # Null labels are left out; constant and copied features have a least-norm solution.
    rows = [(float(i), float(i), 5.0, float(i % 3 == 0)) for i in range(30)] + [(1.0, 1.0, 5.0, None)]
    model = ML.fit_logreg(frame(rows), FEATURES, "y", penalty=None, balanced=False)
    assert model.weights[0] == pytest.approx(model.weights[1]) and all(np.isfinite(model.weights))
    # One class alone, and classes that a line parts: still finite.
    assert all(np.isfinite(ML.fit_logreg(frame([(1.0, 2.0, 3.0, 1.0)] * 5), FEATURES, "y").weights))
    parted = [(float(i), 0.0, 0.0, float(i > 5)) for i in range(12)]
    assert all(np.isfinite(ML.fit_logreg(frame(parted), FEATURES, "y", penalty=None, max_iter=50).weights))
