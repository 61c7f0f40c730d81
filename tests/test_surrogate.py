"""Local surrogates: bins and draws of the background, the fit against brute force, odd rows."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.functions.columns import key_text
from scorewright.operators import surrogate as SG


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    rows = [(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(zip(rng.normal(2, 3, 400), rng.exponential(1, 400)))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(4).cache()


def test_background_is_that_of_the_quartiles(table):
    got = SG.fit_background(table, ["a", "b", "c"])
    rows = np.array([[r["a"], r["b"], r["c"]] for r in table.collect()])
    for j in range(2):
        edges = np.percentile(rows[:, j], [25, 50, 75])
        assert np.allclose(got.edges[j], edges)
        bins = np.searchsorted(edges, rows[:, j])
        for b in range(4):
            own = rows[bins == b, j]
            assert got.shares[j][b] == pytest.approx(len(own) / 400) and got.means[j][b] == pytest.approx(own.mean())
            assert got.stds[j][b] == pytest.approx(own.std(), abs=1e-9)
        assert got.lows[j] == pytest.approx((rows[:, j].min(), *edges)) and got.highs[j] == pytest.approx((*edges, rows[:, j].max()))
    assert got.edges[2] == (1.0,) and got.shares[2] == (1.0, 0.0)  # a constant


def test_draws_follow_the_background(table):
    known = SG.fit_background(table, ["a", "b"])
    values, same = SG.draw(known, 77, [0.5, 0.2], 40_000)
    again, other = SG.draw(known, 77, [0.5, 0.2], 40_000)[0], SG.draw(known, 78, [0.5, 0.2], 40_000)[0]
    assert (values == again).all() and (values[1:] != other[1:]).mean() > 0.99
    assert values[0].tolist() == [0.5, 0.2] and same[0].all()
    for j in range(2):
        bins = np.searchsorted(known.edges[j], values[1:, j])
        assert np.allclose(np.bincount(bins, minlength=4) / 39_999, known.shares[j], atol=0.01)
        assert (same[1:, j] == (bins == SG.own_bin(known, j, [0.5, 0.2][j]))).mean() > 0.999
        for b in range(4):
            own = values[1:, j][bins == b]
            assert known.lows[j][b] <= own.min() and own.max() <= known.highs[j][b]
            # mean of the truncated normal
            m, s = known.means[j][b], known.stds[j][b]
            lo, hi = ((known.lows[j][b] - m) / s, (known.highs[j][b] - m) / s)
            density = lambda z: math.exp(-z * z / 2) / math.sqrt(2 * math.pi)
            want = m + s * (density(lo) - density(hi)) / (SG._cdf(hi) - SG._cdf(lo))
            assert own.mean() == pytest.approx(want, abs=0.03 * s + 1e-3)
    corr = np.corrcoef(values[1:].T)[0, 1]
    assert abs(corr) < 0.03


def brute_solve(same, p, top):
    """Weighted ridge by its definition, features chosen over all orders of adding."""
    x, d = same.astype(float), same.shape[1]
    distance = np.sqrt(((x - 1.0) ** 2).sum(axis=1))
    w = np.sqrt(np.exp(-(distance**2) / (SG.KERNEL_FACTOR * math.sqrt(d)) ** 2))

    def ridge(chosen, alpha):
        z = np.column_stack([np.ones(len(x)), x[:, chosen]])
        penalty = alpha * np.diag([0.0] + [1.0] * len(chosen))
        beta = np.linalg.lstsq((z * w[:, None]).T @ z + penalty, (z * w[:, None]).T @ p, rcond=None)[0]
        mean = (w @ p) / w.sum()
        return beta, 1 - (w @ (p - z @ beta) ** 2) / (w @ (p - mean) ** 2)

    if min(top, d) <= SG.FORWARD:
        chosen = []
        while len(chosen) < min(top, d):
            chosen.append(max((j for j in range(d) if j not in chosen), key=lambda j: ridge([*chosen, j], 0.0)[1]))
    else:
        first = ridge(list(range(d)), SG.CHOICE_RIDGE)[0][1:]
        chosen = sorted(range(d), key=lambda j: -abs(first[j]))[:top]
    beta, share = ridge(chosen, SG.RIDGE)
    return beta[0], dict(zip(chosen, beta[1:])), share


@pytest.mark.parametrize("d,top", [(3, 2), (4, 6), (9, 8)])
def test_solution_equals_brute_force(d, top):
    rng = np.random.default_rng(d)
    same = rng.random((2000, d)) < 0.4
    same[0] = True
    p = same @ np.linspace(1, -1, d) + 0.3 * (same[:, 0] & same[:, 1]) + rng.normal(0, 0.1, 2000)
    intercept, weights, share = SG.solve(same, p, top)
    want = brute_solve(same, p, top)
    assert intercept == pytest.approx(want[0]) and share == pytest.approx(want[2])
    assert {j: w for j, w in enumerate(weights) if not np.isnan(w)} == pytest.approx(want[1])


def test_rows_of_one_key_are_explained_each(spark, table):
    rows = spark.createDataFrame([(1, 0.5, 0.2), (1, 9.0, 0.2), (2, None, 0.2), (3, float("nan"), None)], "id long, a double, b double")
    known = SG.fit_background(table, ["a", "b"])
    curve = lambda z: z["a"] * 2.0 + z["b"]
    n = 701
    got = SG.local_surrogate(rows, curve, ["a", "b"], ["id"], n_samples=n, background=known).collect()
    assert sorted(r["id"] for r in got) == [1, 1, 1, 1, 2, 2, 3, 3]
    h = rows.select(F.xxhash64(key_text(["id", 42]))).first()[0]
    for own in ((0.5, 0.2), (9.0, 0.2)):
        values, same = SG.draw(known, h, own, n)
        intercept, weights, share = SG.solve(same, values[:, 0] * 2.0 + values[:, 1], 8)
        b = SG.own_bin(known, 0, own[0])
        mine = {r["feature"]: r for r in got if r["id"] == 1 and r["intercept"] == pytest.approx(intercept)}
        assert mine["a"]["weight"] == pytest.approx(weights[0]) and mine["b"]["weight"] == pytest.approx(weights[1])
        assert (mine["a"]["low"], mine["a"]["high"]) == (known.lows[0][b], known.highs[0][b]) and mine["a"]["fit"] == pytest.approx(share)
    assert all(r["low"] is None for r in got if r["id"] in (2, 3) and r["feature"] == "a")
    assert SG.local_surrogate(rows.where("false"), curve, ["a", "b"], ["id"], background=known).count() == 0


def test_no_shuffle_around_the_rows(spark, table):
    known = SG.fit_background(table, ["a", "b"])
    out = SG.local_surrogate(table.select("id", "a", "b"), lambda z: z["a"], ["a", "b"], ["id"], background=known)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]


def test_the_feature_that_matters_has_the_weight(table):
    got = SG.local_surrogate(table.limit(5), lambda z: F.when(z["a"] > 2.0, 1.0).otherwise(0.0), ["a", "b", "c"], ["id"], background=SG.fit_background(table, ["a", "b", "c"])).collect()
    by = {(r["id"], r["feature"]): abs(r["weight"]) for r in got}
    for i, _ in itertools.groupby(sorted(k[0] for k in by)):
        assert by[i, "a"] > 0.2 and by[i, "b"] < 0.1 and by[i, "c"] < 0.1


def test_own_bins_are_those_of_the_draws_without_drawing_values(spark, table, monkeypatch):
    known = SG.fit_background(table, ["a", "b", "c"])
    for values in ([0.5, 0.2, 1.0], [None, float("nan"), 2.0]):
        assert (SG.own_bins(known, 5, values, 3000) == SG.draw(known, 5, values, 3000)[1]).all()
    at = np.random.default_rng(1).random(3000)
    q, step = SG._normal_table()
    p = (np.arange(SG.STEPS) + 0.5) / SG.STEPS
    place = np.clip(at * SG.STEPS - 0.5, 0.0, SG.STEPS - 1.0)
    k = place.astype(int)
    assert np.allclose(q[k] + (place - k) * step[k], np.interp(at, p, q), rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("d,top", [(2, 8), (3, 2), (9, 8)])
def test_blocks_of_rows_are_drawn_scored_and_solved_as_single_rows(spark, d, top):
    """Samples are scored in generated code, not by a function over an array, and rows are solved together."""
    rng = np.random.default_rng(d)
    names, n = [f"f{j}" for j in range(d)], 137  # no multiple of a stretch
    data = [[None if rng.random() < 0.1 else float(x) for x in rng.normal(1, 2, d)] for _ in range(900)]
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], ", ".join(["id long", *[f"{c} double" for c in names]])).coalesce(2)
    known = SG.fit_background(rows, names)
    curve = lambda z: F.when(z["f0"] > 1.0, z["f1"] * 0.3).otherwise(z["f1"] * z["f0"])
    out = SG.local_surrogate(rows, curve, names, ["id"], n_samples=n, top=top, background=known)
    assert "transform(_z" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in out.collect():
        got.setdefault(r["id"], {})[names.index(r["feature"])] = r
    hashes = {r[0]: r[1] for r in rows.select("id", F.xxhash64(key_text(["id", 42]))).collect()}
    assert sorted(got) == sorted(hashes)
    for i in (0, 1, 364, 365, 366, 449, 450, 730, 899):
        values, same = SG.draw(known, hashes[i], data[i], n)
        with np.errstate(invalid="ignore"):
            p = np.where(values[:, 0] > 1.0, values[:, 1] * 0.3, values[:, 1] * values[:, 0])
        intercept, weights, share = SG.solve(same, p, top)
        want = brute_solve(same[~np.isnan(p)], p[~np.isnan(p)], top)
        assert intercept == pytest.approx(want[0]) and share == pytest.approx(want[2])
        assert {j: r["weight"] for j, r in got[i].items()} == pytest.approx({j: w for j, w in enumerate(weights) if not np.isnan(w)})
        assert all(r["intercept"] == pytest.approx(intercept) and r["fit"] == pytest.approx(share) for r in got[i].values())
    nothing = SG.solve_block(np.zeros((2, 3), np.uint8), np.array([[np.nan] * 3, [0.1] * 3]), 1, 1)
    assert np.isnan(nothing[0][0]) and nothing[0][1] == pytest.approx(0.1) and nothing[2][1] == 1.0
