import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewright.functions.stats import chi2_p_value, erfc, ks_p_value
from scorewright.operators import metrics as M


def frame(spark, y, pred, p=None):
    p = p or [float(v) for v in pred]
    return spark.createDataFrame(list(zip(y, pred, p)), "y int, pred int, p double")


def test_small_example(spark):
    df = frame(spark, [0, 1, 1, 0, 1], [0, 1, 0, 0, 1], [0.2, 0.8, 0.3, 0.1, 0.9])
    m = M.metrics(df, "y", "pred", "p").first()
    assert (m["accuracy"], m["precision"], m["roc_auc"]) == (0.8, 1.0, 1.0)
    assert m["recall"] == pytest.approx(2 / 3) and m["f1_score"] == pytest.approx(0.8)
    assert (m["tn"], m["fp"], m["fn"], m["tp"], m["support"]) == (2, 0, 1, 2, 5)


def test_balanced_example(spark):
    df = frame(spark, [0, 1, 1, 0, 1, 1, 0, 0], [0, 1, 0, 0, 1, 1, 0, 1])
    m = M.metrics(df, "y", "pred").first()
    assert [m[k] for k in ("accuracy", "precision", "recall", "f1_score")] == [0.75] * 4


def test_zero_division_and_one_class(spark):
    m = M.metrics(frame(spark, [0, 0], [0, 0], [0.1, 0.2]), "y", "pred", "p").first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1_score"], m["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, None)
    empty = M.metrics(frame(spark, [0], [0]).where("y > 5"), "y", "pred", "p").first()
    assert (empty["accuracy"], empty["support"], empty["roc_auc"]) == (0.0, 0, None)


def test_unlabelled_rows_do_not_count(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1), (None, 1, 0.5), (1, 1, None)], "y int, pred int, p double")
    m = M.metrics(df, "y", "pred", "p").first()
    assert m["support"] == 3 and m["roc_auc"] == 1.0
    assert M.roc(df, "y", "p").where("threshold = 0.5").count() == 0


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])


@pytest.mark.parametrize("levels", [3, 10_000])
def test_auc_under_ties(spark, levels):
    rng = np.random.default_rng(levels)
    y, p = rng.integers(0, 2, 400), rng.integers(0, levels, 400) / levels
    df = frame(spark, y.tolist(), (p > 0.5).astype(int).tolist(), p.tolist())
    want = brute_auc(y, p)
    assert M.roc_auc(df, "y", "p").first()[0] == pytest.approx(want)
    assert M.auc_trapezoid(df, "y", "p").first()[0] == pytest.approx(want)
    for drop in (True, False):
        pts = M.roc(df, "y", "p", drop_collinear=drop).orderBy(F.desc("threshold")).collect()
        assert (pts[0]["fpr"], pts[0]["tpr"]) == (0.0, 0.0) and math.isinf(pts[0]["threshold"])
        assert (pts[-1]["fpr"], pts[-1]["tpr"]) == (1.0, 1.0)
        area = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(pts, pts[1:]))
        assert area == pytest.approx(want)


def test_collinear_points_drop_out(spark):
    df = frame(spark, [1, 1, 1, 1, 0, 0], [1] * 6, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4])
    kept = sorted(r["threshold"] for r in M.roc(df, "y", "p").collect())
    assert kept == [0.4, 0.6, 0.9, math.inf]


def test_report(spark):
    df = frame(spark, [0, 1, 1, 0, 1], [0, 1, 0, 0, 1])
    rows = {r["class"]: r for r in M.classification_report(df, "y", "pred").collect()}
    assert rows["0"]["precision"] == pytest.approx(2 / 3) and rows["0"]["support"] == 2
    assert rows["1"]["recall"] == pytest.approx(2 / 3) and rows["accuracy"]["precision"] == 0.8
    assert rows["weighted avg"]["recall"] == pytest.approx(0.8) and rows["macro avg"]["support"] == 5


def promoted(spark, challenger, champion):
    df = spark.createDataFrame([("t", challenger, champion)], "t string, challenger_roc_auc double, champion_roc_auc double")
    return M.promote(df).first()


def test_promotion(spark):
    assert promoted(spark, 0.75, 0.5)["challenger_wins"]
    exact = promoted(spark, 0.52, 0.5)
    assert exact["challenger_wins"] == (0.52 - 0.5 >= 0.02)
    lost = promoted(spark, 0.51, 0.5)
    assert not lost["challenger_wins"] and lost["recommendation"] == "KEEP existing champion"
    assert lost["promotion_reason"] == "Challenger did NOT improve by threshold (0.0100 < 0.02)"
    first = promoted(spark, 0.4, None)
    assert first["challenger_wins"] and first["is_first_model"] and first["roc_auc_improvement"] is None


CHI2 = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (9.487729036781154, 4, 0.05),
        (11.070497693516351, 5, 0.05), (14.067140449340169, 7, 0.05), (18.307038053275146, 10, 0.05), (124.34211340400407, 100, 0.05),
        (123.22522145336181, 99, 0.05), (0.0, 3, 1.0), (6.634896601021213, 1, 0.01), (30.0, 1, 4.320463e-08)]


@pytest.mark.parametrize("x,dof,p", CHI2)
def test_chi2_tail(spark, x, dof, p):
    df = spark.createDataFrame([(x, dof)], "x double, d int")
    assert df.select(chi2_p_value("x", "d")).first()[0] == pytest.approx(p, rel=1e-6)


@pytest.mark.parametrize("x", [0.0, 0.1, 0.5, 1.0, 2.0, 2.9, 3.1, 5.0])
def test_erfc(spark, x):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(erfc(F.col("x"))).first()[0] == pytest.approx(math.erfc(x), rel=1e-7, abs=1e-14)


def test_ks_p(spark):
    df = spark.createDataFrame([(0.0, 100, 100), (1.0, 100, 100), (0.1358, 200, 200)], "d double, n long, m long")
    p = [r[0] for r in df.select(ks_p_value("d", "n", "m")).collect()]
    assert p[0] == 1.0 and p[1] == pytest.approx(0.0, abs=1e-40) and p[2] == pytest.approx(0.0501, abs=5e-4)


@pytest.mark.parametrize("dof", [1002, 2000, 20_000])
def test_chi2_tail_of_many_degrees_matches_its_series(spark, dof):
    points = [dof + z * math.sqrt(2 * dof) for z in (-4, -1, -0.01, 0, 0.01, 0.5, 1, 2, 4, 8)]
    df = spark.createDataFrame([(x, dof) for x in points], "x double, d long")
    for (x, _), (p,) in zip(df.collect(), df.select(chi2_p_value("x", "d")).collect()):
        half = x / 2
        want = math.fsum(math.exp(j * math.log(half) - half - math.lgamma(j + 1)) for j in range(dof // 2))
        assert p == pytest.approx(want, rel=1e-5, abs=1e-7)


def test_chi2_tail_of_billions_of_degrees(spark):
    df = spark.createDataFrame([(4e9, 4_000_000_000), (4e9 + 1.8e5, 4_000_000_000)], "x double, d long")
    middle, far = [r[0] for r in df.select(chi2_p_value("x", "d")).collect()]
    assert middle == pytest.approx(0.5, abs=1e-4) and far == pytest.approx(0.02209, abs=1e-3)
