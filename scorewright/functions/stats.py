"""Metric and test formulas as Columns over already aggregated counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from scorewright.functions.columns import col

KS_TERMS = 100
# Above it the chi-square tail comes from an expansion whose cost does not grow.
CHI2_SERIES_DOF = 1000


def ratio(a: str | Column, b: str | Column, empty: float | None = 0.0) -> Column:
    """a / b as double, ``empty`` when b is 0."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b)), F.lit(empty).cast("double"))


def confusion_counts(y: str | Column, pred: str | Column) -> dict[str, Column]:
    """Aggregate expressions tn, fp, fn, tp (user-facing metric UDAFs, all built-in)."""
    y, pred = col(y), col(pred)
    return {
        "tn": F.count_if((y == 0) & (pred == 0)),
        "fp": F.count_if((y == 0) & (pred == 1)),
        "fn": F.count_if((y == 1) & (pred == 0)),
        "tp": F.count_if((y == 1) & (pred == 1)),
    }


def metric_columns(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, Column]:
    """accuracy, precision, recall, f1_score with zero division giving 0."""
    tn, fp, fn, tp = map(col, (tn, fp, fn, tp))
    return {
        "accuracy": ratio(tn + tp, tn + fp + fn + tp),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1_score": ratio(2 * tp, 2 * tp + fp + fn),
    }


def ks_p_value(d: str | Column, n: str | Column, m: str | Column, terms: int = KS_TERMS) -> Column:
    """Smirnov's asymptotic two-sample p-value."""
    n, m = col(n).cast("double"), col(m).cast("double")
    lam = col(d) * F.sqrt(n * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    return F.when(lam < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def chi2_p_value(x: str | Column, dof: str | Column) -> Column:
    """Upper tail of the chi-square distribution: its finite series for up to CHI2_SERIES_DOF degrees of
    freedom, above that the uniform expansion in their number (error below 1e-7)."""
    x, every = col(x).cast("double"), col(dof).cast("long")
    dof = F.least(every, F.lit(CHI2_SERIES_DOF)).cast("int")
    half = x / 2
    # j-th terms are built from the previous one, so long series cannot overflow; the
    # exponential is applied in log space.
    def series(start: int, stop: Column, first: Column, step) -> Column:
        walk = F.aggregate(
            F.sequence(F.lit(start), F.greatest(stop, F.lit(start))),
            F.struct(first.alias("log_term"), F.lit(0.0).alias("total")),
            lambda acc, j: F.struct(
                (acc["log_term"] + step(j)).alias("log_term"),
                (
                    acc["total"]
                    + F.when(j <= stop, F.exp(acc["log_term"] + step(j) - half)).otherwise(0.0)
                ).alias("total"),
            ),
        )
        return walk["total"]

    even = series(
        0,
        (dof / 2).cast("int") - 1,
        F.lit(0.0),
        lambda j: F.when(j == 0, 0.0).otherwise(F.log(half) - F.log(j.cast("double"))),
    )
    odd_tail = series(
        0,
        ((dof - 3) / 2).cast("int"),
        F.lit(0.0),
        lambda j: F.when(j == 0, 0.0).otherwise(F.log(x) - F.log(2 * j.cast("double") + 1)),
    )
    odd = erfc(F.sqrt(half)) + F.when(
        dof >= 3, F.sqrt(2 * x / F.lit(math.pi)) * odd_tail
    ).otherwise(0.0)
    return (
        F.when((dof < 1) | (x <= 0), 1.0)
        .when(every > CHI2_SERIES_DOF, _gamma_tail(every / F.lit(2.0), half))
        .when(dof % 2 == 0, F.least(F.lit(1.0), even))
        .otherwise(F.least(F.lit(1.0), odd))
    )


def _gamma_tail(a: Column, x: Column) -> Column:
    """Regularised upper incomplete gamma function for large ``a`` (uniform asymptotic expansion)."""
    mu = x / a - 1
    eta = F.signum(mu) * F.sqrt(F.greatest(F.lit(0.0), 2 * (mu - F.log1p(mu))))
    # the closed forms cancel near 0, where their power series take over
    near = F.abs(eta) < 0.05
    c0 = F.when(near, -1 / 3 + eta * (1 / 12 + eta * (-2 / 135 + eta / 864))).otherwise(F.try_divide(F.lit(1.0), mu) - F.try_divide(F.lit(1.0), eta))
    c1 = F.when(near, -1 / 540 - eta / 288).otherwise(
        F.try_divide(F.lit(1.0), eta**3) - F.try_divide(F.lit(1.0), mu**3) - F.try_divide(F.lit(1.0), mu**2) - F.try_divide(F.lit(1.0), 12 * mu)
    )
    z = F.abs(eta) * F.sqrt(a / 2)
    half = erfc(z) / 2
    rest = F.exp(-z * z) / F.sqrt(F.lit(2 * math.pi) * a) * (c0 + c1 / a)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(eta >= 0, half).otherwise(1 - half) + rest))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0: power series below 3, continued fraction above.

    Evaluated only on aggregated rows (one per feature and group).
    """
    small = F.aggregate(
        F.sequence(F.lit(1), F.lit(90)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda acc, k: F.struct(
            (-acc["term"] * x * x / k).alias("term"),
            (acc["total"] - acc["term"] * x * x / k / (2 * k + 1)).alias("total"),
        ),
    )["total"]
    tail = F.aggregate(
        F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, k: (k / 2.0) / (x + acc)
    )
    large = F.exp(-x * x) / (x + tail) / F.lit(math.sqrt(math.pi))
    return F.when(x < 3, 1 - F.lit(2.0 / math.sqrt(math.pi)) * small).otherwise(large)
