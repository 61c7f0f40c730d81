"""Logistic regression by iteratively reweighted least squares, many models in one pass.

An iteration reads the rows once, whatever the number of models: their coefficients are the columns of
one matrix, every task sums gradients, Gram matrices and losses of its Arrow batches by matrix products, and
only these sums (a few numbers for each model and pair of features) leave the tasks. The small
systems are then solved on the driver: directly with a squared penalty, by coordinate descent on the
Gram matrix with an absolute one. A step that does not lower the objective is halved and tried anew.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Sums that one pass may hold (of all models together); more models take several groups.
SUMS_AT_ONCE = 2_000_000
#: How often a step that raises the objective is halved before it is taken as it is.
HALVINGS = 30


@dataclass(frozen=True)
class Setting:
    """One model: minimise penalty(w) + C * weighted loss, the intercept free. ``tol`` bounds the largest
    component of the gradient, as a share of the total weight of the rows."""

    C: float = 1.0
    penalty: str | None = "l2"
    balanced: bool = True
    max_iter: int = 100
    tol: float = 1e-9

    def __post_init__(self):
        if self.penalty not in ("l1", "l2", None):
            raise ValueError(f"penalty {self.penalty!r} is not known")


@dataclass
class Sums:
    """Per model: gradient of the loss (models x columns), its Gram matrix, and the loss."""

    gradient: np.ndarray
    gram: np.ndarray
    loss: np.ndarray


def training_rows(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The features as doubles and ``_y`` as 0.0 or 1.0; rows without a label are not learned from."""
    return df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("_y"))


def class_counts(rows: DataFrame, features: Sequence[str]) -> tuple[int, int]:
    """Rows of class 0 and 1. Other labels and missing features are refused: one row comes to the driver."""
    gap = F.lit(False)
    for c in features:
        gap = gap | F.col(c).isNull() | F.isnan(c)
    got = rows.agg(
        F.count_if(F.col("_y") == 0).alias("zeros"), F.count_if(F.col("_y") == 1).alias("ones"),
        F.count(F.lit(1)).alias("n"), F.count_if(gap).alias("gaps"),
    ).first()
    if got["zeros"] + got["ones"] < got["n"]:
        raise ValueError("labels must be 0 or 1")
    if got["gaps"]:
        raise ValueError(f"{got['gaps']} rows lack a feature: impute them first")
    return got["zeros"], got["ones"]


def loss_sums(rows: DataFrame, features: Sequence[str], coefficients: np.ndarray, weights: np.ndarray) -> Sums:
    """One pass over ``training_rows``: sums at ``coefficients`` (models x (1 + features), intercept first) with
    the class weights ``weights`` (models x 2)."""
    models, width = coefficients.shape
    left, right = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.ones(batch.num_rows), *(batch.column(c).to_numpy() for c in features)])
            y = batch.column("_y").to_numpy()
            margin = x @ coefficients.T
            weight = weights[:, y.astype(int)].T
            p = np.exp(-np.logaddexp(0.0, -margin))
            part = np.concatenate(
                [
                    ((weight * (p - y[:, None])).T @ x).ravel(),
                    ((weight * p * (1.0 - p)).T @ (x[:, left] * x[:, right])).ravel(),
                    (weight * (np.logaddexp(0.0, margin) - y[:, None] * margin)).sum(axis=0),
                ]
            )
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(total)], total)], names=["sums"])

    parts = rows.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("k", "v"))
    flat = np.zeros(models * (width + len(left) + 1))
    for r in parts.groupBy("k").agg(F.sum("v").alias("v")).collect():
        flat[r["k"]] = r["v"]
    gradient, packed, loss = np.split(flat, [models * width, models * (width + len(left))])
    gram = np.zeros((models, width, width))
    gram[:, left, right] = gram[:, right, left] = packed.reshape(models, len(left))
    return Sums(gradient.reshape(models, width), gram, loss)


def shrink(x: float, by: float) -> float:
    return np.sign(x) * (abs(x) - by) if abs(x) > by else 0.0


def coordinate_descent(gram: np.ndarray, gradient: np.ndarray, at: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Minimiser of the quadratic model around ``at`` plus the absolute values of all but the intercept."""
    new, change = at.copy(), np.zeros_like(at)
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(at)):
            if gram[j, j] <= 0:
                continue
            slope = gradient[j] + gram[j] @ change - gram[j, j] * change[j]
            goal = at[j] - slope / gram[j, j]
            value = goal if j == 0 else shrink(goal, 1.0 / gram[j, j])
            moved = max(moved, abs(value - new[j]) * np.sqrt(gram[j, j]))
            new[j], change[j] = value, value - at[j]
        if moved < 1e-12 * (1.0 + np.sqrt(np.abs(np.diag(gram))).max()):
            break
    return new


def optimality(setting: Setting, at: np.ndarray, gradient: np.ndarray) -> np.ndarray:
    """Smallest subgradient of the penalised objective for each coefficient: zero at the solution."""
    slope = setting.C * gradient
    if setting.penalty == "l2":
        return slope + np.concatenate([[0.0], at[1:]])
    if setting.penalty == "l1":
        inner = np.array([shrink(s, 1.0) for s in slope])
        out = np.where(at != 0, slope + np.sign(at), inner)
        out[0] = slope[0]
        return out
    return slope


def _penalty(setting: Setting, at: np.ndarray) -> float:
    w = at[1:]
    return {"l2": 0.5 * float(w @ w), "l1": float(np.abs(w).sum()), None: 0.0}[setting.penalty]


def _step(setting: Setting, at: np.ndarray, gradient: np.ndarray, gram: np.ndarray) -> np.ndarray:
    if setting.penalty == "l1":
        return coordinate_descent(setting.C * gram, setting.C * gradient, at)
    full = setting.C * gram
    if setting.penalty == "l2":
        full = full + np.diag([0.0] + [1.0] * (len(at) - 1))
    # The least-norm step where features are constant or copies of each other.
    return at - np.linalg.lstsq(full, optimality(setting, at, gradient), rcond=1e-12)[0]


def fit_many(rows: DataFrame, features: Sequence[str], settings: Sequence[Setting]) -> tuple[np.ndarray, int]:
    """Coefficients (models x (1 + features), intercept first) of all settings, and how many passes it took.

    ``rows`` are ``training_rows``, read once in each pass: stage them before if they are dear. An
    iteration of all models counts as one, the largest max_iter holds. Without rows, or with a single
    class, the balanced weights of the missing class are 0.
    """
    features, width = list(features), len(features) + 1
    zeros, ones = class_counts(rows, features)
    n = zeros + ones
    each = np.array([n / (2.0 * c) if c else 0.0 for c in (zeros, ones)])
    weights = np.array([each if s.balanced else [1.0, 1.0] for s in settings]).reshape(len(settings), 2)
    at = np.zeros((len(settings), width))
    if not n:
        return at, 0
    group = max(1, SUMS_AT_ONCE // (width * (width + 3) // 2))
    passes = 0
    for first in range(0, len(settings), group):
        chosen = range(first, min(first + group, len(settings)))
        passes += _fit_group(rows, features, [settings[k] for k in chosen], at[first : first + group], weights[first : first + group], n)
    return at, passes


def _fit_group(rows, features, settings, at, weights, n) -> int:
    """Fits in place; only models that have not converged are in a pass."""
    best = np.full(len(settings), np.inf)
    trial, halved = at.copy(), np.zeros(len(settings), int)
    todo, passes = list(range(len(settings))), 0
    while todo and passes < max(settings[k].max_iter for k in todo):
        sums = loss_sums(rows, features, trial[todo], weights[todo])
        passes += 1
        going = []
        for i, k in enumerate(todo):
            s = settings[k]
            value = s.C * sums.loss[i] + _penalty(s, trial[k])
            if value > best[k] + 1e-12 * abs(best[k]) and halved[k] < HALVINGS:
                trial[k] = (trial[k] + at[k]) / 2.0
                halved[k] += 1
                going.append(k)
                continue
            at[k], best[k], halved[k] = trial[k], value, 0
            scale = max(1.0, s.C * n)
            if np.abs(optimality(s, at[k], sums.gradient[i])).max() <= s.tol * scale:
                continue
            trial[k] = _step(s, at[k], sums.gradient[i], sums.gram[i])
            if np.abs(trial[k] - at[k]).max() > 1e-13 * (1.0 + np.abs(at[k]).max()):
                going.append(k)
        todo = going
    return passes
