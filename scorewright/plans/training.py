"""Validate, split, fit state and model, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from scorewright.operators import features as X
from scorewright.operators import splits
from scorewright.operators.metrics import metrics
from scorewright.operators.model import LogisticModel, coefficients, fit_logreg, score
from scorewright.operators.validation import Schema, validate


@dataclass
class Training:
    state: X.FeatureState
    model: LogisticModel
    metrics: DataFrame
    importance: DataFrame
    scored: DataFrame


def train(
    df: DataFrame,
    spec: X.FeatureSpec,
    label: str,
    key: Sequence[str],
    schema: Schema | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    fit_on: str = "train",
    **fit_options,
) -> Training:
    """``fit_on='all'`` fits the feature state before the split, as a parity switch."""
    if schema is not None:
        validate(df, schema, key, raise_on_error=True)
    parts = splits.split(df, key, test_size, seed, [label])
    state = X.fit(parts if fit_on == "all" else parts.where("split = 'train'"), spec)
    ready = X.apply(parts, spec, state, keep=[*key, label, "split"])
    model = fit_logreg(ready.where("split = 'train'"), spec.select, label, **fit_options)
    scored = score(ready, model)
    report = metrics(scored, label, "prediction", "survival_probability", ["split"])
    return Training(state, model, report, coefficients(model, df.sparkSession), scored)
