"""One monitoring run: data, concept and prediction drift, summary, severity, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from scorewright.operators import drift as R
from scorewright.operators.feedback import label_join, matched
from scorewright.operators.metrics import metrics


@dataclass
class MonitoringRun:
    features: DataFrame
    data: DataFrame
    concept: DataFrame
    prediction: DataFrame
    analysis: DataFrame


def monitor(
    ref: DataFrame,
    cur: DataFrame,
    labels: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    key: str,
    id_col: str,
    label: str,
    arrival: Sequence[str],
    pred: str = "prediction",
    keys: Sequence[str] = (),
    alpha: float = R.ALPHA,
    share: float = R.DRIFT_SHARE,
    baseline_accuracy: float = R.BASELINE_ACCURACY,
    baseline_rate: float = R.BASELINE_POSITIVE_RATE,
    min_coverage: float = 0.0,
) -> MonitoringRun:
    features, data = R.drift(ref, cur, numeric, categorical, keys, alpha, share)
    joined = label_join(cur, labels, key, id_col, label, arrival)
    labelled = matched(joined, min_coverage, keys)
    concept = R.concept_drift(metrics(labelled, "actual_label", pred, None, keys), baseline_accuracy, keys=keys)
    prediction = R.prediction_drift(cur, pred, baseline_rate, keys=keys)
    analysis = R.grade(R.monitoring_summary(data, concept, prediction, keys))
    return MonitoringRun(features, data, concept, prediction, analysis)
