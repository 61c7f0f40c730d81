"""Batch scoring of tables, file lists and logged requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewright.functions.columns import scored_line
from scorewright.operators import features as X
from scorewright.operators.model import LogisticModel, score
from scorewright.operators.profile import batch_rate
from scorewright.operators.validation import RequestField, Schema, normalize_requests, quarantine
from scorewright.sources.readers import read_csv


def score_table(
    df: DataFrame,
    spec: X.FeatureSpec,
    state: X.FeatureState,
    model: LogisticModel,
    keep: Sequence[str],
    impute_from: str = "state",
) -> DataFrame:
    """``impute_from='batch'`` re-fits medians and modes on the scored rows (parity switch)."""
    if impute_from == "batch":
        medians, most = X.fit_impute(df, spec.median, spec.mode)
        state = X.FeatureState(
            {**state.medians, **medians}, {**state.modes, **most}, state.vocab, state.means, state.stds
        )
    return score(X.apply(df, spec, state, keep), model)


def score_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, model: LogisticModel, key: str
) -> tuple[DataFrame, DataFrame]:
    """(scored lines tagged with their file, error lines); a bad row never stops the run."""
    good, bad = read_csv(spark, paths, schema)
    scored = score(good, model)
    line = scored_line(key, "prediction", "survival_probability", "prediction_label")
    errors = bad.select(
        F.concat(F.lit("ERROR: "), F.col("source_file"), F.lit(" - "), F.col("line")).alias("line"),
        "source_file",
    )
    return scored.select(line.alias("line"), "source_file"), errors


def score_requests(
    df: DataFrame,
    fields: Sequence[RequestField],
    schema: Schema,
    model: LogisticModel,
    batch: Sequence[str],
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored rows, quarantined rows, per-batch summary). A row's answer does not depend on
    the rest of its batch, and rejected rows are not counted as negatives."""
    good, bad = quarantine(normalize_requests(df, fields), schema)
    scored = score(good, model)
    return scored, bad, batch_rate(scored, batch)
