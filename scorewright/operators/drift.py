"""Data, prediction and concept drift, severity grading and alert rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.functions.columns import truncated_json
from scorewright.functions.stats import chi2_p_value, ks_p_value, ratio
from scorewright.operators.joins import keyed_join
from scorewright.operators.ordered import long_form, prefix_sum
from scorewright.operators.profile import positive_rate, profile_numeric

# Thresholds, grading and texts of the monitoring reports.
ALPHA = 0.05
DRIFT_SHARE = 0.5
PREDICTION_SHIFT = 0.05
BASELINE_POSITIVE_RATE = 0.38
BASELINE_ACCURACY = 0.80
ACCURACY_DROP = 0.03
RECOMMENDATIONS = {
    "CRITICAL": "Immediate retraining required. Both data and concept drift detected.",
    "HIGH": "Retraining strongly recommended. Significant drift detected.",
    "MEDIUM": "Monitor closely. Consider retraining in next sprint.",
    "LOW": "Minor data drift. No immediate action required.",
    "NONE": "No drift detected. Model is healthy.",
}
ACTION_SEVERITIES = ["CRITICAL", "HIGH"]
ALERT_SEVERITIES = ["CRITICAL", "HIGH", "MEDIUM"]
REASON_DRIFT = "Concept drift detected"
REASON_NO_LABELS = "No ground truth"
REASON_OK = "Performance within acceptable range"
RETRAIN_REASON = "Drift detected in production"

# Columns a scoring job adds; never treated as model inputs.
SCORING_COLUMNS = {
    "prediction", "survival_probability", "non_survival_probability",
    "prediction_label", "inference_timestamp",
}


def feature_columns(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Known model inputs present in ``df``, scoring output excluded."""
    return df.select(*[c for c in features if c in df.columns and c not in SCORING_COLUMNS])


def common_columns(ref: DataFrame, cur: DataFrame, features: Sequence[str]) -> list[str]:
    shared = [c for c in features if c in ref.columns and c in cur.columns]
    if not shared:
        raise ValueError("No common feature columns between reference and current datasets.")
    return shared


def paired_counts(ref, cur, columns, keys=(), cast="double", nulls=False) -> DataFrame:
    """Rows (keys, feature, value, r, c): how often each value occurs on either side."""
    keys = list(keys)
    sides = [
        long_form(side, columns, keys, cast).withColumn("side", F.lit(i))
        for i, side in enumerate((ref, cur))
    ]
    both = sides[0].unionByName(sides[1])
    if cast == "double":
        both = both.withColumn("value", F.nanvl("value", F.lit(None)))
    if not nulls:
        both = both.where("value IS NOT NULL")
    return both.groupBy(*keys, "feature", "value").agg(
        F.count_if(F.col("side") == 0).alias("r"), F.count_if(F.col("side") == 1).alias("c")
    )


def ecdf_pair(ref, cur, columns, keys=()) -> DataFrame:
    """Both empirical CDFs on the merged value axis of every feature."""
    walk = prefix_sum(
        paired_counts(ref, cur, columns, keys), ["value"], ["r", "c"], [*keys, "feature"]
    )
    return walk.withColumns(
        {
            "cdf_reference": ratio("cum_r", "total_r", None),
            "cdf_current": ratio("cum_c", "total_c", None),
        }
    )


def feature_entries(numeric: Sequence[str], categorical: Sequence[str]) -> Column:
    """Array of (feature, value, text) of a row: numbers in ``value`` (NaN is missing), categories in ``text``."""

    def entry(name, value, text):
        return F.struct(F.lit(name).alias("feature"), value.alias("value"), text.alias("text"))

    no_value, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = [entry(c, F.nanvl(F.col(c).cast("double"), no_value), no_text) for c in numeric]
    return F.array(*entries, *[entry(c, no_value, F.col(c).cast("string")) for c in categorical])


def value_counts(rows: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, feature, value, text, n): how often each value occurs, missing ones included. Counts of
    several tables add up to those of their union."""
    long = rows.select(*keys, F.inline(feature_entries(numeric, categorical)))
    return long.groupBy(*keys, "feature", "value", "text").agg(F.count(F.lit(1)).alias("n"))


def pair_counts(sides: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, side, feature, value, text, n), side 0 being the reference, to (keys, feature, value, text,
    r, c, missing_r, missing_c). Missing values have one row with r = c = 0, so that no feature vanishes."""
    there = F.col("value").isNotNull() | F.col("text").isNotNull()
    counted = sides.groupBy(*keys, "feature", "value", "text").agg(
        *[F.coalesce(F.sum(F.when(F.col("side") == i, F.col("n"))), F.lit(0)).alias(f"_{name}") for i, name in enumerate("rc")]
    )
    return counted.select(
        *keys, "feature", "value", "text",
        *[
            F.when(here, F.col(f"_{name}")).otherwise(F.lit(0)).alias(prefix + name)
            for prefix, here in (("", there), ("missing_", ~there))
            for name in "rc"
        ],
    )


def mixed_counts(ref, cur, numeric, categorical, keys=()) -> DataFrame:
    """Counts of both sides beside each other, as ``pair_counts`` gives them."""
    sides = [
        side.select(*keys, F.lit(i).alias("side"), F.lit(1).alias("n"), F.inline(feature_entries(numeric, categorical)))
        for i, side in enumerate((ref, cur))
    ]
    return pair_counts(sides[0].unionByName(sides[1]), keys)


def feature_tests(ref, cur, numeric=(), categorical=(), keys=()) -> DataFrame:
    """One row per (keys, feature). Numbers: two-sample KS, Wasserstein-1 and both means;
    categories: chi-square homogeneity on the 2 x K table. All features share one pass."""
    return count_tests(mixed_counts(ref, cur, numeric, categorical, keys), numeric, keys)


def count_tests(counts: DataFrame, numeric: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The tests of ``feature_tests`` from counts of both sides.

    A feature without a value on a side has no statistic; missing_reference and missing_current
    tell how many rows lack it."""
    walk = prefix_sum(counts, ["value", "text"], ["r", "c"], [*keys, "feature"])
    r, c = F.col("total_r").cast("double"), F.col("total_c").cast("double")
    gap = F.abs(ratio("cum_r", "total_r", None) - ratio("cum_c", "total_c", None))
    cross = F.col("r") * c - F.col("c") * r
    is_number = F.col("feature").isin(list(numeric))
    there = F.col("value").isNotNull() | F.col("text").isNotNull()
    both = (F.col("n_reference") > 0) & (F.col("n_current") > 0)
    rows = walk.groupBy(*keys, "feature").agg(
        F.max(F.when(F.col("value").isNotNull(), F.coalesce(gap, F.lit(0.0)))).alias("_ks"),
        F.sum(gap * (F.col("next.value") - F.col("value"))).alias("_area"),
        F.sum(F.try_divide(cross * cross, (F.col("r") + F.col("c")) * r * c)).alias("_chi"),
        (F.count_if(there) - 1).alias("_dof"),
        F.sum(F.col("value") * F.col("r")).alias("_sr"),
        F.sum(F.col("value") * F.col("c")).alias("_sc"),
        F.max("total_r").alias("n_reference"),
        F.max("total_c").alias("n_current"),
        F.sum("missing_r").alias("missing_reference"),
        F.sum("missing_c").alias("missing_current"),
    )
    rows = rows.withColumn("statistic", F.when(both, F.when(is_number, F.col("_ks")).otherwise(F.col("_chi"))))
    p = F.when(is_number, ks_p_value("statistic", "n_reference", "n_current")).otherwise(
        chi2_p_value("statistic", "_dof")
    )
    return rows.select(
        *keys,
        "feature",
        F.when(is_number, "ks").otherwise("chisquare").alias("stattest_name"),
        "statistic",
        F.when(~is_number, F.col("_dof")).alias("dof"),
        F.when(both, p).alias("drift_score"),
        F.when(both & is_number, F.coalesce("_area", F.lit(0.0))).alias("wasserstein"),
        ratio("_sr", "n_reference", None).alias("reference_mean"),
        ratio("_sc", "n_current", None).alias("current_mean"),
        "n_reference",
        "n_current",
        "missing_reference",
        "missing_current",
    )


def drift(
    ref: DataFrame,
    cur: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    keys: Sequence[str] = (),
    alpha: float = ALPHA,
    share: float = DRIFT_SHARE,
) -> tuple[DataFrame, DataFrame]:
    """(per-feature rows, one dataset row per group)."""
    shared = common_columns(ref, cur, [*numeric, *categorical])
    nums = [c for c in numeric if c in shared]
    cats = [c for c in categorical if c in shared]
    features = flag_features(feature_tests(ref, cur, nums, cats, keys), alpha)
    return features, dataset_drift(features, keys, share)


def flag_features(features: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Adds the flag: a small p-value, or values on one side and only missing ones on the other.

    A side without rows, or a feature missing on both sides, isn't flagged.
    """
    sides = ("reference", "current")
    gone = [(F.col(f"n_{s}") == 0) & (F.col(f"missing_{s}") > 0) & (F.col(f"n_{t}") > 0) for s, t in (sides, sides[::-1])]
    return features.withColumn("threshold", F.lit(alpha)).withColumn(
        "drift_detected", F.coalesce(F.col("drift_score") < alpha, F.lit(False)) | gone[0] | gone[1]
    )


def drift_counts(features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Drifted count, share and percentage (1 decimal, denominator at least 1)."""
    n = F.greatest(F.col("n_features_tested"), F.lit(1))
    return (
        features.groupBy(*keys)
        .agg(
            F.count_if("drift_detected").alias("n_drifted_features"),
            F.count(F.lit(1)).alias("n_features_tested"),
        )
        .withColumn("drift_share", F.col("n_drifted_features").cast("double") / n)
        .withColumn("drift_percentage", F.round(F.col("drift_share") * 100, 1))
    )


def dataset_drift(features: DataFrame, keys: Sequence[str] = (), share: float = DRIFT_SHARE) -> DataFrame:
    """Overall flag: the drifted share reaches the threshold."""
    return drift_counts(features, keys).withColumn(
        "overall_drift_detected", F.col("drift_share") >= share
    )


def mean_shift(ref, cur, columns, keys=()) -> DataFrame:
    """Reference and current mean per feature; features missing on one side stay visible."""
    keys = list(keys)

    def means(df, name):
        present = [c for c in columns if c in df.columns]
        rows = profile_numeric(df, present, keys, ())
        return rows.select(*keys, F.col("column").alias("feature"), F.col("mean").alias(name))

    joined = keyed_join(means(ref, "reference_mean"), means(cur, "current_mean"), [*keys, "feature"], "full")
    return joined.withColumn("shift", F.col("current_mean") - F.col("reference_mean"))


def baseline_join(current: DataFrame, baseline: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Current feature stats beside stored ones (one row per feature on both sides)."""
    on = [*keys, "feature"]

    def named(df, prefix):
        return df.select(*on, *[F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in on])

    return keyed_join(named(baseline, "baseline"), named(current, "current"), on, "full")


def prediction_drift(
    df: DataFrame,
    pred: str = "prediction",
    baseline: float | Column = BASELINE_POSITIVE_RATE,
    threshold: float = PREDICTION_SHIFT,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Absolute change of the positive rate; flagged strictly above the threshold."""
    base = baseline if isinstance(baseline, Column) else F.lit(float(baseline))
    return (
        df.groupBy(*keys)
        .agg(base.alias("baseline_positive_rate"), positive_rate(pred).alias("current_positive_rate"))
        .withColumn("shift", F.abs(F.col("current_positive_rate") - F.col("baseline_positive_rate")))
        .withColumn("absolute_shift", F.round("shift", 4))
        .withColumn("prediction_drift_detected", F.coalesce(F.col("shift") > threshold, F.lit(False)))
        .drop("shift")
    )


def concept_drift(
    metric_rows: DataFrame,
    baseline: float = BASELINE_ACCURACY,
    threshold: float = ACCURACY_DROP,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Accuracy drop against the baseline; rows without labels are never flagged."""
    has_labels = F.coalesce(F.col("support"), F.lit(0)) > 0
    drop = F.when(has_labels, F.lit(baseline) - F.col("accuracy"))
    hit = F.coalesce(drop > threshold, F.lit(False))
    return metric_rows.select(
        *keys,
        hit.alias("concept_drift_detected"),
        F.lit(baseline).alias("baseline_accuracy"),
        F.when(has_labels, F.col("accuracy")).alias("current_accuracy"),
        drop.alias("performance_drop"),
        F.lit(threshold).alias("threshold"),
        F.coalesce(F.col("support"), F.lit(0)).cast("long").alias("samples_evaluated"),
        F.when(hit, REASON_DRIFT).when(~has_labels, REASON_NO_LABELS).otherwise(REASON_OK).alias("reason"),
    )


def quality_compare(
    ref: DataFrame,
    cur: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Missing rate, range escapes and unseen categories: current against reference."""
    keys = list(keys)
    on = [*keys, "column"]
    parts = []
    if numeric:
        stats = [
            profile_numeric(df, numeric, keys, ()).select(
                *on, *[F.col(c).alias(f"{side}_{c}") for c in ("missing_rate", "min", "max", "mean")]
            )
            for side, df in (("reference", ref), ("current", cur))
        ]
        joined = keyed_join(stats[0], stats[1], on, "full")
        outside = (F.col("current_min") < F.col("reference_min")) | (
            F.col("current_max") > F.col("reference_max")
        )
        parts.append(
            joined.select(
                *on,
                "reference_missing_rate",
                "current_missing_rate",
                F.coalesce(outside, F.lit(False)).alias("out_of_range"),
                F.lit(0).cast("long").alias("new_values"),
            )
        )
    if categorical:
        counts = paired_counts(ref, cur, categorical, keys, "string", nulls=True)
        is_null = F.col("value").isNull()
        parts.append(
            counts.groupBy(*keys, F.col("feature").alias("column"))
            .agg(
                F.coalesce(F.sum(F.when(is_null, F.col("r"))), F.lit(0)).alias("_mr"),
                F.coalesce(F.sum(F.when(is_null, F.col("c"))), F.lit(0)).alias("_mc"),
                F.sum("r").alias("_nr"),
                F.sum("c").alias("_nc"),
                F.count_if((F.col("r") == 0) & ~is_null).alias("new_values"),
            )
            .select(
                *on,
                F.round(ratio("_mr", "_nr", None), 4).alias("reference_missing_rate"),
                F.round(ratio("_mc", "_nc", None), 4).alias("current_missing_rate"),
                F.lit(False).alias("out_of_range"),
                "new_values",
            )
        )
    rows = reduce(DataFrame.unionByName, parts)
    return rows.withColumn(
        "missing_rate_change", F.col("current_missing_rate") - F.col("reference_missing_rate")
    )


def monitoring_summary(
    data: DataFrame, concept: DataFrame, prediction: DataFrame, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per group with the three flags; a missing report counts as no drift."""
    on = list(keys) or ["_one"]

    def part(df, columns):
        rows = df if keys else df.withColumn("_one", F.lit(1))
        return rows.select(*on, *columns)

    joined = part(data, ["overall_drift_detected", "drift_percentage"])
    joined = keyed_join(joined, part(concept, ["concept_drift_detected"]), on, "full")
    joined = keyed_join(joined, part(prediction, ["prediction_drift_detected"]), on, "full")
    flags = {
        "data_drift_detected": F.coalesce("overall_drift_detected", F.lit(False)),
        "concept_drift_detected": F.coalesce("concept_drift_detected", F.lit(False)),
        "prediction_drift_detected": F.coalesce("prediction_drift_detected", F.lit(False)),
        "drift_percentage": F.coalesce("drift_percentage", F.lit(0.0)),
    }
    out = joined.select(*keys, *[c.alias(n) for n, c in flags.items()])
    return out.withColumn(
        "any_drift_detected",
        F.col("data_drift_detected") | F.col("concept_drift_detected") | F.col("prediction_drift_detected"),
    )


def severity_column(data="data_drift_detected", concept="concept_drift_detected", pct="drift_percentage"):
    data, concept, pct = F.col(data), F.col(concept), F.col(pct)
    return (
        F.when(concept & data, "CRITICAL")
        .when(concept | (pct > 50), "HIGH")
        .when(pct > 20, "MEDIUM")
        .when(data, "LOW")
        .otherwise("NONE")
    )


def fallback_severity(data="data_drift_detected", concept="concept_drift_detected") -> Column:
    """Grade from the raw flags when no consolidated analysis exists."""
    return (
        F.when(F.col(concept) & F.col(data), "HIGH")
        .when(F.col(concept), "MEDIUM")
        .when(F.col(data), "LOW")
        .otherwise("NONE")
    )


def recommendation_text(severity: Column) -> Column:
    pairs = [F.lit(x) for kv in RECOMMENDATIONS.items() for x in kv]
    return F.element_at(F.create_map(*pairs), severity)


def grade(summary: DataFrame) -> DataFrame:
    return (
        summary.withColumn("severity", severity_column())
        .withColumn("action_required", F.col("severity").isin(ACTION_SEVERITIES))
        .withColumn("recommendation", recommendation_text(F.col("severity")))
    )


def alert_gate(analysis: DataFrame, raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups to alert on: analysed severity, else the fallback grading of the raw flags.

    Both sides have one row per group.
    """
    keys = list(keys)
    graded = analysis.select(*keys, F.col("severity").alias("_severity"), F.col("recommendation").alias("_text"))
    rows = keyed_join(raw, graded, keys).withColumn("severity", F.coalesce("_severity", fallback_severity()))
    return (
        rows.withColumn(
            "recommendation", F.coalesce("_text", F.concat(F.lit("Severity: "), F.col("severity")))
        )
        .where(F.col("severity").isin(ALERT_SEVERITIES))
        .select(*keys, "severity", "recommendation", "any_drift_detected")
    )


def alert_rows(alerts: DataFrame, message: str, context: Sequence[str], limit: int | None = None) -> DataFrame:
    """Audit rows: timestamp, severity, message and the context cut to ``limit`` characters."""
    return alerts.select(
        F.current_timestamp().alias("timestamp"),
        "severity",
        F.lit(message).alias("message"),
        F.when(F.col("severity").isin(ACTION_SEVERITIES), "error").otherwise("warning").alias("log_level"),
        truncated_json(F.struct(*context), limit).alias("drift_details"),
    )


def retrain_rows(alerts: DataFrame, action: str, build: str, keys: Sequence[str] = (), at: Column | None = None) -> DataFrame:
    """One recommendation to retrain for each alert, stamped with ``at`` (default: now)."""
    return alerts.select(
        *keys,
        (F.current_timestamp() if at is None else at).alias("timestamp"),
        F.lit("RETRAIN").alias("recommendation"),
        F.lit(RETRAIN_REASON).alias("reason"),
        F.lit(action).alias("action_required"),
        F.lit(build).alias("build"),
    )


def metric_trend(
    runs: DataFrame, metric: str, run: str, keys: Sequence[str] = (), window: int = 3
) -> DataFrame:
    """Each run's metric against the previous run and a rolling mean (one row per run)."""
    walk = Window.partitionBy(*keys).orderBy(run)
    return runs.withColumns(
        {
            "previous": F.lag(metric).over(walk),
            "change": F.col(metric) - F.lag(metric).over(walk),
            "rolling_mean": F.avg(metric).over(walk.rowsBetween(1 - window, 0)),
        }
    )
