"""Prediction log, late labels, matching and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from scorewright.functions.columns import row_id
from scorewright.functions.stats import ratio
from scorewright.operators.joins import keyed_join, lookup_join
from scorewright.operators.splits import sample_fraction

# Fixed value: what a coverage report says where nothing was logged.
NOTHING_LOGGED = "No predictions logged yet"


def stamp(df: DataFrame, keys: Sequence[str], run_id: str, logged_at: Column | None = None) -> DataFrame:
    """Add inference_id (deterministic per key and run), logged_at, run_id and the columns a late label fills:
    ground_truth and feedback_received_at (null) and feedback_received (false)."""
    return df.withColumns(
        {
            "inference_id": row_id(keys, run_id),
            "logged_at": F.current_timestamp() if logged_at is None else logged_at,
            "run_id": F.lit(run_id),
            "ground_truth": F.lit(None).cast("int"),
            "feedback_received": F.lit(False),
            "feedback_received_at": F.lit(None).cast("timestamp"),
        }
    )


def log_predictions(df: DataFrame, path: str, keys: Sequence[str], run_id: str) -> None:
    """Append one run to the log. Re-running a run replaces only its own partition."""
    (
        stamp(df, keys, run_id)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def append_logs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are null."""
    return old.unionByName(new, allowMissingColumns=True)


def latest_labels(labels: DataFrame, key: str, label: str, arrival: Sequence[str]) -> DataFrame:
    """One row per key (as string): the last label to arrive; rows without a key or a label are no
    labels. Partial aggregation absorbs hot keys."""
    given = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    return given.groupBy(F.col(key).cast("string").alias("_key")).agg(
        F.max_by(F.col(label), F.struct(*arrival)).alias("ground_truth")
    )


def label_join(
    preds: DataFrame, labels: DataFrame, key: str, id_col: str, label: str, arrival: Sequence[str]
) -> DataFrame:
    """Every prediction with its newest label; ``feedback_received`` tells whether one came. Label columns
    that the log has already are filled, and kept where no label came."""
    newest = latest_labels(labels, id_col, label, arrival)
    keyed = preds.withColumn("_key", F.col(key).cast("string"))
    given = [c for c in ("ground_truth", "feedback_received") if c in preds.columns]
    keyed = keyed.withColumnsRenamed({c: f"_{c}" for c in given})
    joined = lookup_join(keyed, newest.withColumn("_hit", F.lit(True)), ["_key"])
    if "ground_truth" in given:
        kind = newest.schema["ground_truth"].dataType
        joined = joined.withColumn("ground_truth", F.coalesce("ground_truth", F.col("_ground_truth").cast(kind)))
    if "feedback_received_at" in preds.columns:
        at = F.when(F.col("_hit"), F.current_timestamp()).otherwise(F.col("feedback_received_at"))
        joined = joined.withColumn("feedback_received_at", at)
    before = ["_feedback_received"] if "feedback_received" in given else []
    received = F.coalesce("_hit", *before, F.lit(False))
    return joined.withColumn("feedback_received", received).drop("_key", "_hit", *[f"_{c}" for c in given])


def unmatched(preds: DataFrame, labels: DataFrame, key: str, id_col: str) -> DataFrame:
    """Predictions still waiting for a label."""
    ids = labels.select(F.col(id_col).cast("string").alias("_key")).distinct()
    keyed = preds.withColumn("_key", F.col(key).cast("string"))
    return lookup_join(keyed, ids, ["_key"], "left_anti").drop("_key")


def submit_labels(preds, labels, key, id_col, label, arrival) -> DataFrame:
    """One row: how many logged predictions a label batch updates."""
    joined = label_join(preds, labels, key, id_col, label, arrival)
    return joined.agg(F.count_if("feedback_received").alias("updated"))


def coverage(joined: DataFrame, keys: Sequence[str] = (), at: Column | None = None, expected: DataFrame | None = None) -> DataFrame:
    """Timestamp, predictions, labels received, fraction (4 decimals) and percent (2 decimals).

    ``expected`` lists groups (``keys``) that must be in the report: one without any logged prediction gets
    a row of zeros with a message, and so does an empty log without keys.
    """
    counted = joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_predictions"), F.count_if("feedback_received").alias("feedback_received")
    )
    if expected is not None:
        counted = keyed_join(expected.select(*keys).distinct(), counted, keys, "full")
        counted = counted.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("total_predictions", "feedback_received")})
    share = F.col("feedback_received") / F.greatest(F.col("total_predictions"), F.lit(1))
    return counted.withColumns(
        {
            "coverage_fraction": F.round(share, 4),
            "coverage_percent": F.round(share * 100, 2),
            "timestamp": F.current_timestamp() if at is None else at,
            "message": F.when(F.col("total_predictions") == 0, NOTHING_LOGGED),
        }
    )


def matched(joined: DataFrame, min_coverage: float = 0.0, keys: Sequence[str] = ()) -> DataFrame:
    """Labelled rows (``ground_truth`` renamed to ``actual_label``), none of a group whose
    coverage is below ``min_coverage``."""
    rows = joined.where("feedback_received").withColumnRenamed("ground_truth", "actual_label")
    if min_coverage <= 0:
        return rows
    share = ratio(F.count_if("feedback_received"), F.greatest(F.count(F.lit(1)), F.lit(1)))
    if keys:
        passing = joined.groupBy(*keys).agg(share.alias("_cov")).where(F.col("_cov") >= min_coverage)
        return lookup_join(rows, passing.select(*keys), list(keys), "left_semi", null_safe=True)
    got = joined.agg(share.alias("s")).first()["s"]
    return rows if got >= min_coverage else rows.where(F.lit(False))


def simulate_feedback(
    preds: DataFrame, truth: DataFrame, key: str, id_col: str, label: str, fraction=0.8, seed=42
) -> DataFrame:
    """Label an exact fraction of the known outcomes and submit them."""
    known = truth.select(id_col, label).dropna()
    labelled = sample_fraction(known, [id_col], fraction, seed)
    return submit_labels(preds, labelled, key, id_col, label, [label])
