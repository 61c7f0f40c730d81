"""Sinks: versioned snapshots, appended scores, CSV, JSON reports, and fitted state."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scorewright.operators.features import FeatureState
from scorewright.operators.model import LogisticModel


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; failed tasks leave nothing behind (commit protocol)."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_snapshot(df: DataFrame, path: str, version: int) -> None:
    """Register ``df`` as ``version`` (a Unix time). Re-running replaces only that version."""
    (
        df.withColumn("version", F.lit(int(version)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("version")
        .parquet(path)
    )


def write_by_date(df: DataFrame, path: str, ts: str, date_column: str = "event_date") -> None:
    """Lay a log out by day, so a daily read touches one folder.

    The rebalance gathers small days into few files and splits a day that holds most rows.
    """
    dated = df.withColumn(date_column, F.to_date(ts)).hint("rebalance", F.col(date_column))
    dated.write.mode("append").partitionBy(date_column).parquet(path)


def json_report(df: DataFrame, columns: Sequence[str | Column], into: str = "report") -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct(*columns)).alias(into))


def read_report(df: DataFrame, column: str, schema: str) -> DataFrame:
    return df.select(F.from_json(column, schema).alias("r")).select("r.*")


def save_state(state: FeatureState, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """Fitted preprocessing as two tables: per-column numbers and the vocabulary."""
    rows = [("median", c, v, None) for c, v in state.medians.items()]
    rows += [("mode", c, None, v) for c, v in state.modes.items()]
    rows += [("mean", c, v, None) for c, v in state.means.items()]
    rows += [("std", c, v, None) for c, v in state.stds.items()]
    table = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "position int, kind string, feature string, number double, text string",
    )
    table.coalesce(1).write.mode(mode).parquet(f"{path}/columns")
    if state.vocab is not None:
        state.vocab.write.mode(mode).parquet(f"{path}/vocab")


def load_state(spark: SparkSession, path: str, has_vocab: bool = True) -> FeatureState:
    rows = spark.read.parquet(f"{path}/columns").orderBy("position").collect()

    def pick(kind, field):
        return {r["feature"]: r[field] for r in rows if r["kind"] == kind}

    return FeatureState(
        pick("median", "number"),
        pick("mode", "text"),
        spark.read.parquet(f"{path}/vocab") if has_vocab else None,
        pick("mean", "number"),
        pick("std", "number"),
    )


def save_model(model: LogisticModel, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """One row: the feature order, weights and intercept as JSON text."""
    doc = json.dumps({"features": model.features, "weights": model.weights, "intercept": model.intercept})
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode(mode).text(path)


def load_model(spark: SparkSession, path: str) -> LogisticModel:
    doc = json.loads(spark.read.text(path).first()["value"])
    return LogisticModel(tuple(doc["features"]), tuple(doc["weights"]), doc["intercept"])
