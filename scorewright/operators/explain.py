"""Linear contributions (for other predictors see ``surrogate``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from scorewright.operators.model import LogisticModel

# Report sizes.
TOP_GLOBAL = 10
TOP_LOCAL = 8


def background_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in features]).first()
    return row.asDict()


def contributions(
    df: DataFrame, model: LogisticModel, means: Mapping[str, float], row_key: Sequence[str]
) -> DataFrame:
    """Rows (row_key, feature, value, phi) with phi = w * (x - mean), in log-odds."""
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            (F.lit(w) * (F.col(c).cast("double") - F.lit(means[c]))).alias("phi"),
        )
        for c, w in zip(model.features, model.weights)
    ]
    return df.select(*row_key, F.inline(F.array(*entries)))


def global_importance(phi: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return phi.groupBy(*keys, "feature").agg(
        F.avg(F.abs("phi")).alias("mean_abs_phi"), F.count(F.lit(1)).alias("n_explained")
    )


def rank_features(importance: DataFrame, keys: Sequence[str] = (), by: str = "mean_abs_phi") -> DataFrame:
    """Rank features (one row per feature and group) by size, ties by name."""
    w = Window.partitionBy(*keys).orderBy(F.desc(by), "feature")
    return importance.withColumn("rank", F.row_number().over(w))


def top_global(importance: DataFrame, top: int = TOP_GLOBAL) -> DataFrame:
    return importance.orderBy(F.desc("mean_abs_phi"), "feature").limit(top)


def explain_rows(
    df: DataFrame,
    model: LogisticModel,
    means: Mapping[str, float],
    row_key: Sequence[str],
    top: int = TOP_LOCAL,
) -> DataFrame:
    """Per row the ``top`` contributions by absolute value, with prediction and probability.

    The ranking sorts an array inside the row, so no shuffle is needed.
    """
    entries = F.array(
        *[
            F.struct(
                (-F.abs(F.lit(w) * (F.col(c).cast("double") - F.lit(means[c])))).alias("order"),
                F.lit(c).alias("feature"),
                F.col(c).cast("double").alias("value"),
                (F.lit(w) * (F.col(c).cast("double") - F.lit(means[c]))).alias("phi"),
            )
            for c, w in zip(model.features, model.weights)
        ]
    )
    ranked = df.select(
        *row_key,
        model.probability().alias("probability"),
        F.posexplode(F.slice(F.array_sort(entries), 1, top)).alias("pos", "e"),
    )
    return ranked.select(
        *row_key,
        (F.col("probability") > 0.5).cast("int").alias("prediction"),
        "probability",
        (F.col("pos") + 1).alias("rank"),
        "e.feature",
        "e.value",
        "e.phi",
        F.when(F.col("e.phi") >= 0, "+").otherwise("-").alias("sign"),
    )


def additivity_gap(
    df: DataFrame, model: LogisticModel, means: Mapping[str, float], row_key: Sequence[str]
) -> DataFrame:
    """|intercept + w.mean + sum(phi) - logit(p)| per row: zero up to rounding."""
    base = model.intercept + sum(w * means[c] for c, w in zip(model.features, model.weights))
    total = F.lit(base)
    for c, w in zip(model.features, model.weights):
        total = total + F.lit(w) * (F.col(c).cast("double") - F.lit(means[c]))
    p = model.probability()
    return df.select(*row_key, F.abs(total - F.log(p / (F.lit(1.0) - p))).alias("gap"))


def first_rows(df: DataFrame, row_key: Sequence[str], n: int = 3) -> DataFrame:
    """The first n rows by key: the rows a local report explains."""
    return df.orderBy(*row_key).limit(n)
