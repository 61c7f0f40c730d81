"""Column profiles, summaries and baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.functions.stats import ratio
from scorewright.operators.joins import collect_bounded, keyed_join
from scorewright.session import stage
from scorewright.operators.ordered import long_form, quantile_name, quantiles


def positive_rate(c: str) -> Column:
    """Share of rows equal to 1 among non-null values."""
    return F.avg(F.when(F.col(c).isNotNull(), F.when(F.col(c) == 1, 1.0).otherwise(0.0)))


def profile_numeric(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    qs: Sequence[float] = (0.5, 0.25, 0.75),
    approx: bool = False,
) -> DataFrame:
    """One row per (keys, column): missing count and rate, mean, sample std, extremes, quantiles.

    Moments of all columns come from one wide aggregate, which also sizes the groups for
    the quantiles; those are exact unless ``approx``.
    """
    keys = list(keys)
    aggs = []
    for i, c in enumerate(columns):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None))
        aggs += [
            F.count_if(v.isNull()).alias(f"m{i}"),
            F.avg(v).alias(f"a{i}"),
            F.stddev_samp(v).alias(f"s{i}"),
            F.min(v).alias(f"lo{i}"),
            F.max(v).alias(f"hi{i}"),
        ]
        if approx:
            aggs.append(F.percentile_approx(v, list(qs)).alias(f"q{i}"))
    wide = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggs)
    exact = bool(qs) and not approx
    if exact:
        wide = stage(wide)
    small = collect_bounded(wide) if exact else None
    biggest = None
    if small is not None:
        wide = small
        biggest = small.agg(F.max("n")).first()[0] or 0
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(dict(df.dtypes)[c]).alias("dtype"),
            F.col("n").alias("n_rows"),
            F.col(f"m{i}").alias("missing_count"),
            F.round(F.try_divide(F.col(f"m{i}").cast("double"), F.col("n")), 4).alias("missing_rate"),
            F.col(f"a{i}").alias("mean"),
            F.col(f"s{i}").alias("std"),
            F.col(f"lo{i}").alias("min"),
            F.col(f"hi{i}").alias("max"),
            *(
                [F.col(f"q{i}")[j].alias(name) for j, name in enumerate(map(quantile_name, qs))]
                if approx
                else []
            ),
        )
        for i, c in enumerate(columns)
    ]
    moments = wide.select(*keys, F.inline(F.array(*entries)))
    if not exact:
        return moments
    cuts = quantiles(df, columns, qs, keys, biggest=biggest).withColumnRenamed("feature", "column")
    # one row per group and column on both sides
    return keyed_join(moments, cuts, [*keys, "column"])


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, column, value, n); nulls are a value of their own."""
    long = long_form(df, columns, keys, "string").withColumnRenamed("feature", "column")
    return long.groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(counts: DataFrame, keys: Sequence[str] = (), top: int = 10) -> DataFrame:
    """The ``top`` most frequent values per column; ties by value, nulls last.

    The rank filter is pushed below the shuffle (window group limit).
    """
    w = Window.partitionBy(*keys, "column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def profile_categorical(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), top: int = 10
) -> DataFrame:
    """One row per (keys, column): distinct count (nulls out), missing, top values (nulls in)."""
    keys = list(keys)
    counts = value_counts(df, columns, keys)
    totals = counts.groupBy(*keys, "column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing_count"),
        F.count("value").alias("unique_count"),
    )
    best = (
        top_values(counts, keys, top)
        .groupBy(*keys, "column")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "n"))).alias("top"))
        .select(
            *keys,
            "column",
            F.map_from_entries(
                F.transform(
                    "top", lambda t: F.struct(F.coalesce(t["value"], F.lit("nan")), t["n"])
                )
            ).alias("top_values"),
        )
    )
    totals = totals.withColumn("missing_rate", F.round(ratio("missing_count", "n_rows", None), 4))
    return keyed_join(totals, best, [*keys, "column"])


def baseline_stats(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """mean, sample std, min, max, median per feature: the drift baseline."""
    rows = profile_numeric(df, columns, keys, (0.5,))
    return rows.select(*keys, F.col("column").alias("feature"), "mean", "std", "min", "max", "median")


def scoring_summary(df: DataFrame, keys: Sequence[str] = (), pred="prediction", confidence="confidence"):
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col(pred) == 1).alias("positive_predictions"),
        F.count_if(F.col(pred) == 0).alias("negative_predictions"),
        F.avg(confidence).alias("average_confidence"),
        F.min(confidence).alias("min_confidence"),
        F.max(confidence).alias("max_confidence"),
    )


def batch_rate(df: DataFrame, batch: Sequence[str], pred: str = "prediction") -> DataFrame:
    """Rows, positives and rate (4 decimals, 0 when empty) per request batch."""
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(pred) == 1).alias("positive_count"),
    ).withColumn("positive_rate", F.round(ratio("positive_count", "total"), 4))


def rollup_summary(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column], how: str = "rollup"):
    """Any of the summaries by segment with subtotals and a grand total."""
    grouped = {"rollup": df.rollup, "cube": df.cube, "groupBy": df.groupBy}[how](*keys)
    level = [F.grouping_id().alias("level")] if how != "groupBy" else []
    return grouped.agg(*level, *aggs)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns))
    )
