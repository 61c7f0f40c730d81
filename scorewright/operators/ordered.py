"""Running sums and exact quantiles that never pull an ordered group into one task.

A plain ``Window.orderBy`` puts a whole group in one task. Here rows are first collapsed
to distinct values (map-side combined), range-partitioned and sorted by (keys, value), and scanned
once in Arrow, in small ranges of bounded memory each; what the scan gives is staged. Groups that
straddle small ranges then get the missing part from a table of at most two rows for each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from scorewright.operators.joins import lookup_join
from scorewright.session import stage

EXACT_BUFFER_ROWS = 2_000_000
SKETCH_ACCURACY = 10_000
#: Rows and bytes (about) of a small range: what a scanning task holds at once.
SMALL_ROWS = 100_000
SMALL_BYTES = 16 << 20


def prefix_sum(
    counts: DataFrame,
    order: Sequence[str],
    values: Sequence[str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Running sums over ``counts``, which has one row per (keys, order).

    Adds for every value column v: ``cum_v`` (ascending, inclusive), ``total_v`` (whole
    group), and ``prev`` / ``next``: structs of the neighbouring row's order and value
    columns (null at the ends).
    """
    keys, order, values = list(keys), list(order), list(values)
    ranged = counts.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    local = stage(ranged.mapInArrow(_scanner(keys, order, values), _scan_schema(counts.schema, order, values)))
    # One row per (small range, group) of the groups that touch its border; kept are those cut by one.
    neighbour = F.struct(*order, *values)
    pieces = local.where("_edge").groupBy("_pid", *keys).agg(
        *[F.any_value(f"total_{v}").alias(f"_sum_{v}") for v in values],
        F.min_by(neighbour, F.struct(*order)).alias("_first"),
        F.max_by(neighbour, F.struct(*order)).alias("_last"),
    )
    by_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    walk = by_group.orderBy("_pid")
    before = walk.rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        pieces.withColumn("_n", F.count(F.lit(1)).over(by_group))
        .where("_n > 1")
        .select(
            "_pid",
            *keys,
            *[F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0)).alias(f"_off_{v}") for v in values],
            *[F.sum(f"_sum_{v}").over(by_group).alias(f"_all_{v}") for v in values],
            F.lag("_last").over(walk).alias("_edge_prev"),
            F.lead("_first").over(walk).alias("_edge_next"),
        )
    )
    joined = lookup_join(local, pieces, ["_pid", *keys], null_safe=True)
    for v in values:
        joined = joined.withColumn(f"cum_{v}", F.col(f"cum_{v}") + F.coalesce(f"_off_{v}", F.lit(0)))
        joined = joined.withColumn(f"total_{v}", F.coalesce(f"_all_{v}", f"total_{v}"))
    joined = joined.withColumn("prev", F.coalesce("prev", "_edge_prev"))
    joined = joined.withColumn("next", F.coalesce("next", "_edge_next"))
    extra = [f"{p}_{v}" for v in values for p in ("_off", "_all")]
    return joined.drop("_pid", "_edge", "_edge_prev", "_edge_next", *extra)


def _scan_schema(given: T.StructType, order: list[str], values: list[str]) -> T.StructType:
    whole = {v: T.LongType() if isinstance(given[v].dataType, T.IntegralType) else T.DoubleType() for v in values}
    beside = T.StructType([T.StructField(c, given[c].dataType) for c in (*order, *values)])
    added = [T.StructField(f"{p}_{v}", whole[v]) for p in ("cum", "total") for v in values]
    added += [T.StructField("prev", beside), T.StructField("next", beside), T.StructField("_pid", T.LongType()), T.StructField("_edge", T.BooleanType())]
    return T.StructType([*given.fields, *added])


def _changes(column: pa.Array) -> np.ndarray:
    """Where a sorted column differs from the row before; null equals null and NaN equals NaN."""
    a, b = column[:-1], column[1:]
    differ = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(column.type):
        nan = pc.fill_null(pc.is_nan(column), False).to_numpy(zero_copy_only=False)
        differ = differ & ~(nan[:-1] & nan[1:])
    null = column.is_null().to_numpy(zero_copy_only=False)
    return differ | (null[:-1] != null[1:])


def _small_ranges(batches: Iterator[pa.RecordBatch], rows: int, size: int) -> Iterator[list[pa.RecordBatch]]:
    """The batches in lists of ``rows`` rows at most, ended after ``size`` bytes."""
    held: list[pa.RecordBatch] = []
    n = used = 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - n)
            held.append(part)
            at, n, used = at + part.num_rows, n + part.num_rows, used + part.nbytes
            if n >= rows or used >= size:
                yield held
                held, n, used = [], 0, 0
    if held:
        yield held


def _scanner(keys: list[str], order: list[str], values: list[str]):
    """Sums along a sorted partition, one small range after another; ``_pid`` numbers these in order."""
    rows, size = SMALL_ROWS, SMALL_BYTES

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        for number, held in enumerate(_small_ranges(batches, rows, size)):
            yield from sums(pa.Table.from_batches(held).combine_chunks(), base + number)

    def sums(table: pa.Table, number: int) -> Iterator[pa.RecordBatch]:
        column = {c: table.column(c).chunk(0) for c in table.column_names}
        n = table.num_rows
        first = np.ones(n, bool)
        if n > 1:
            first[1:] = False
            for c in keys:
                first[1:] |= _changes(column[c])
        group = np.cumsum(first) - 1
        cums, totals = [], []
        for v in values:
            x = pc.fill_null(column[v], 0).to_numpy(zero_copy_only=False)
            if x.dtype.kind in "iu":
                run = np.cumsum(x.astype(np.int64))
                starts = np.flatnonzero(first)
                cum = run - np.concatenate([[0], run[starts[1:] - 1]])[group]
            else:
                cum = pd.Series(x.astype(float)).groupby(group).cumsum().to_numpy()
            last = np.concatenate([np.flatnonzero(first)[1:] - 1, [n - 1]])
            cums.append(pa.array(cum))
            totals.append(pa.array(cum[last][group]))
        beside = pa.StructArray.from_arrays([column[c] for c in (*order, *values)], [*order, *values])
        place, final = np.arange(n), np.append(first[1:], True)
        prev = beside.take(pa.array(np.maximum(place - 1, 0), mask=first))
        after = beside.take(pa.array(np.minimum(place + 1, n - 1), mask=final))
        edge = (group == 0) | (group == group[-1])
        pid = np.full(n, number, np.int64)
        names = [*table.column_names, *[f"cum_{v}" for v in values], *[f"total_{v}" for v in values], "prev", "next", "_pid", "_edge"]
        out = pa.Table.from_arrays([*column.values(), *cums, *totals, prev, after, pa.array(pid), pa.array(edge)], names=names)
        yield from out.to_batches(max_chunksize=100_000)

    return scan


def long_form(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), cast: str = "double"
) -> DataFrame:
    """Rows (keys, feature, value), one per column; nulls stay. A projection, no shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("value")) for c in columns]
    )
    return df.select(*keys, F.inline(pairs))


def quantile_name(q: float) -> str:
    return "median" if q == 0.5 else f"p{round(q * 100):02d}"


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    qs: Sequence[float] = (0.5,),
    keys: Sequence[str] = (),
    buffer_rows: int = EXACT_BUFFER_ROWS,
    biggest: int | None = None,
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows (keys, feature, median, p25, ...).

    A counting pass finds the ``biggest`` group unless the caller knows it. Groups whose values fit an aggregation buffer use the
    built-in ``percentile``; otherwise a sketch brackets each quantile, only values inside a
    bracket are kept apart, and everything else is counted per gap.
    """
    keys, qs, columns = list(keys), list(qs), list(columns)
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    if biggest is None:
        sizes = df.groupBy(*keys).agg(*[F.count(v).alias(c) for c, v in value.items()])
        biggest = sizes.agg(F.max(F.greatest(*columns, F.lit(0)))).first()[0] or 0
    if biggest <= buffer_rows:
        wide = df.groupBy(*keys).agg(*[F.percentile(v, F.lit(qs)).alias(c) for c, v in value.items()])
        pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("q")) for c in columns]
        return (
            wide.select(*keys, F.inline(F.array(*pairs)))
            .where("q IS NOT NULL")
            .select(*keys, "feature", *[F.col("q")[i].alias(quantile_name(q)) for i, q in enumerate(qs)])
        )
    group = [*keys, "feature"]
    long = long_form(df, columns, keys).where("value IS NOT NULL AND NOT isnan(value)")
    margin = 2.0 / SKETCH_ACCURACY
    points = [p for q in qs for p in (max(q - margin, 0.0), min(q + margin, 1.0))]
    sketch = long.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("value", points, SKETCH_ACCURACY).alias("_cut"),
    )
    return bracket_quantiles(long, sketch, group, qs)


def bracket_quantiles(long: DataFrame, sketch: DataFrame, group: list[str], qs: list[float]) -> DataFrame:
    """Quantiles from value brackets whose width the sketch guarantees."""
    rows = lookup_join(long, sketch, group, "inner", null_safe=True)
    inside = F.col("_n") <= SKETCH_ACCURACY
    below = [F.lit(float("-inf")), F.lit(float("-inf"))]
    for i in range(len(qs)):
        lo, hi = F.col("_cut")[2 * i], F.col("_cut")[2 * i + 1]
        inside = inside | F.col("value").between(lo, hi)
        below.append(F.when(F.col("value") > hi, hi))
    counts = (
        rows.select(
            *group,
            F.when(inside, F.col("value")).otherwise(F.greatest(*below)).alias("point"),
            F.when(inside, F.lit(0)).otherwise(F.lit(1)).alias("gap"),
        )
        .groupBy(*group, "point", "gap")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = prefix_sum(counts, ["point", "gap"], ["n"], group)
    first = F.col("cum_n") - F.col("n")
    picks = []
    for q in qs:
        h = (F.col("total_n") - 1) * F.lit(q)
        lo, hi = F.floor(h), F.ceil(h)
        at = lambda r: F.max(F.when((first <= r) & (r < F.col("cum_n")), F.col("point")))
        low, high, frac = at(lo), at(hi), F.max(h - lo)
        picks.append((low + (high - low) * frac).alias(quantile_name(q)))
    return ranked.groupBy(*group).agg(*picks)


def modes(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per column, smallest on ties: rows (keys, feature, mode).

    Ties between numbers go by number, between other values by text.
    """
    group = [*keys, "feature"]
    numeric = [c for c, kind in df.select(*columns).dtypes if kind.startswith(("decimal", "float", "double")) or kind.endswith("int")]
    number = F.when(F.col("feature").isin(numeric), F.expr("try_cast(value AS double)")) if numeric else F.lit(None).cast("double")
    return (
        long_form(df, columns, keys, "string")
        .where("value IS NOT NULL")
        .groupBy(*group, "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*group)
        .agg(F.min(F.struct((-F.col("n")).alias("rank"), number.alias("number"), "value"))["value"].alias("mode"))
    )
