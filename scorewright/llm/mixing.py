"""Mixing sources to target weights along a time-varying curriculum, natively in Spark.

Each source has a weight schedule over training progress 0..1 (straight lines between the given
points). Its share is integrated to a cumulative token demand; a source may give each document at
most ``max_repeat`` times, and what it cannot give is reshared by weight. Inverting the demand at a
document's place inside its source gives the training position of each of its copies, and the
mix is range-sorted by position.

Places inside a source are cumulative sizes in hash order. They come from sums over (source, slice
of the hash), so a source with a third of all rows is cut into as many slices as its rows need, and
each slice is one small window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from scorewright.llm.base import boxed, field, unboxed, word_count

#: Straight line from weights (1, 2, 3, repeating over the sources) to the same: a constant mix.
CONSTANT = ((0.0, (1.0, 2.0, 3.0)), (1.0, (1.0, 2.0, 3.0)))
STEPS = 64
ROWS_PER_SLICE = 20_000


def _weight(cycle: Sequence[float], rank: Column) -> Column:
    return F.get(F.array(*[F.lit(float(w)) for w in cycle]), ((rank - 1) % len(cycle)).cast("int"))


def _pieces(schedule) -> list[tuple[float, float, tuple[float, ...]]]:
    """Steps of progress with the weights at their middle; one step if the weights never change."""
    points = sorted((float(t), tuple(map(float, w))) for t, w in schedule)
    if len({w for _, w in points}) == 1:
        return [(0.0, 1.0, points[0][1])]
    out = []
    for k in range(STEPS):
        mid = (k + 0.5) / STEPS
        left = max((p for p in points if p[0] <= mid), default=points[0])
        right = min((p for p in points if p[0] > mid), default=points[-1])
        f = 0.0 if right[0] <= left[0] else (mid - left[0]) / (right[0] - left[0])
        out.append((k / STEPS, (k + 1) / STEPS, tuple(a + (b - a) * f for a, b in zip(left[1], right[1]))))
    return out


def source_targets(sizes: DataFrame, schedule=CONSTANT, max_repeat: int = 3) -> DataFrame:
    """(source, source_size) to (source, source_size, target, curve).

    Sources are ranked by code point, null last, and take their weights from the schedule's cycles
    by rank. ``target`` is the source's words in the mix: its integrated share of all sizes, at most
    ``max_repeat`` times its size, the excess reshared by the integrated weights; a source whose weight is 0
    all along has the target 0. ``curve`` is the
    cumulative demand at the end of each step of progress. The windows hold one row per source.
    """
    pieces = _pieces(schedule)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = sizes.withColumn("__rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    shares = []
    for begin, end, cycle in pieces:
        w = _weight(cycle, F.col("__rank"))
        # a step of progress in which no source has weight shares nothing
        shares.append(w if len(pieces) == 1 else F.coalesce(F.try_divide(w, F.sum(w).over(everything)), F.lit(0.0)) * (end - begin))
    ranked = ranked.withColumn("__shares", F.array(*shares)).withColumns(
        {
            "__w": F.aggregate("__shares", F.lit(0.0), lambda a, x: a + x),
            "__cap": (F.col("source_size") * max_repeat).cast("double"),
            "__all": F.sum("source_size").over(everything).cast("double"),
        }
    )
    # a source without weight is full at no level: it comes last and shares nothing
    ranked = ranked.withColumn("__full_at", F.try_divide("__cap", "__w"))
    order = W.orderBy(F.col("__full_at").asc_nulls_last(), F.col("__rank"))
    filled = ranked.withColumns(
        {
            "__before": F.coalesce(F.sum("__cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
            "__rest": F.sum("__w").over(order.rowsBetween(0, W.unboundedFollowing)),
        }
    ).withColumn("__level", F.try_divide(F.col("__all") - F.col("__before"), "__rest"))
    fits = F.when(F.col("__level") <= F.col("__full_at"), F.col("__level"))
    filled = filled.withColumn("__fill", F.max(fits).over(everything))
    target = F.when(F.col("__w") > 0, F.least(F.col("__cap"), F.coalesce(F.col("__w") * F.col("__fill"), F.col("__cap")))).otherwise(F.lit(0.0))
    run = F.transform(
        F.sequence(F.lit(1), F.lit(len(pieces))),
        lambda k: F.aggregate(F.slice("__shares", 1, k), F.lit(0.0), lambda a, x: a + x),
    )
    return filled.withColumn("target", target).select(
        "source",
        "source_size",
        "target",
        F.transform(run, lambda part: F.coalesce(F.col("target") * F.try_divide(part, F.col("__w")), F.lit(0.0))).alias("curve"),
    )


def progress_at(curve: Column, offset: Column) -> Column:
    """Training progress (0 to 1) at which a source's cumulative demand reaches ``offset``."""
    n = F.size(curve)
    at = F.least(F.size(F.filter(curve, lambda x: x <= offset)), n - 1)
    low = F.when(at == 0, F.lit(0.0)).otherwise(F.get(curve, at - 1))
    high = F.get(curve, at)
    inside = F.when(high > low, (offset - low) / (high - low)).otherwise(F.lit(0.0))
    return F.least(F.lit(1.0), (at + inside) / n)


def plan_mix(
    docs: DataFrame,
    schedule=CONSTANT,
    max_repeat: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: mix_id, mix_size, source_size, target, copies, taken, positions.

    ``copies`` whole passes over the document are in the mix, ``taken`` = copies * size, and
    ``positions`` holds the training progress of each copy. A source's last, partial pass takes the
    documents whose middle lies before its end, so its taken words are within half a document of
    its target. With ``keep`` the row itself is there too, as the struct ``row``.

    Null text: size 0. Null source: a source of its own, ranked last. Rows of size 0 are in the mix
    once more than their source's full passes at most, and take nothing. Ties in hash order go by id
    and size; equal rows are interchangeable. An empty table gives an empty table.
    """
    rows = boxed(docs).select(
        *(["row"] if keep else []),
        field(id_col).alias("mix_id"),
        field(source_col).alias("mix_source"),
        word_count(field(text_col)).alias("mix_size"),
        F.md5(F.coalesce(field(id_col).cast("string"), F.lit(""))).alias("mix_hash"),
    )
    slices = max(32, -(-docs.count() // ROWS_PER_SLICE))
    place = F.conv(F.substring("mix_hash", 1, 7), 16, 10).cast("long")
    rows = rows.withColumn("mix_slice", F.floor(place * slices / 16**7).cast("int"))
    parts = rows.groupBy("mix_source", "mix_slice").agg(F.sum("mix_size").alias("__part"))
    in_order = W.partitionBy("mix_source").orderBy("mix_slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("__start", F.coalesce(F.sum("__part").over(in_order), F.lit(0)))
    sizes = parts.groupBy(F.col("mix_source").alias("source")).agg(F.sum("__part").alias("source_size"))
    targets = source_targets(sizes, schedule, max_repeat)
    places = parts.join(targets, F.col("mix_source").eqNullSafe(F.col("source"))).select(
        F.col("mix_source").alias("__src"), F.col("mix_slice").alias("__slice"),
        "__start", F.col("source_size").alias("__size"), F.col("target").alias("__target"), F.col("curve").alias("__curve"),
    )
    window = W.partitionBy("mix_source", "mix_slice").orderBy("mix_hash", "mix_id", "mix_size")
    before = F.coalesce(F.sum("mix_size").over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("__before", before).join(
        places,
        F.col("mix_source").eqNullSafe(F.col("__src")) & (F.col("mix_slice") == F.col("__slice")),
    )
    full = F.when(F.col("__size") > 0, F.floor(F.col("__target") / F.col("__size"))).otherwise(F.lit(0))
    rest = F.col("__target") - full * F.col("__size")
    offset = F.col("__start") + F.col("__before")
    copies = (full + F.when(offset + F.col("mix_size") * 0.5 <= rest, 1).otherwise(0)).cast("int")
    copies = F.least(copies, F.lit(max_repeat))
    placed = placed.withColumns({"__offset": offset, "mix_copies": copies})
    passes = F.when(F.col("mix_copies") > 0, F.sequence(F.lit(0), F.col("mix_copies") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    placed = placed.withColumns(
        {
            "mix_source_size": F.col("__size"),
            "mix_target": F.col("__target"),
            "mix_taken": F.col("mix_copies") * F.col("mix_size"),
            "mix_positions": F.transform(
                passes, lambda k: progress_at(F.col("__curve"), F.col("__offset") + k * F.col("__size"))
            ),
        }
    )
    return placed.drop(
        "__before", "__src", "__slice", "__start", "__size", "__target", "__curve", "__offset", "mix_hash", "mix_slice", "mix_source"
    )


def mix(docs: DataFrame, schedule=CONSTANT, max_repeat: int = 3, partitions: int | None = None, **names: str) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy, range-sorted by training position.

    Documents without a copy are left out. Null, tie and empty-table rules are those of ``plan_mix``.
    """
    planned = plan_mix(docs, schedule, max_repeat, keep=True, **names)
    copies = planned.withColumn("mix_position", F.explode("mix_positions"))
    return unboxed(in_order(copies, partitions), docs.columns)


def in_order(planned: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows with a ``mix_position`` range-sorted by it; those of one position go by id, those without come last."""
    by = [F.col("mix_position").asc_nulls_last(), F.col("mix_id")]
    ranged = planned.repartitionByRange(partitions, *by) if partitions else planned.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)
