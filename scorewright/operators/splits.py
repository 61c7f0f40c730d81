"""Deterministic splits and assignments by the hash rank of a unique row key.

Exact counts need the k-th smallest hash of each stratum. It is found by radix selection, without sorting a
stratum: the hashes are staged once, rows are counted per prefix of four hex digits, the prefix counts
lead to the prefix that holds the k-th row, and as long as that prefix holds too many rows it is refined by
four digits more. Only the rows inside the last prefix are ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from scorewright.functions.columns import hash_hex
from scorewright.operators.joins import lookup_join
from scorewright.session import stage

#: Hex digits of one level, and rows that the last prefix may hold.
DIGITS = 4
RANKED_ROWS = 1_000_000
MD5_DIGITS = 32


def take_threshold(
    df: DataFrame, key: Sequence[str], seed: int | str, size: Column, strata: Sequence[str] = ()
) -> DataFrame:
    """Rows (strata, cut): a row is among the first ``size`` iff its hash <= cut.

    ``size`` is a Column over the stratum's row count ``n``. The count is exact when ``key``
    is unique; rows that share a key always stay on the same side.
    """
    strata = list(strata)
    hashed = stage(df.select(*strata, hash_hex(key, seed).alias("h")))
    group = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(1))
    walk = group.orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    inside, need, width = hashed, size.cast("long"), DIGITS
    while True:
        # at most 16**DIGITS rows per stratum reach this window, whatever the level
        per_prefix = inside.groupBy(*strata, *(["need"] if width > DIGITS else []), F.substring("h", 1, width).alias("prefix"))
        located = stage(
            per_prefix.agg(F.count(F.lit(1)).alias("c"))
            .withColumn("n", F.sum("c").over(group))
            .withColumn("k", need)
            .withColumn("cum", F.sum("c").over(walk))
            .where("cum - c < k AND k <= cum")
            .select(*strata, "prefix", (F.col("k") - (F.col("cum") - F.col("c"))).alias("need"), "c")
        )
        keyed = hashed.withColumn("prefix", F.substring("h", 1, width))
        inside = lookup_join(keyed, located.drop("c"), [*strata, "prefix"], "inner", null_safe=True, staged=True)
        if width >= MD5_DIGITS or (located.agg(F.max("c")).first()[0] or 0) <= RANKED_ROWS:
            break
        need, width = F.col("need"), width + DIGITS
    # copies of a key collapse before the window, so it sees distinct hashes only
    distinct = inside.groupBy(*strata, "prefix", "need", "h").agg(F.count(F.lit(1)).alias("c"))
    upto = Window.partitionBy(*strata, "prefix").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    ranked = distinct.withColumn("cum", F.sum("c").over(upto))
    return stage(ranked.where("cum - c < need AND need <= cum").select(*strata, F.col("h").alias("cut")))


def mark_first(
    df: DataFrame,
    key: Sequence[str],
    seed: int | str,
    size: Column,
    strata: Sequence[str] = (),
    into: str = "picked",
) -> DataFrame:
    """Add boolean ``into``: the row is among the first ``size`` of its stratum by hash."""
    strata = list(strata)
    cuts = take_threshold(df, key, seed, size, strata)
    if strata:
        joined = lookup_join(df, cuts, strata, null_safe=True, staged=True)
    else:
        row = cuts.first()  # one row: the cut of the whole table
        joined = df.withColumn("cut", F.lit(row["cut"] if row else None).cast("string"))
    return joined.withColumn(
        into, F.coalesce(hash_hex(key, seed) <= F.col("cut"), F.lit(False))
    ).drop("cut")


def split(
    df: DataFrame,
    key: Sequence[str],
    fraction: float = 0.2,
    seed: int = 42,
    strata: Sequence[str] = (),
    exact: bool = True,
    into: str = "split",
) -> DataFrame:
    """Add ``split`` = 'test' for ``fraction`` of the rows (of every stratum), else 'train'."""
    if exact:
        size = F.floor(F.col("n") * F.lit(fraction) + F.lit(0.5))
        marked = mark_first(df, key, seed, size, strata, "_test")
    else:
        marked = df.withColumn("_test", below_fraction(key, seed, fraction))
    return marked.withColumn(into, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def below_fraction(key: Sequence[str], seed: int | str, fraction: float) -> Column:
    """Row-local test with no shuffle: the first 32 hash bits are below the fraction."""
    return bucket_of(key, seed, 1 << 32) < F.lit(int(round(fraction * (1 << 32))))


def bucket_of(key: Sequence[str], seed: int | str, buckets: int) -> Column:
    head = F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("long")
    return head % F.lit(buckets)


def sample_fraction(df: DataFrame, key: Sequence[str], fraction: float = 0.8, seed: int = 42):
    """Exactly round(fraction * n) rows."""
    size = F.floor(F.col("n") * F.lit(fraction) + F.lit(0.5))
    return mark_first(df, key, seed, size, (), "_in").where("_in").drop("_in")


def assign_ab(
    df: DataFrame, key: Sequence[str], share: float = 0.1, seed: int = 42, enabled: bool = True
) -> DataFrame:
    """Add ``model_variant``: exactly int(n * share) challenger rows, the rest champion."""
    if not enabled:
        return df.withColumn("model_variant", F.lit("champion"))
    marked = mark_first(df, key, seed, F.floor(F.col("n") * F.lit(share)), (), "_in")
    return marked.withColumn(
        "model_variant", F.when(F.col("_in"), "challenger").otherwise("champion")
    ).drop("_in")


def assign_weighted(
    df: DataFrame, key: Sequence[str], weights: Mapping[str, int], seed: int = 42
) -> DataFrame:
    """Add ``version``: keys are routed by integer percentage weights, stable per key."""
    if sum(weights.values()) != 100:
        raise ValueError("weights must add up to 100")
    slot = bucket_of(key, seed, 100)
    chain, upto = None, 0
    for version, weight in weights.items():
        upto += weight
        step = (slot < upto, F.lit(version))
        chain = F.when(*step) if chain is None else chain.when(*step)
    return df.withColumn("version", chain)


def canary_weights(candidate: str, primary: str | None, canary: int = 10) -> dict[str, int]:
    """All traffic to the candidate when there is no other primary."""
    if not primary or primary == candidate:
        return {candidate: 100}
    return {candidate: canary, primary: 100 - canary}
