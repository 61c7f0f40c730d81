"""Joins of a big table to a lookup table, safe against hot keys.

``lookup_join`` evaluates the lookup side once, into the shared folder, and measures its files. Within the
bound it becomes a driver-local relation and is broadcast; beyond it the join is shuffled. Keys of the
big side whose rows would be too many bytes for one task are found by a mergeable sketch and split
over as many salted copies of their lookup row as their bytes ask for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scorewright.session import stage

MAX_BROADCAST_ROWS = 100_000
#: Bytes of the lookup's columnar files; in memory it may take some times as much.
MAX_BROADCAST_BYTES = 16 << 20
#: Bytes of a key's rows that one task is meant to take.
TASK_BYTES = 64 << 20
#: Keys that the sketch follows, and that may be split.
TRACKED, SPLIT_KEYS = 10_000, 1_000


def keyed_join(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on group keys, where null is a group of its own and matches itself."""
    on = list(on)
    rest = [F.col(c) for c in other.columns if c not in on]
    right = other.select(*[F.col(c).alias(f"_right_{c}") for c in on], *rest)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    joined = df.join(right, same, how)
    if how == "full":
        joined = joined.withColumns({c: F.coalesce(c, f"_right_{c}") for c in on})
    return joined.drop(*[f"_right_{c}" for c in on])


def collect_bounded(
    staged: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame | None:
    """A staged table as a local relation when it has at most ``max_rows`` rows and ``max_bytes``, else None.

    Rows are counted from the files' footers and bytes from their lengths, so a table beyond the
    bound never leaves them.
    """
    spark = staged.sparkSession
    files = staged.inputFiles()
    if files and (file_bytes(spark, files) > max_bytes or staged.count() > max_rows):
        return None
    table = staged.toArrow() if files else None
    if table is None or table.num_rows == 0:
        return spark.createDataFrame([], staged.schema)
    return spark.createDataFrame(table, schema=staged.schema)


def file_bytes(spark, files: Sequence[str]) -> int:
    """Length of files of any store that Spark reaches."""
    path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    fs = path(files[0]).getFileSystem(conf)
    folders = {f.rsplit("/", 1)[0] for f in files}
    return sum(fs.getContentSummary(path(folder)).getLength() for folder in folders)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: its texts' lengths, and eight for every other column."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in wide]
    return reduce(lambda a, b: a + b, sizes, F.lit(8 * (len(df.columns) - len(wide)) + 8)).cast("long")


def hot_keys(df: DataFrame, on: list[str], task_bytes: int = TASK_BYTES, tracked: int = TRACKED) -> dict[int, int]:
    """Hash of each key whose rows exceed what a task is meant to take -> into how many parts to cut it
    (one mergeable sketch pass; rows are taken at their mean size)."""
    keys = df.select(F.xxhash64(*on).alias("k"), row_bytes(df).alias("b"))
    got = keys.agg(F.sum("b").alias("b"), F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {SPLIT_KEYS}, {tracked})").alias("top")).first()
    if not got["n"]:
        return {}
    each = got["b"] / got["n"]
    parts = {item["item"]: math.ceil(item["count"] * each / task_bytes) for item in got["top"] or []}
    return {k: n for k, n in parts.items() if n > 1}


def spread_salt(df: DataFrame, salts: Column) -> Column:
    """A salt below ``salts`` that is stable under task retry and differs for exact copies of a row in
    different input partitions."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), salts).cast("int")


def skew_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    task_bytes: int = TASK_BYTES,
    null_safe: bool = False,
) -> DataFrame:
    """Shuffled join; each hot key of ``df`` is split over as many copies of its lookup row as it needs."""
    join = keyed_join if null_safe else DataFrame.join
    hot = hot_keys(df, on, task_bytes)
    if not hot:
        return join(df, lookup, on, how)
    parts = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in hot.items() for x in kv]), F.xxhash64(*on)), F.lit(1))
    left = df.withColumn("_salt", F.when(parts > 1, spread_salt(df, parts)).otherwise(F.lit(0)))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return join(left, right, [*on, "_salt"], how).drop("_salt")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = MAX_BROADCAST_ROWS,
    null_safe: bool = False,
    staged: bool = False,
) -> DataFrame:
    """Join ``df`` to a lookup table with one row per key: inner, left, left_semi or left_anti.

    ``null_safe`` is for group keys: the null group then finds its row. ``staged``: the lookup is a
    staged table already.
    """
    lookup = lookup if staged else stage(lookup)
    small = collect_bounded(lookup, max_rows)
    if small is None:
        return skew_join(df, lookup, on, how, null_safe=null_safe)
    if null_safe:
        return keyed_join(df, F.broadcast(small), on, how)
    return df.join(F.broadcast(small), on, how)
