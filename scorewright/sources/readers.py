"""Readers with explicit schemas; unparsable rows are set aside, never dropped silently."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from scorewright.functions.columns import hash_normal, hash_uniform
from scorewright.operators.joins import lookup_join

CORRUPT = "_corrupt"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """(good rows tagged with ``source_file``, quarantined lines) of header CSV files."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    rows = (
        spark.read.schema(with_corrupt(text))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)
        .csv(paths if isinstance(paths, str) else list(paths))
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )
    # The scan converts only the columns a query selects, so types are cast here: a line is
    # judged on all its columns, whatever is selected later.
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema.fields}
    broken = F.col(CORRUPT).isNotNull()
    for name, value in typed.items():
        broken = broken | (F.col(name).isNotNull() & value.isNull())
    good = rows.where(~broken).select(*[v.alias(n) for n, v in typed.items()], "source_file")
    line = F.coalesce(CORRUPT, F.to_csv(F.struct(*typed)))
    return good, rows.where(broken).select(line.alias("line"), "source_file")


def parse_json_lines(lines: DataFrame, schema: T.StructType, keep: Sequence[str] = ()):
    """(good rows, quarantined lines) of a text column ``value``; blank lines are skipped."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.where(F.trim("value") != "").select(
        "value", *keep, F.from_json("value", with_corrupt(schema), options).alias("r")
    )
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    good = parsed.where(~broken).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], *keep)
    return good, parsed.where(broken).select(F.col("value").alias("line"), *keep)


def read_jsonl(
    spark: SparkSession, root: str, schema: T.StructType, pattern: str = "*.jsonl"
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined lines) of every matching file below ``root``."""
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(root)
        .select("value", F.col("_metadata.file_path").alias("source_file"))
    )
    return parse_json_lines(lines, schema, ["source_file"])


# One request/response log line.
REQUEST_LOG = T.StructType(
    [
        T.StructField(
            "request",
            T.StructType(
                [
                    T.StructField("body", T.MapType(T.StringType(), T.StringType())),
                    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
                ]
            ),
        ),
        T.StructField(
            "response",
            T.StructType([T.StructField("body", T.StructType([T.StructField("prediction", T.StringType())]))]),
        ),
    ]
)


def flatten_requests(
    logs: DataFrame, inputs: Sequence[str], header: str = "deployment", keep: Sequence[str] = ()
) -> DataFrame:
    """Request body fields, the predicted value and the deployment tag ('unknown' if absent)."""
    return logs.select(
        *keep,
        *[F.col("request.body")[c].alias(c) for c in inputs],
        F.col("response.body.prediction").alias("prediction"),
        F.coalesce(F.col("request.headers")[header], F.lit("unknown")).alias("deployment"),
    )


def flatten_json_column(df: DataFrame, column: str, fields: Sequence[str], keep: Sequence[str] = ()):
    """Fields of a JSON text column as strings; a value that is no object gives nulls."""
    parsed = F.from_json(F.col(column), T.MapType(T.StringType(), T.StringType()))
    return df.select(*keep, *[parsed[f].alias(f) for f in fields])


def yesterday(df: DataFrame, run_date: str, column: str = "event_date") -> DataFrame:
    """Rows of the day before ``run_date``; on a date-partitioned table only that folder is read."""
    return df.where(F.col(column) == F.date_sub(F.lit(run_date).cast("date"), 1))


def listed(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, folder, modified) of the files below ``root`` whose names match; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.col("modificationTime").alias("modified"))


def newest_path(spark: SparkSession, root: str, pattern: str = "*", by: str = "time", folder: bool = False) -> str:
    """The file below ``root`` that was changed last (``by='time'``, equal times by name) or comes last by
    name (``by='name'``); with ``folder`` the folder of files that it lies in, as Spark writes tables."""
    if by not in ("time", "name"):
        raise ValueError("by is 'time' or 'name'")
    files = listed(spark, root, pattern)
    what = "folder" if folder else "path"
    places = files.groupBy(what).agg(F.max("modified").alias("modified"))
    order = F.struct("modified", what) if by == "time" else F.col(what)
    got = places.agg(F.max_by(what, order).alias("path")).first()["path"]
    if got is None:
        raise FileNotFoundError(f"no file {pattern} below {root}")
    return got


def newest_version(spark: SparkSession, root: str, column: str = "version") -> str:
    """The largest value of a partition column, compared as an integer, from the folders' names alone."""
    value = F.regexp_extract("folder", f"/{column}=([^/]+)", 1)
    top = listed(spark, root, "[!._]*").select(value.alias("v")).agg(F.max_by("v", F.expr("try_cast(v AS BIGINT)")).alias("v")).first()["v"]
    if not top:
        raise FileNotFoundError(f"no partition of {column} below {root}")
    return top


def read_newest_version(spark: SparkSession, root: str, column: str = "version") -> DataFrame:
    """The rows of the newest version of a table partitioned by ``column``; only its folder is read."""
    return spark.read.parquet(root).where(F.col(column) == newest_version(spark, root, column))


def latest(df: DataFrame, version: str, keys: Sequence[str] = ()) -> DataFrame:
    """All rows of the newest version (compared as an integer), per group when keys are given."""
    number = F.expr(f"try_cast(`{version}` AS BIGINT)")
    newest = df.groupBy(*keys).agg(F.max(number).alias("_newest"))
    if keys:
        joined = lookup_join(df, newest, list(keys), null_safe=True)
        return joined.where(number == F.col("_newest")).drop("_newest")
    top = newest.first()["_newest"]
    return df.where(number == F.lit(top))


def newest_entry(registry: DataFrame, version: str, keys: Sequence[str] = ()) -> DataFrame:
    """The single newest registry row per group (partial maxima, no sort)."""
    rest = [c for c in registry.columns if c not in keys]
    number = F.expr(f"try_cast(`{version}` AS BIGINT)")
    best = F.max_by(F.struct(*rest), number)
    return registry.groupBy(*keys).agg(best.alias("_b")).select(*keys, "_b.*")


def reconstruct_reference(
    spark: SparkSession,
    stats: dict[str, dict],
    n: int = 500,
    seed: int = 42,
    label: str | None = None,
    positive_rate: float = 0.38,
    keep_id: bool = False,
) -> DataFrame:
    """Rows drawn from stored means and deviations when no reference table is kept.

    Draws are hashes of row number, feature and seed, the same for any number of partitions. Features
    without a mean are skipped; a missing deviation counts as 1.
    """
    rows = spark.range(n)
    for name, s in stats.items():
        if isinstance(s, dict) and s.get("mean") is not None:
            std = 1.0 if s.get("std") is None else s["std"]
            rows = rows.withColumn(name, hash_normal(["id", F.lit(name)], seed) * F.lit(float(std)) + F.lit(float(s["mean"])))
    if label:
        rows = rows.withColumn(label, (hash_uniform(["id", F.lit(label)], seed) < positive_rate).cast("int"))
    return rows if keep_id else rows.drop("id")
