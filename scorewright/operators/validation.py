"""Declared constraints compiled to one aggregate pass plus an exploded violations listing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from scorewright.operators.joins import lookup_join


@dataclass(frozen=True)
class Check:
    """A row-level rule; nulls never violate it."""

    name: str
    ok: Callable[[Column], Column]

    def violated(self, value: Column) -> Column:
        return value.isNotNull() & ~F.coalesce(self.ok(value), F.lit(False))


def isin(*allowed) -> Check:
    return Check(f"isin({', '.join(map(str, allowed))})", lambda c: c.isin(*allowed))


def greater_than(bound) -> Check:
    return Check(f"greater_than({bound})", lambda c: c > bound)


def at_least(bound) -> Check:
    return Check(f"greater_than_or_equal_to({bound})", lambda c: c >= bound)


def at_most(bound) -> Check:
    return Check(f"less_than_or_equal_to({bound})", lambda c: c <= bound)


def non_empty() -> Check:
    return Check("length>0", lambda c: F.length(c) > 0)


def custom(name: str, predicate) -> Check:
    """User rule: a function from the column to a boolean Column."""
    return Check(name, predicate)


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    checks: tuple[Check, ...] = ()
    nullable: bool = False
    unique: bool = False
    required: bool = True


@dataclass(frozen=True)
class TableCheck:
    """A rule on the whole table (or group): ``value`` builds an aggregate Column."""

    name: str
    value: Callable[[], Column]
    ok: Callable[[Column], Column]


def min_rows(n: int) -> TableCheck:
    return TableCheck(f"min_rows({n})", lambda: F.count(F.lit(1)), lambda v: v >= n)


def min_rate(column: str, rate: float) -> TableCheck:
    return TableCheck(
        f"min_rate({column}, {rate})",
        lambda: F.avg(F.expr(f"try_cast(`{column}` AS double)")),
        lambda v: v >= rate,
    )


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...]
    table_checks: tuple[TableCheck, ...] = field(default=())

    def missing(self, df: DataFrame) -> list[str]:
        return [f.name for f in self.fields if f.required and f.name not in df.columns]

    def present(self, df: DataFrame) -> list[Field]:
        return [f for f in self.fields if f.name in df.columns]


class ValidationError(ValueError):
    pass


def coerced(f: Field) -> Column:
    return F.expr(f"try_cast(`{f.name}` AS {f.dtype})")


def rules(f: Field) -> list[tuple[str, Column]]:
    """(check name, violated?) for one field; value checks see the coerced value, and NaN is missing."""
    raw, value = F.col(f.name), coerced(f)
    out = [(f"dtype({f.dtype})", raw.isNotNull() & value.isNull())]
    if not f.nullable:
        missing = raw.isNull() | F.coalesce(F.isnan(value), F.lit(False)) if f.dtype in ("double", "float") else raw.isNull()
        out.append(("not_nullable", missing))
    out += [(c.name, c.violated(value)) for c in f.checks]
    return out


def missing_columns(df: DataFrame, schema: Schema) -> DataFrame:
    """Required columns absent from ``df``, as violation rows (a schema test, no scan)."""
    rows = [("DataFrameSchema", "", "column_in_dataframe", "", c, "") for c in schema.missing(df)]
    return df.sparkSession.createDataFrame(rows, VIOLATION_SCHEMA)


VIOLATION_SCHEMA = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in ("schema_context", "column", "check", "check_number", "failure_case", "index")
    ]
)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (partial counts absorb hot keys)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_counts(df: DataFrame, schema: Schema, keys: Sequence[str] = ()) -> DataFrame:
    """One pass: rows (keys, column, check, violations) for every row-level rule.

    Uniqueness needs a shuffle on the key and comes from ``duplicate_keys``.
    """
    named = [(f.name, name, cond) for f in schema.present(df) for name, cond in rules(f)]
    if not named:
        raise ValueError("schema has no column in common with the table")
    counts = df.groupBy(*keys).agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, _, cond) in enumerate(named)])
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.lit(n).alias("check"), F.col(f"_{i}").alias("violations")
            )
            for i, (c, n, _) in enumerate(named)
        ]
    )
    return counts.select(*keys, F.inline(pairs))


def table_check_results(df: DataFrame, schema: Schema, keys: Sequence[str] = ()) -> DataFrame:
    """Rows (keys, check, value, passed) for table-level rules, one aggregate for all."""
    checks = schema.table_checks
    values = df.groupBy(*keys).agg(*[c.value().alias(f"_{i}") for i, c in enumerate(checks)])
    pairs = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.col(f"_{i}").cast("double").alias("value"),
                F.coalesce(c.ok(F.col(f"_{i}")), F.lit(False)).alias("passed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return values.select(*keys, F.inline(pairs))


def violations(
    df: DataFrame, schema: Schema, row_key: Sequence[str], unique: bool = True
) -> DataFrame:
    """One row per broken row-level rule: six string columns. ``index`` is the row key as text, and of several
    columns their texts as a JSON list, so that neither nulls nor separators make two keys alike."""
    parts = [F.col(k).cast("string") for k in row_key]
    index = parts[0] if len(parts) == 1 else F.to_json(F.array(*parts))
    entries = []
    for f in schema.present(df):
        for i, (name, cond) in enumerate(rules(f)):
            entries.append(F.when(cond, violation(f.name, name, str(i), F.col(f.name), index)))
    listed = df.select(F.inline(F.array_compact(F.array(*entries))))
    uniques = [f for f in schema.present(df) if f.unique] if unique else []
    for f in uniques:
        dups = duplicate_keys(df, [f.name]).select(f.name)
        hits = lookup_join(df, dups, [f.name], "left_semi")
        listed = listed.unionByName(
            hits.select(F.inline(F.array(violation(f.name, "field_uniqueness", "", F.col(f.name), index))))
        )
    return listed


def violation(column: str, check: str, number: str, value: Column, index: Column) -> Column:
    return F.struct(
        F.lit("Column").alias("schema_context"),
        F.lit(column).alias("column"),
        F.lit(check).alias("check"),
        F.lit(number).alias("check_number"),
        F.coalesce(value.cast("string"), F.lit("null")).alias("failure_case"),
        index.alias("index"),
    )


def error_counts(df: DataFrame, schema: Schema, keys: Sequence[str] = ()) -> DataFrame:
    """All rules together: rows (keys, column, check, violations), zero counts included.

    ``keys`` evaluates the rules inside every group; uniqueness is then per group.
    """
    keys = list(keys)
    parts = [check_counts(df, schema, keys)]
    for f in schema.present(df):
        if f.unique:
            dups = df.groupBy(*keys, f.name).agg(F.count(F.lit(1)).alias("n"))
            parts.append(
                dups.groupBy(*keys).agg(
                    F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("violations")
                ).select(*keys, F.lit(f.name).alias("column"), F.lit("field_uniqueness").alias("check"), "violations")
            )
    if schema.table_checks:
        parts.append(
            table_check_results(df, schema, keys).select(
                *keys,
                F.lit("").alias("column"),
                "check",
                F.when(F.col("passed"), 0).otherwise(1).cast("long").alias("violations"),
            )
        )
    absent = schema.missing(df)
    if absent and not keys:
        parts.append(
            missing_columns(df, schema).select(
                F.col("failure_case").alias("column"), "check", F.lit(1).cast("long").alias("violations")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def summarize(counts: DataFrame, schema_name: str, keys: Sequence[str] = ()) -> DataFrame:
    """passed / schema_name / error_count / errors[] from the output of ``error_counts``."""
    broken = F.collect_list(
        F.when(F.col("violations") > 0, F.struct("column", "check", "violations"))
    )
    # at most one entry per declared rule
    return counts.groupBy(*keys).agg(
        (F.sum("violations") == 0).alias("passed"),
        F.lit(schema_name).alias("schema_name"),
        F.sum("violations").alias("error_count"),
        F.array_sort(broken).alias("errors"),
    )


def validate(
    df: DataFrame,
    schema: Schema,
    row_key: Sequence[str],
    keys: Sequence[str] = (),
    raise_on_error: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(summary, violations). With ``raise_on_error`` the summary runs now and may raise."""
    summary = summarize(error_counts(df, schema, keys), schema.name, keys)
    if raise_on_error:
        failed = summary.where(~F.col("passed")).agg(
            F.count(F.lit(1)).alias("groups"), F.sum("error_count").alias("errors")
        ).first()
        if failed["groups"]:
            raise ValidationError(
                f"Schema '{schema.name}' validation failed with {failed['errors']} error(s)"
            )
    return summary, violations(df, schema, row_key)


def row_passes(df: DataFrame, schema: Schema) -> Column:
    """True when no row-level rule is broken (uniqueness and table rules excluded)."""
    broken = [cond for f in schema.present(df) for _, cond in rules(f)]
    return ~reduce(lambda a, b: a | b, broken)


def quarantine(df: DataFrame, schema: Schema) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the names of the rules they break), no shuffle."""
    reasons = F.array_compact(
        F.array(
            *[
                F.when(cond, F.lit(f"{f.name}: {name}"))
                for f in schema.present(df)
                for name, cond in rules(f)
            ]
        )
    )
    tagged = df.withColumn("reasons", reasons)
    return (
        tagged.where(F.size("reasons") == 0).drop("reasons"),
        tagged.where(F.size("reasons") > 0),
    )


@dataclass(frozen=True)
class RequestField:
    """Default and case normalisation of a request column, applied before its checks."""

    name: str
    default: object = None
    case: str | None = None
    blank_is_missing: bool = False


def normalize_requests(df: DataFrame, fields: Sequence[RequestField]) -> DataFrame:
    out = {}
    for f in fields:
        c = F.col(f.name)
        if f.case:
            c = F.lower(c) if f.case == "lower" else F.upper(c)
        if f.blank_is_missing:
            c = F.nullif(c, F.lit(""))
        out[f.name] = F.coalesce(c, F.lit(f.default)) if f.default is not None else c
    return df.withColumns(out)


def batch_sizes(df: DataFrame, batch: Sequence[str], low: int = 1, high: int = 500) -> DataFrame:
    """Rows per request batch and whether the size is allowed."""
    return df.groupBy(*batch).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "size_ok", F.col("n_rows").between(low, high)
    )
