"""Registry of queries bound to the driver's tables, and the frames they share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from scorewright.functions.columns import linear, sigmoid
from scorewright.operators.model import LogisticModel
from scorewright.session import stage_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared stage folder for sinks and streams."""
    return os.path.join(stage_root(spark), f"{name}-{uuid.uuid4().hex}")


ROW_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"]
KEY_SQL = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate)"


def key_hash_sql(seed: int, *parts: str) -> str:
    """The hash by which rows are drawn, over the given columns and the seed."""
    texts = [f"{p}::VARCHAR" for p in (*parts, f"'{seed}'")]
    return "md5(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, 'n')" for t in texts) + "))"


def key_column():
    return F.concat_ws("-", *[F.col(k).cast("string") for k in ROW_KEY])


# Fixed scorers, so that every number downstream of a score can be checked in SQL. The
# intercepts keep all margins away from zero, where engines may round apart.
CHAMPION = LogisticModel(("l_quantity", "l_discount", "l_tax"), (0.03, 9.0, 4.0), -1.405)
CHALLENGER = LogisticModel(("l_quantity", "l_discount", "l_tax"), (0.06, 24.0, 0.5), -2.8025)


def margin_sql(m: LogisticModel) -> str:
    terms = [f"{c}*{w!r}::DOUBLE" for c, w in zip(m.features, m.weights)]
    return " + ".join([f"({m.intercept!r})::DOUBLE", *terms])


def probability_sql(m: LogisticModel) -> str:
    return f"(1::DOUBLE / (1::DOUBLE + exp(-({margin_sql(m)}))))"


# The planted label: a linear signal plus deterministic noise in [0, 1).
NOISE_PRIME = 1009
Y_SQL = f"""(l_quantity/50::DOUBLE + l_discount*8::DOUBLE + (l_orderkey*7919 + l_partkey*104729 + l_suppkey*31
    + l_linenumber) % {NOISE_PRIME} / {NOISE_PRIME}::DOUBLE > 1.4::DOUBLE)::INT"""


def planted_label():
    signal = F.col("l_quantity") / F.lit(50.0) + F.col("l_discount") * F.lit(8.0)
    mix = F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729 + F.col("l_suppkey") * 31 + F.col("l_linenumber")
    return (signal + mix % NOISE_PRIME / F.lit(float(NOISE_PRIME)) > 1.4).cast("int")


def scored_lines(spark: SparkSession, sf: str, model: LogisticModel = CHAMPION) -> DataFrame:
    """lineitem with key, planted label y, score p (6 decimals) and prediction."""
    li = table(spark, sf, "lineitem")
    p = F.round(sigmoid(linear(dict(zip(model.features, model.weights)), model.intercept)), 6)
    return (
        li.withColumn("row_key", key_column())
        .withColumn("y", planted_label())
        .withColumn("p", p)
        .withColumn("prediction", (F.col("p") > 0.5).cast("int"))
    )


def scored_sql(m: LogisticModel = CHAMPION, name: str = "scored") -> str:
    """The same frame as a CTE."""
    return f"""{name} AS (
        SELECT *, (p > 0.5)::INT AS prediction FROM (
            SELECT *, {KEY_SQL} AS row_key, {Y_SQL} AS y, round({probability_sql(m)}, 6) AS p
            FROM lineitem))"""


SCORED = scored_sql()

# lineitem with planted nulls, text numbers and blanks.
RAW_SQL = f"""raw AS (
    SELECT *, {KEY_SQL} AS row_key,
        NULLIF(l_discount, 0::DOUBLE) AS discount,
        NULLIF(l_returnflag, 'A') AS flag,
        CASE WHEN l_quantity = 13 THEN 'thirteen' ELSE l_quantity::BIGINT::VARCHAR END AS quantity_text,
        CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN '' ELSE l_linestatus END AS status_text
    FROM lineitem)"""


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.withColumns(
        {
            "row_key": key_column(),
            "discount": F.nullif("l_discount", F.lit(0.0)),
            "flag": F.nullif("l_returnflag", F.lit("A")),
            "quantity_text": F.when(F.col("l_quantity") == 13, "thirteen").otherwise(
                F.col("l_quantity").cast("bigint").cast("string")
            ),
            "status_text": F.when(
                (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), ""
            ).otherwise(F.col("l_linestatus")),
        }
    )


# Reference rows before 1998, current rows after; the current side carries a planted shift.
CUT = "1998-01-01 00:00:00"


def periods(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    li = table(spark, sf, "lineitem")
    cut = F.lit(CUT).cast("timestamp_ntz")
    ref = li.where(F.col("l_shipdate") < cut)
    cur = li.where(F.col("l_shipdate") >= cut).withColumn(
        "l_extendedprice", F.col("l_extendedprice") * F.lit(1.1)
    ).withColumn(
        "l_returnflag",
        F.when((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 40), "R").otherwise(F.col("l_returnflag")),
    )
    return ref, cur


PERIODS_SQL = f"""ref AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}'),
cur AS (
    SELECT * REPLACE (l_extendedprice * 1.1::DOUBLE AS l_extendedprice,
        CASE WHEN l_returnflag = 'A' AND l_quantity > 40 THEN 'R' ELSE l_returnflag END AS l_returnflag)
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"""


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    """Documents scored by their length."""
    docs = table(spark, sf, "documents")
    z = F.col("n_chars").cast("double") / F.lit(1000.0) - F.lit(1.5)
    return (
        docs.select("doc_id", "lang", "source", "n_chars", F.round(sigmoid(z), 6).alias("probability"))
        .withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
    )


LOG_SQL = """log AS (
    SELECT *, (probability > 0.5)::INT AS prediction FROM (
        SELECT doc_id, lang, source, n_chars,
            round(1::DOUBLE / (1::DOUBLE + exp(-(n_chars::DOUBLE/1000::DOUBLE - 1.5::DOUBLE))), 6) AS probability
        FROM documents))"""


def late_label_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every label arrives twice; the toxic ones come back flipped."""
    lab = table(spark, sf, "labels")
    first = lab.select("doc_id", F.col("quality").alias("label"), F.lit(0).alias("arrival"))
    again = lab.select(
        "doc_id",
        F.when(F.col("toxic") == 1, 1 - F.col("quality")).otherwise(F.col("quality")).alias("label"),
        F.lit(1).alias("arrival"),
    )
    return first.unionByName(again)


ARRIVALS_SQL = """arrivals AS (
    SELECT doc_id, quality AS label, 0 AS arrival FROM labels
    UNION ALL
    SELECT doc_id, CASE WHEN toxic = 1 THEN 1 - quality ELSE quality END, 1 FROM labels),
newest AS (SELECT doc_id, label AS ground_truth FROM arrivals WHERE arrival = 1)"""
