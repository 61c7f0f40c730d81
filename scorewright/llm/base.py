"""Registry and small column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


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


def words(text: Column) -> Column:
    """Array of the words of a text; none for null and for blanks only."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def boxed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct column ``row``, so that no name of theirs meets one of an operator's."""
    return docs.select(F.struct("*").alias("row")) if docs.columns else docs.select(F.struct().alias("row"))


def field(name: str) -> Column:
    """A field of the boxed row."""
    return F.col("row").getField(name)


def unboxed(df: DataFrame, names: list[str], added: dict[str, Column] | None = None) -> DataFrame:
    """The boxed row's columns ``names`` in order, those in ``added`` replaced in place, the others of ``added``
    behind them."""
    added = added or {}
    place = {n: f"added_{i}" for i, n in enumerate(added)}
    # Values first, names after: inside a lambda a name might else mean an alias of the same list.
    df = df.select("row", *[c.alias(place[n]) for n, c in added.items()])
    kept = [(F.col(place[n]) if n in added else field(n)).alias(n) for n in names]
    return df.select(*kept, *[F.col(place[n]).alias(n) for n in added if n not in names])


def word_count(text: Column) -> Column:
    """Number of words, as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
