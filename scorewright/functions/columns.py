"""Scalar building blocks that return Columns and stay inside generated code."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Salutations folded into one class, and spelling variants.
RARE_TITLES = [
    "Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona",
]
TITLE_VARIANTS = {"Mlle": "Miss", "Ms": "Miss", "Mme": "Mrs"}
TITLE_PATTERN = r" ([A-Za-z]+)\."

# Right-closed bin edges, labels, and the label for anything outside.
AGE_EDGES = [0.0, 12.0, 18.0, 35.0, 60.0, 100.0]
AGE_LABELS = ["Child", "Teenager", "Adult", "Middle-aged", "Senior"]
AGE_DEFAULT = "Adult"
FARE_EDGES = [-0.001, 7.91, 14.45, 31.0, 1000.0]
FARE_LABELS = ["Q1", "Q2", "Q3", "Q4"]
FARE_DEFAULT = "Q2"

MISSING_TOKEN = "nan"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_nan(c: str | Column) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def extract_first(c: str | Column, pattern: str = TITLE_PATTERN) -> Column:
    """First capture of ``pattern``, null when it does not match."""
    return F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))


def remap(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values; all others pass through."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), col(c)), col(c)) if pairs else col(c)


def title_groups() -> dict[str, str]:
    return {**{t: "Rare" for t in RARE_TITLES}, **TITLE_VARIANTS}


def bin_right_closed(
    c: str | Column, edges: Sequence[float], labels: Sequence[str], default: str | None = None
) -> Column:
    """Label of the bin (a, b] holding the value; outside or null gives ``default``."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need exactly one more edge than labels")
    value = col(c)
    branches = zip(edges[1:], labels)
    first_edge, first_label = next(branches)
    chain = F.when(value <= edges[0], F.lit(None)).when(value <= first_edge, first_label)
    for edge, label in branches:
        chain = chain.when(value <= edge, label)
    return F.coalesce(chain, F.lit(default))


def total_plus_one(*cs: str | Column) -> Column:
    return reduce(lambda a, b: a + b, map(col, cs)) + F.lit(1)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (null counts as 0)."""
    return F.when(condition, 1).otherwise(0)


def label_text(c: str | Column, positive: str, negative: str) -> Column:
    return F.when(col(c) == 1, positive).otherwise(negative)


def scored_line(key, prediction, probability, label) -> Column:
    """``id,prediction,probability(4 decimals),label``."""
    fixed = F.regexp_replace(F.format_number(col(probability), 4), ",", "")
    return F.concat_ws(
        ",", col(key).cast("string"), col(prediction).cast("string"), fixed, col(label)
    )


def key_text(parts: Sequence[str | Column | int]) -> Column:
    """One text for several parts that no other parts give: each part as its length and itself, null as 'n'."""
    texts = [F.lit(str(p)) if isinstance(p, int) else col(p).cast("string") for p in parts]
    return F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts])


def hash_hex(keys: Sequence[str | Column], seed: int | str) -> Column:
    """Uniform, engine-independent 128-bit hex rank of a row key."""
    return F.md5(key_text([*keys, F.lit(str(seed))]))


def _word(hex32: Column, k: int) -> Column:
    """The k-th group of eight hex digits as a long."""
    return F.conv(F.substring(hex32, 1 + 8 * k, 8), 16, 10).cast("long")


def hash_uniform(keys: Sequence[str | Column], seed: int | str) -> Column:
    """Deterministic uniform draw in [0, 1) with 32 bits."""
    return _word(hash_hex(keys, seed), 0).cast("double") / F.lit(2.0**32)


def hash_normal(keys: Sequence[str | Column], seed: int | str) -> Column:
    """Deterministic standard normal draw (Box-Muller on two 32-bit groups of one hash)."""
    bits = hash_hex(keys, seed)
    u = (_word(bits, 0).cast("double") + 0.5) / F.lit(2.0**32)
    v = _word(bits, 1).cast("double") / F.lit(2.0**32)
    return F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2.0 * math.pi) * v)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum of weight * column, in the mapping's order."""
    terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(float(intercept)))


def row_id(keys: Sequence[str | Column], run_id: str) -> Column:
    """Deterministic row id: re-running a job yields the same ids. The parts are hashed as a JSON list, so
    neither a null part nor a separator inside one makes two keys alike."""
    return F.sha2(F.to_json(F.array(*[col(k).cast("string") for k in keys], F.lit(run_id))), 256)


def truncated_json(struct: Column, limit: int | None = None) -> Column:
    """The struct as JSON, whole unless the caller asks for a shortened display text."""
    text = F.to_json(struct)
    return text if limit is None else F.substring(text, 1, limit)
