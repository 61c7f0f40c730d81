"""Escape hatches for user Python functions; built-in expressions are always the first choice."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F


def elementwise(fn: Callable, returns: str):
    """A vectorised UDF of a function on one value. ``fn`` runs once per distinct value of an
    Arrow batch; null goes in as None."""

    @F.pandas_udf(returns)
    def run(values: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(values)
        answers = [fn(v) for v in distinct] + [fn(None) if (codes < 0).any() else None]
        return pd.Series([answers[i] for i in codes], dtype=object)

    return run
