"""Every registered query against its SQL, on the smallest driver tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from scorewright import catalog
from tests.conftest import SF

ORACLES = catalog.ORACLES
ROWS_ONLY = {
    "logreg_fit", "logreg_fit_l1", "logreg_fit_unweighted", "coef_importance",
    "hyperparam_search", "local_surrogate", "objective", "predict_fn",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None)
    return x


def rows(table, names):
    data = zip(*[table.column(n).to_pylist() for n in names])
    return sorted((tuple(plain(x) for x in r) for r in data), key=lambda r: [(x is None, str(x)) for x in r])


def same(a, b):
    if isinstance(a, float) and isinstance(b, (int, float)):
        return a == b or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, duck, name):
    got, want = entry.queries()[name](spark, sf).toArrow(), duck.sql(ORACLES[name]).to_arrow_table()
    names = sorted(want.column_names)
    assert sorted(got.column_names) == names
    left, right = rows(got, names), rows(want, names)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(map(same, a, b)), (a, b)


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_every_query_is_covered():
    assert set(catalog.QUERIES) == set(ORACLES) | ROWS_ONLY
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark, sf):
    assert entry.entry(spark).count() == 2
