import math
import statistics

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window, functions as F

from scorewright.operators import ordered as O


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(7)
    hot = [("hot", float(round(v, 2))) for v in rng.normal(0, 3, 9000)]
    cold = [(f"g{int(i)}", float(v)) for i, v in zip(rng.integers(0, 40, 3000), rng.integers(0, 50, 3000))]
    ties = [("ties", 1.0)] * 5000 + [("ties", 2.0)]
    one = [("one", 4.0), ("nulls", None)]
    return spark.createDataFrame(hot + cold + ties + one, "g string, v double").repartition(6).cache()


def by_group(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["g"], []).append(r)
    return out


def plain_sums(counts, order, values, keys):
    """The same by one window per group."""
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    walk, beside = group.orderBy(*order), F.struct(*order, *values)
    run = walk.rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        "*", *[F.sum(v).over(run).alias(f"cum_{v}") for v in values], *[F.sum(v).over(group).alias(f"total_{v}") for v in values],
        F.lag(beside).over(walk).alias("prev"), F.lead(beside).over(walk).alias("next"),
    )


def same_rows(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda df: sorted((tuple(r[c] for c in sorted(a.columns)) for r in df.collect()), key=str)
    assert rows(a) == rows(b)


@pytest.mark.parametrize("coalesce", ["true", "false"])
@pytest.mark.parametrize("keys", [["g"], []])
def test_scanned_sums_equal_plain_sums(spark, numbers, keys, coalesce):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        counts = numbers.where("v IS NOT NULL").groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(0.5)).alias("x"))
        same_rows(O.prefix_sum(counts, ["v"], ["n", "x"], keys), plain_sums(counts, ["v"], ["n", "x"], keys))
        if coalesce == "false":
            pids = O.stage(counts.repartitionByRange(*keys, "v").withColumn("p", F.spark_partition_id()))
            assert pids.select("p").distinct().count() > 1
        same_rows(O.prefix_sum(counts.where("false"), ["v"], ["n", "x"], keys), plain_sums(counts.where("false"), ["v"], ["n", "x"], keys))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_scan_tells_null_and_nan_keys_apart(spark):
    nan = float("nan")
    rows = [(None, 1.0, 2), (None, 2.0, 3), (nan, 1.0, 5), (nan, 4.0, 7), (0.0, 1.0, 11), (1.0, None, 13), (1.0, 3.0, 17)]
    counts = spark.createDataFrame(rows, "g double, v double, n long").repartition(3)
    got = {(str(r["g"]), r["v"]): (r["cum_n"], r["total_n"]) for r in O.prefix_sum(counts, ["v"], ["n"], ["g"]).collect()}
    assert got == {
        ("None", 1.0): (2, 5), ("None", 2.0): (5, 5), ("nan", 1.0): (5, 12), ("nan", 4.0): (12, 12), ("0.0", 1.0): (11, 11), ("1.0", None): (13, 30), ("1.0", 3.0): (30, 30),
    }


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_bracket_quantiles_match_numpy(numbers, monkeypatch, accuracy):
    monkeypatch.setattr(O, "SKETCH_ACCURACY", accuracy)
    qs = (0.5, 0.25, 0.75, 0.01, 0.99)
    got = {r["g"]: r for r in O.quantiles(numbers, ["v"], qs, ["g"], buffer_rows=0).collect()}
    data = {}
    for r in numbers.where("v IS NOT NULL").collect():
        data.setdefault(r["g"], []).append(r["v"])
    assert set(got) == set(data)
    for g, vs in data.items():
        for q in qs:
            assert got[g][O.quantile_name(q)] == pytest.approx(np.quantile(vs, q), abs=1e-9), (g, q)


def test_builtin_quantiles_match_brackets(numbers):
    near = sorted(O.quantiles(numbers, ["v"], (0.5, 0.9), ["g"]).collect())
    far = sorted(O.quantiles(numbers, ["v"], (0.5, 0.9), ["g"], buffer_rows=0).collect())
    assert [r[:2] for r in near] == [r[:2] for r in far]
    for a, b in zip(near, far):
        assert a[2] == pytest.approx(b[2]) and a[3] == pytest.approx(b[3])


def test_median_of_two(spark):
    df = spark.createDataFrame([(1.0,), (4.0,)], "v double")
    for rows in (10, 0):
        assert O.quantiles(df, ["v"], (0.5,), buffer_rows=rows).first()["median"] == 2.5


def test_mode_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert O.modes(df, ["v"]).first()["mode"] == "a"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    assert O.quantiles(df, ["v"], (0.5,)).first()["median"] == 2.0
    assert O.quantiles(df, ["v"], (0.5,), buffer_rows=0).first()["median"] == 2.0
    assert math.isclose(statistics.median([1.0, 3.0]), 2.0)


@pytest.fixture(scope="module")
def gaps(spark):
    """Three groups, one of them null."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("g"),
        F.pmod(F.hash("id"), F.lit(500)).cast("double").alias("v"),
    )


def test_null_group_keys(spark, gaps):
    from scorewright.operators import drift as D
    from scorewright.operators import profile as P
    from scorewright.operators import splits as S

    order = lambda df, cols: sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = gaps.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
        cols = ["g", "v", "cum_n", "total_n", "prev", "next"]
        assert order(O.prefix_sum(counts, ["v"], ["n"], ["g"]), cols) == order(plain_sums(counts, ["v"], ["n"], ["g"]), cols)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    near = O.quantiles(gaps, ["v"], (0.5,), ["g"])
    assert near.count() == 3
    assert order(near, ["g", "median"]) == order(O.quantiles(gaps, ["v"], (0.5,), ["g"], buffer_rows=0), ["g", "median"])
    profile = P.profile_numeric(gaps, ["v"], ["g"])
    assert profile.count() == 3 and profile.where("median IS NULL").count() == 0
    rows = gaps.withColumn("id", F.monotonically_increasing_id())
    picked = S.split(rows, ["id"], 0.2, 1, ["g"]).where("split = 'test'").groupBy("g").count().collect()
    assert sorted(r["count"] for r in picked) == [200, 200, 200]
    assert D.mean_shift(gaps, gaps, ["v"], ["g"]).count() == 3


@pytest.mark.parametrize("limit", [{"SMALL_ROWS": 7}, {"SMALL_BYTES": 1}])
def test_a_scan_holds_small_ranges_only(spark, numbers, monkeypatch, limit):
    for name, value in limit.items():
        monkeypatch.setattr(O, name, value)
    held = list(O._small_ranges(iter([pa.RecordBatch.from_pydict({"a": list(range(k, k + 10))}) for k in (0, 10, 20)]), O.SMALL_ROWS, O.SMALL_BYTES))
    assert [x for part in held for b in part for x in b.column("a").to_pylist()] == list(range(30))
    assert [sum(b.num_rows for b in part) for part in held] == ([7, 7, 7, 7, 2] if "SMALL_ROWS" in limit else [10, 10, 10])
    counts = numbers.where("v IS NOT NULL").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(0.5)).alias("x")).coalesce(1)
    for keys in (["g"], []):
        mine = counts if keys else counts.groupBy("v").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        same_rows(O.prefix_sum(mine, ["v"], ["n", "x"], keys), plain_sums(mine, ["v"], ["n", "x"], keys))
