import math

import pytest
from pyspark.sql import functions as F

from scorewright.functions import columns as C
from scorewright.operators import features as X
from scorewright.operators import joins
from scorewright.operators import splits as S


def values(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize(
    "age,band",
    [(0.0, "Adult"), (0.5, "Child"), (12.0, "Child"), (12.1, "Teenager"), (18.0, "Teenager"), (35.0, "Adult"),
     (60.0, "Middle-aged"), (100.0, "Senior"), (101.0, "Adult"), (None, "Adult")],
)
def test_age_band_edges(spark, age, band):
    df = spark.createDataFrame([(age,)], "a double")
    assert df.select(C.bin_right_closed("a", C.AGE_EDGES, C.AGE_LABELS, C.AGE_DEFAULT).alias("b")).first()["b"] == band


@pytest.mark.parametrize(
    "fare,band",
    [(0.0, "Q1"), (7.91, "Q1"), (7.92, "Q2"), (14.45, "Q2"), (31.0, "Q3"), (1000.0, "Q4"), (1000.1, "Q2"), (-1.0, "Q2")],
)
def test_fare_band_edges(spark, fare, band):
    df = spark.createDataFrame([(fare,)], "a double")
    assert df.select(C.bin_right_closed("a", C.FARE_EDGES, C.FARE_LABELS, C.FARE_DEFAULT).alias("b")).first()["b"] == band


def test_bins_need_matching_labels():
    with pytest.raises(ValueError):
        C.bin_right_closed("a", [0.0, 1.0], ["x", "y"])


def test_titles(spark):
    names = ["Braund, Mr. Owen", "X, Mlle. Y", "X, Ms. Y", "X, Mme. Y", "X, Dr. Y", "No title"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = values(df.select(C.remap(C.extract_first("n"), C.title_groups()).alias("t")), "t")
    assert got == ["Mr", "Miss", "Miss", "Mrs", "Rare", None]


def test_impute_median_and_mode_tie(spark):
    df = spark.createDataFrame(
        [(20.0, 10.0, "S", "C85"), (None, None, None, None), (30.0, 20.0, "C", None)],
        "Age double, Fare double, Embarked string, Cabin string",
    )
    medians, most = X.fit_impute(df, ["Age", "Fare"], ["Embarked"])
    assert medians == {"Age": 25.0, "Fare": 15.0} and most == {"Embarked": "C"}
    filled = X.impute(df.drop("Cabin"), medians, most)
    assert [tuple(r) for r in filled.collect()] == [(20.0, 10.0, "S"), (25.0, 15.0, "C"), (30.0, 20.0, "C")]


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    medians, _ = X.fit_impute(df, ["a", "b"], [])
    assert medians == {"b": 2.0}


def test_five_passengers(five):
    spec = X.passenger_spec()
    state = X.fit(five, spec)
    assert state.medians == {"Age": 35.0, "Fare": 8.05}
    ready = X.prepare(five, spec, state, ["PassengerId"]).orderBy("PassengerId").collect()
    assert [r["FamilySize"] for r in ready] == [2, 2, 1, 2, 1]
    assert [r["IsAlone"] for r in ready] == [0, 0, 1, 0, 1]
    assert [r["Sex"] for r in ready] == [1, 0, 0, 0, 1]
    assert [r["Title"] for r in ready] == [0] * 5  # no title anywhere: the single class 'nan'
    assert [r["Embarked"] for r in ready] == [1, 0, 1, 1, 1]
    scaled = X.apply(five, spec, state)
    assert scaled.columns == list(spec.select)
    for c in spec.select:
        column = values(scaled, c)
        assert abs(sum(column)) < 1e-9
        spread = math.sqrt(sum(v * v for v in column) / 5)
        assert spread == pytest.approx(1.0) or spread == 0.0


def test_unseen_category_gets_lowest_class(five):
    vocab = X.fit_vocab(five, ["Sex"])
    odd = five.withColumn("Sex", F.when(F.col("PassengerId") == 1, "unseen").otherwise(F.col("Sex")))
    assert values(X.encode(odd, vocab, ["Sex"]).orderBy("PassengerId"), "Sex") == [0, 0, 0, 0, 1]


def test_vocabulary_order_is_the_same_for_ranged_sums(spark, monkeypatch):
    from scorewright.operators import ordered

    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("v"), (F.col("id") % 7).cast("string").alias("w"))
    plain = {(r[0], r[1]): r[2] for r in X.fit_vocab(df, ["v", "w"]).collect()}
    monkeypatch.setattr(ordered, "SMALL_ROWS", 10)
    ranged = {(r[0], r[1]): r[2] for r in X.fit_vocab(df, ["v", "w"]).collect()}
    assert plain == ranged
    assert [v for (f, v), _ in sorted(plain.items(), key=lambda kv: kv[1]) if f == "w"] == list("0123456")


def test_state_round_trip(spark, five, tmp_path):
    from scorewright.sources import writers

    spec = X.passenger_spec()
    state = X.fit(five, spec)
    writers.save_state(state, spark, str(tmp_path / "s"))
    again = writers.load_state(spark, str(tmp_path / "s"))
    assert (again.medians, again.modes, again.means, again.stds) == (state.medians, state.modes, state.means, state.stds)
    before = X.apply(five, spec, state, ["PassengerId"]).orderBy("PassengerId").collect()
    assert X.apply(five, spec, again, ["PassengerId"]).orderBy("PassengerId").collect() == before


def test_split_is_exact_and_repartition_invariant(many):
    counts = many.groupBy("Survived").count().collect()
    split = S.split(many, ["PassengerId"], 0.2, 42, ["Survived"])
    got = {(r["Survived"], r["split"]): r["count"] for r in split.groupBy("Survived", "split").count().collect()}
    for r in counts:
        assert got[(r["Survived"], "test")] == math.floor(0.2 * r["count"] + 0.5)
        assert got[(r["Survived"], "train")] + got[(r["Survived"], "test")] == r["count"]
    other = S.split(many.repartition(13), ["PassengerId"], 0.2, 42, ["Survived"])
    key = lambda df: sorted(df.select("PassengerId", "split").collect())
    assert key(split) == key(other)


def test_ab_split(many):
    count = lambda df: {r[0]: r[1] for r in df.groupBy("model_variant").count().collect()}
    assert count(S.assign_ab(many, ["PassengerId"], 0.1)) == {"challenger": 55, "champion": 495}
    assert count(S.assign_ab(many, ["PassengerId"], 0.1, enabled=False)) == {"champion": 550}
    assert count(S.assign_ab(many, ["PassengerId"], 0.0)) == {"champion": 550}
    assert count(S.assign_ab(many, ["PassengerId"], 1.0)) == {"challenger": 550}


def test_canary_weights():
    assert S.canary_weights("v2", "v1") == {"v2": 10, "v1": 90}
    assert S.canary_weights("v2", None) == {"v2": 100} == S.canary_weights("v2", "v2")
    with pytest.raises(ValueError):
        S.assign_weighted(None, ["k"], {"a": 50})


def test_split_of_empty_table(many):
    empty = many.where("PassengerId < 0")
    assert S.split(empty, ["PassengerId"], 0.2, 42, ["Survived"]).count() == 0
    assert S.sample_fraction(empty, ["PassengerId"]).count() == 0


def test_lookup_join_paths_agree(spark):
    big = spark.range(20000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k")
    )
    look = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        near = joins.lookup_join(big, look, ["k"], how)
        far = joins.lookup_join(big, look, ["k"], how, max_rows=10)
        order = lambda df: sorted(df.select("id", *(["v"] if "v" in df.columns else [])).collect(), key=str)
        assert order(near) == order(far), how
    # the third of all rows that share key 7, cut by its bytes; a key of 0.9% too, if a task is to take less
    assert list(joins.hot_keys(big, ["k"], 50_000).values()) == [4]
    assert joins.hot_keys(big, ["k"]) == {} and len(joins.hot_keys(big.where("k <> 7 OR id < 360"), ["k"], 2_000)) == 1
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    for how in ("left", "inner", "left_semi", "left_anti"):
        assert order(joins.skew_join(big, look, ["k"], how, 2_000).select("id")) == order(big.join(look, "k", how).select("id"))


def test_exact_copies_are_salted_apart(spark):
    copies = spark.range(1000).repartition(8).select(F.lit(7).alias("k"))
    salted = copies.withColumn("s", joins.spread_salt(copies, F.lit(32)))
    assert salted.select("s").distinct().count() > 1


def test_splits_are_the_same_at_every_level_of_refinement(spark, monkeypatch):
    rows = spark.range(3000).select("id", (F.col("id") % 7 == 0).alias("s"), F.lit(None).cast("string").alias("none"))
    marked = lambda: {r["id"] for r in S.split(rows, ["id", "none"], 0.2, 42, ["s"]).where("split = 'test'").collect()}
    at_once = marked()
    monkeypatch.setattr(S, "DIGITS", 1)
    monkeypatch.setattr(S, "RANKED_ROWS", 3)
    assert marked() == at_once and len(at_once) == 86 + 514


def test_keys_with_nulls_and_separators_are_told_apart(spark):
    from scorewright.functions.columns import hash_hex

    rows = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), (None, "a"), ("a", None), (None, None), ("n", "n"), ("", ""), ("1:a", "")], "x string, y string")
    assert rows.select(hash_hex(["x", "y"], 42)).distinct().count() == 8
