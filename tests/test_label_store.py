"""Labels written back to the stored log: newest arrival wins, replays and broken compactions are harmless."""

import datetime

import pytest
from pyspark.sql import functions as F

from scorewright.operators import feedback as FB, label_store as LS

RUNS = [(1, "x", 1), (2, "y", 0), (2, "y again", 1), (3, "z", 1), (None, "no key", 0)]


def day(n):
    return F.lit(f"2024-03-{n:02d}T00:00:00Z").cast("timestamp")


@pytest.fixture
def store(spark, tmp_path):
    root = str(tmp_path / "store")
    frame = spark.createDataFrame(RUNS, "id long, note string, prediction int")
    for run in ("1", "2", "1"):  # a run logged again replaces itself; numbers stay names
        LS.log_run(frame, root, ["id", "note"], run, "id", buckets=4)
    return root


def submit(spark, root, rows, batch, at):
    LS.submit(spark.createDataFrame(rows, "id long, label int, n int"), root, "id", "label", batch, day(at), ["n"], buckets=4)


def state(df, run="1"):
    rows = df.where(F.col("run_id") == run).collect()
    return {r["note"]: (r["ground_truth"], r["feedback_received"], r["feedback_received_at"] and r["feedback_received_at"].day) for r in rows}


def test_nothing_submitted(spark, store):
    assert state(LS.read_log(spark, store, "id")) == {n: (None, False, None) for _, n, _ in RUNS}
    assert LS.updated(spark, store, "id") == 0 and LS.compact(spark, store, "id", "none") == 0


def test_the_newest_arrival_wins_before_and_after_compaction(spark, store):
    submit(spark, store, [(1, 0, 1), (1, 1, 2), (2, 0, 1), (77, 1, 1), (None, 1, 1), (3, None, 1)], "a", 5)
    submit(spark, store, [(2, 1, 1)], "b", 9)
    submit(spark, store, [(1, 0, 1), (2, 0, 1)], "older", 2)
    want = {"x": (1, True, 5), "y": (1, True, 9), "y again": (1, True, 9), "z": (None, False, None), "no key": (None, False, None)}
    assert LS.updated(spark, store, "id") == 6
    assert state(LS.read_log(spark, store, "id")) == want == state(LS.read_log(spark, store, "id"), "2")
    assert LS.compact(spark, store, "id", "one") > 0
    assert state(LS.stored_log(spark, store)) == want and LS.updated(spark, store, "id") == 0
    assert LS.stored_log(spark, store).count() == 2 * len(RUNS)
    # An older label after the fold changes nothing, a newer one does.
    submit(spark, store, [(1, 0, 1)], "late but old", 4)
    assert state(LS.read_log(spark, store, "id")) == want
    submit(spark, store, [(3, 1, 1), (1, 0, 1)], "new", 11)
    assert state(LS.read_log(spark, store, "id")) == {**want, "x": (0, True, 11), "z": (1, True, 11)}
    LS.compact(spark, store, "id", "two")
    assert state(LS.stored_log(spark, store)) == {**want, "x": (0, True, 11), "z": (1, True, 11)}
    assert LS.waiting_batches(spark, store) == []


def test_a_broken_compaction_goes_on_from_its_copy(spark, store, monkeypatch):
    submit(spark, store, [(1, 1, 1), (2, 0, 1)], "a", 5)
    whole = LS._overwrite

    def breaks(df, path, by):
        if path.endswith("log"):
            raise RuntimeError("lost")
        whole(df, path, by)

    monkeypatch.setattr(LS, "_overwrite", breaks)
    with pytest.raises(RuntimeError):
        LS.compact(spark, store, "id", "one")
    monkeypatch.setattr(LS, "_overwrite", whole)
    submit(spark, store, [(3, 1, 1)], "meanwhile", 6)
    LS.compact(spark, store, "id", "one")
    assert state(LS.stored_log(spark, store))["x"] == (1, True, 5)
    assert state(LS.stored_log(spark, store))["z"] == (None, False, None) and LS.waiting_batches(spark, store) == ["meanwhile"]
    assert state(LS.read_log(spark, store, "id"))["z"] == (1, True, 6)
    LS.compact(spark, store, "id", "one")  # once more changes nothing
    assert state(LS.stored_log(spark, store))["y"] == (0, True, 5) and LS.stored_log(spark, store).count() == 2 * len(RUNS)


def test_only_touched_partitions_are_rewritten(spark, store, tmp_path):
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "store" / "log").rglob("*.parquet")}
    before = files()
    submit(spark, store, [(1, 1, 1)], "a", 5)
    assert LS.compact(spark, store, "id", "one") == 2  # one bucket in both runs
    after = files()
    touched = {p.parent for p in after if before.get(p) != after[p]}
    assert len(touched) == 2 and sum(p in after for p in before) == len(before) - 2


def test_coverage_has_a_row_for_a_group_without_a_log(spark):
    joined = spark.createDataFrame([("a", True), ("a", False), (None, False)], "g string, feedback_received boolean")
    at = F.lit(datetime.datetime(2024, 1, 1))
    got = {r["g"]: r for r in FB.coverage(joined, ["g"], at, spark.createDataFrame([("a",), ("b",), (None,)], "g string")).collect()}
    assert {k: (r["total_predictions"], r["feedback_received"], r["coverage_percent"]) for k, r in got.items()} == {"a": (2, 1, 50.0), "b": (0, 0, 0.0), None: (1, 0, 0.0)}
    assert got["b"]["message"] == FB.NOTHING_LOGGED and got["a"]["message"] is None and got["b"]["timestamp"] == datetime.datetime(2024, 1, 1)
    nothing = FB.coverage(joined.where("false")).collect()
    assert len(nothing) == 1 and nothing[0]["coverage_fraction"] == 0 and nothing[0]["message"] == FB.NOTHING_LOGGED
