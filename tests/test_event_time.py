"""Event-time state: the rows that come out do not depend on how the input is cut into batches."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from scorewright.operators import drift as D
from scorewright.streaming import jobs as J, windows as W

FAR = datetime.datetime(2200, 1, 1)
DAY = datetime.datetime(2024, 5, 1)


def at(minutes):
    return DAY + datetime.timedelta(minutes=minutes)


def fed(spark, root, parts, schema, make, run):
    """Appends each part and runs the stream that ``make`` builds over all of them."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        run(make(spark.readStream.schema(schema).parquet(f"{root}/in")))


ROWS = "id long, ts timestamp, v string"
COPIES = [(1, at(0), "b"), (1, at(0), "a"), (1, at(50), "c"), (1, at(100), "d"), (1, at(400), "e"), (2, at(10), "x"), (2, at(80), "y")]


@pytest.mark.parametrize("keep", ["earliest", "newest"])
@pytest.mark.parametrize("cut", [0, 3, 5])
def test_survivors_do_not_depend_on_batches(spark, tmp_path, cut, keep):
    rows = sorted(COPIES, key=lambda r: r[1])
    random.Random(cut).shuffle(rows[:2])
    parts = [p for p in (rows[:cut], rows[cut:], [(-1, FAR, "close")]) if p]
    run = lambda s: J.run_to_table(s, f"{tmp_path}/out", f"{tmp_path}/cp")
    fed(spark, tmp_path, parts, ROWS, lambda s: W.dedupe(s, ["id"], "ts", within="1 hour", late="10 hours", keep=keep), run)
    got = {tuple(r) for r in spark.read.schema(ROWS).parquet(f"{tmp_path}/out").where("id > 0").collect()}
    want = {"earliest": {(1, at(0), "a"), (1, at(400), "e"), (2, at(10), "x"), (2, at(80), "y")},
            "newest": {(1, at(100), "d"), (1, at(400), "e"), (2, at(10), "x"), (2, at(80), "y")}}
    assert got == want[keep]
    with pytest.raises(ValueError):
        W.dedupe(spark.createDataFrame([], ROWS), ["id"], "ts", keep="any")


PREDS, LABELS = "key string, pred_ts timestamp, p double, note string", "label_key string, label_ts timestamp, label int"
PRED_ROWS = [("a", at(0), 0.25, None), ("b", at(0), None, "x"), ("c", at(0), 0.5, "y"), ("d", at(0), 0.5, "z"), (None, at(0), 1.0, "no key"), ("c", at(0), 0.5, "y")]
LABEL_ROWS = [
    ("a", at(5), 1), ("a", at(9), 0),  # the later one wins, whichever comes first
    ("b", at(60 * 24 * 2), 1),  # after the wait
    ("c", at(7), 1), ("c", at(7), 2),  # a tie goes by the label's columns
    ("nobody", at(3), 1), (None, at(3), 1),
]
FAR_PRED, FAR_LABEL = ("far", FAR, None, None), ("far", FAR, None)


@pytest.mark.parametrize("order", ["together", "labels first", "labels apart", "newest first"])
def test_last_label_wins_in_any_order(spark, tmp_path, order):
    def write(preds, labels):
        spark.createDataFrame(preds, PREDS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/preds")
        spark.createDataFrame(labels, LABELS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/labels")
        joined = W.late_labels(
            spark.readStream.schema(PREDS).parquet(f"{tmp_path}/preds"), spark.readStream.schema(LABELS).parquet(f"{tmp_path}/labels"),
            "key", "pred_ts", "label_key", "label_ts", wait="1 day", late="3 days",
        )
        J.run_to_table(joined, f"{tmp_path}/out", f"{tmp_path}/cp")
        return joined.schema

    steps = {
        "together": [(PRED_ROWS, LABEL_ROWS)],
        "labels first": [([], LABEL_ROWS), (PRED_ROWS, [])],
        "labels apart": [(PRED_ROWS, []), *[([], [r]) for r in LABEL_ROWS[:2]], ([], LABEL_ROWS[2:])],
        "newest first": [(PRED_ROWS, LABEL_ROWS[::-1][:6]), ([], LABEL_ROWS[:1])],
    }[order]
    for preds, labels in steps:
        write(preds, labels)
    schema = write([FAR_PRED], [FAR_LABEL])
    got = {tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/out").where("key <> 'far'").collect()}
    assert got == {
        ("a", at(0), 0.25, None, "a", at(9), 0), ("b", at(0), None, "x", None, None, None),
        ("c", at(0), 0.5, "y", "c", at(7), 2), ("d", at(0), 0.5, "z", None, None, None),
    }


def test_late_rows_are_kept_aside_and_replays_replace_them(spark, tmp_path):
    parts = [[(1, at(600), "on time"), (2, None, "no time")], [(3, at(500), "late"), (4, at(541), "on time"), (5, at(900), "on time")], [(6, at(800), "late")]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, ROWS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        W.part_late(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in"), "ts", "1 hour", f"{tmp_path}/parted", f"{tmp_path}/cp")
    # The last batch once more, as after a failure before its commit.
    commits = sorted((tmp_path / "cp" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for path in (tmp_path / "cp" / "commits").glob(f"*{commits[-1].name}*"):
        path.unlink()
    W.part_late(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in"), "ts", "1 hour", f"{tmp_path}/parted", f"{tmp_path}/cp")
    schema = spark.createDataFrame([], ROWS).schema
    got = sorted((r["id"], r["is_late"]) for r in W.parted_rows(spark, f"{tmp_path}/parted", schema).collect())
    assert got == [(1, False), (2, True), (3, True), (4, False), (5, False), (6, True)]
    streamed = W.stream_on_time(spark, f"{tmp_path}/parted", schema)
    progress = J.run_to_table(streamed.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["id"]), f"{tmp_path}/out", f"{tmp_path}/cp2")
    assert J.late_rows_dropped(progress) == 0
    assert sorted(r["id"] for r in spark.read.schema(ROWS).parquet(f"{tmp_path}/out").collect()) == [1, 4, 5]


def test_each_window_is_reported_once_from_all_its_batches(spark, tmp_path):
    schema = "ts timestamp, value double, kind string, shop string"
    rng = random.Random(4)
    ref = [(at(0), rng.gauss(0, 1), rng.choice("ab"), s) for s in "pq" for _ in range(200)]
    cur = [(at(60 * 24 * d + m), rng.gauss(d, 1), rng.choice("abb"), s) for d in (1, 2) for m in range(0, 1440, 10) for s in "pq"]
    cur += [(at(60 * 24 + 5), float("nan"), None, "p")]
    cur.sort(key=lambda r: r[0])
    reference = W.reference_counts(spark.createDataFrame(ref, schema), ["value"], ["kind"], ["shop"])
    parts = [cur[:100], cur[100:350], cur[350:400], cur[400:], [(FAR, None, None, None)]]

    def run(counts):
        W.monitor_closed_windows(counts, reference, ["value"], f"{tmp_path}/counts", f"{tmp_path}/reports", f"{tmp_path}/cp", keys=["shop"])

    fed(spark, tmp_path, parts, schema, lambda s: W.closed_window_counts(s, "ts", "1 day", ["value"], ["kind"], ["shop"]), run)
    got = {(r["window_start"], r["shop"], r["feature"]): r for r in spark.read.parquet(f"{tmp_path}/reports").collect()}
    assert len(got) == 8 == spark.read.parquet(f"{tmp_path}/reports").count()
    for d in (1, 2):
        day = spark.createDataFrame([r for r in cur if r[0].day == DAY.day + d], schema)
        want = D.feature_tests(spark.createDataFrame(ref, schema), day, ["value"], ["kind"], ["shop"]).collect()
        for w in want:
            g = got[at(60 * 24 * d), w["shop"], w["feature"]]
            assert all(g[c] == pytest.approx(w[c]) if isinstance(w[c], float) else g[c] == w[c] for c in w.asDict())
    merged = spark.read.parquet(f"{tmp_path}/counts").where(F.col("window_start") < F.lit(FAR)).agg(F.sum("n")).first()[0]
    assert merged == 2 * len(cur)


def test_labels_meet_predictions_in_spark_and_state_is_sized_by_rows(spark, tmp_path):
    """Keys aren't walked in Python, copies of other times are one prediction, and the state has the partitions asked for."""
    preds = [("a", at(30), 0.5, "copy"), ("a", at(0), 0.25, "first"), ("b", at(0), 1.0, None), (None, at(0), 1.0, None), ("c", None, 1.0, None)]
    labels = [("a", at(60 * 24), 1), ("a", at(60 * 24 + 10), 2), ("b", at(60 * 24) + datetime.timedelta(microseconds=1), 3)]
    spark.createDataFrame([*preds, FAR_PRED], PREDS).write.parquet(f"{tmp_path}/preds")
    spark.createDataFrame([*labels, FAR_LABEL], LABELS).write.parquet(f"{tmp_path}/labels")
    joined = W.late_labels(
        spark.readStream.schema(PREDS).parquet(f"{tmp_path}/preds"), spark.readStream.schema(LABELS).parquet(f"{tmp_path}/labels"),
        "key", "pred_ts", "label_key", "label_ts", wait="1 day",
    )
    assert "InPandas" not in joined._jdf.queryExecution().analyzed().toString()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    progress = J.run_to_table(joined, f"{tmp_path}/out", f"{tmp_path}/cp", partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert {op["numShufflePartitions"] for p in progress for op in p["stateOperators"]} == {3}
    got = {tuple(r)[:1] + tuple(r)[2:4] + tuple(r)[6:] for r in spark.read.schema(joined.schema).parquet(f"{tmp_path}/out").where("key <> 'far'").collect()}
    assert got == {("a", 0.25, "first", 1), ("b", 1.0, None, None)}
    assert J.state_partitions(spark, 10**9) == 5000


def test_arriving_files_and_state_partitions_follow_the_rows(spark, sf, tmp_path, monkeypatch):
    from scorewright.catalog import streams as C

    monkeypatch.setattr(W, "FILE_ROWS", 100)
    rows = spark.range(0, 1000, 1, 1).select("id", F.timestamp_seconds("id").alias("ts"))
    assert len(list(C.arrivals(rows, "ts", [], f"{tmp_path}/in"))) == 1
    files = spark.read.parquet(f"{tmp_path}/in").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 10 and all(r["count"] == 100 for r in files)
    asked, run = [], J.run_to_table
    monkeypatch.setattr(J, "STATE_ROWS", 100)
    monkeypatch.setattr(J, "run_to_table", lambda *a, **k: asked.append(k.get("partitions")) or run(*a, **k))
    assert C.stream_dedupe(spark, sf).count() == 1000 and asked == [30] * 3


def test_state_lies_in_files_whose_memory_is_bounded(spark, tmp_path):
    """State of a sized run isn't on the heap, a key is found after many others were removed, and the session is left as it was."""
    many = 20_000
    preds = spark.range(many).select(F.concat(F.lit("k"), "id").alias("key"), F.timestamp_seconds(F.unix_seconds(F.lit(at(0))) + F.col("id") % 2 * 86400 * 3).alias("pred_ts"), F.lit(0.5).alias("p"), F.lit("x").alias("note"))
    labels = preds.select(F.col("key").alias("label_key"), (F.col("pred_ts") + F.expr("INTERVAL 1 HOUR")).alias("label_ts"), F.lit(1).alias("label"))
    far = (spark.createDataFrame([FAR_PRED], PREDS), spark.createDataFrame([FAR_LABEL], LABELS))
    late = F.lit(at(60 * 24))
    steps = [(preds.where(F.col("pred_ts") < late), labels.where(F.col("label_ts") < late)), (preds.where(F.col("pred_ts") >= late), labels.where(F.col("label_ts") >= late)), far]
    before = {k: spark.conf.get(k, None) for k in J.STATE_STORE}
    progress = []
    for some_preds, some_labels in steps:
        some_preds.write.mode("append").parquet(f"{tmp_path}/preds")
        some_labels.write.mode("append").parquet(f"{tmp_path}/labels")
        joined = W.late_labels(
            spark.readStream.schema(PREDS).parquet(f"{tmp_path}/preds"), spark.readStream.schema(LABELS).parquet(f"{tmp_path}/labels"),
            "key", "pred_ts", "label_key", "label_ts", wait="1 day",
        )
        progress += J.run_to_table(joined, f"{tmp_path}/out", f"{tmp_path}/cp", partitions=2)
    operators = [op for p in progress for op in p["stateOperators"]]
    assert operators and all(any(m.startswith("rocksdb") for m in op["customMetrics"]) for op in operators)
    assert {op["numStateStoreInstances"] for op in operators} == {2}
    assert {k: spark.conf.get(k, None) for k in J.STATE_STORE} == before
    got = spark.read.schema(joined.schema).parquet(f"{tmp_path}/out").where("key <> 'far'")
    assert got.agg(F.count("label"), F.count_distinct("key"), F.count(F.lit(1))).first()[:] == (many, many, many)
